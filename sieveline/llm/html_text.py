"""Main text of web pages by composite text density.

The page becomes a tree of elements, without what never shows as text (scripts, styles, form controls, hidden elements).
For each node, with C characters, T tags, LC characters in links and LT link tags below it,

    density = weight * C/T * ln(C/LC * T/LT) / max(1, ln b),   b = ln(C/notLC * LC + LCbody/Cbody * C + e)

where notLC are the characters outside links, and divisors of 0 count as 1. What elements are and how they are named
enters as a prior only: the weight is the product of those on the way from the body. A node's density sum adds its
children's densities and that of its own text. The node with the largest sum is the core of the article. The least density on the path
from the body to it is the threshold: besides the core's subtree, a subtree that hangs off this path belongs to the
article if its density reaches the threshold, or its density sum a fifth of the core's; so does an <h1> before it.

A page that marks its articles (<article>, <main>) says how far they go: the core extends to the mark that holds it, and
gives way to marks inside that hold half of its sum; then only marked subtrees can join by the threshold. In what was
chosen, subtrees that are page furniture are left out, but never one that holds the core. Blocks are returned in page
order.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sieveline.llm.common import prepare

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre xmp section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose start closes an open element of the given names (no end tag was written).
CLOSES = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "option": frozenset({"option"}), "thead": frozenset({"tr", "td", "th"}),
    "tbody": frozenset({"thead", "tr", "td", "th"}), "tfoot": frozenset({"tbody", "tr", "td", "th"}), "body": frozenset({"head"}),
}
#: Where such closing stops.
SCOPE = frozenset("ul ol dl table select html body div section article main".split())
CLOSES_P = BLOCK - frozenset("html body".split()) - frozenset({"caption", "td", "th", "tr", "thead", "tbody", "tfoot"})
#: Elements that "/>" closes; on others it means nothing.
SHAPES = frozenset("svg math".split())
#: Never shown as text: form controls and what is drawn or played.
HARD = RAW | frozenset("head button select option datalist input label svg canvas object audio video map".split())
FURNITURE = frozenset("nav aside footer menu dialog".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
MARKS = frozenset("article main".split())
#: Words of class and id names that tell page furniture, those of reader comments, and those that may stand beside them.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promotion promotions banner nav navbar navigation menu submenu breadcrumb breadcrumbs "
    "sidebar aside widget widgets footer masthead header cookie cookies consent gdpr notice notices notification notifications popup modal overlay newsletter subscribe subscription "
    "share sharing social related recommended recommendations pagination pager login signup toolbar copyright disclaimer topnav skip".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist commentform respond replies disqus".split())
NEUTRAL_WORDS = frozenset(
    "box block container wrapper wrap inner outer slot area region section panel bar list item items link links button buttons icon icons row col column columns unit top bottom left right "
    "main site page global primary secondary mobile desktop sticky fixed small large first last legal bg policy message text content body posts stories articles media follow js div id the and to".split()
)
#: Words beside which header, notice or banner speak of the article itself, and others still of furniture.
OWN_WORDS, OF_ARTICLE = frozenset("article post entry story blog news".split()), frozenset("header notice notices banner".split())
#: Priors. They favour what a page marks, and leave furniture a chance only where hardly any other text is.
MARKED, PLAIN, FORM, NAMED, BY_KIND = 4.0, 1.0, 0.1, 0.02, 0.002
#: Share of the core's density sum that lets a subtree join, and that lets marks inside the core stand for it.
JOINS, STANDS = 0.2, 0.5

_NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")
# an attribute's value is quoted only right after "="; a quote elsewhere is a character like others
_TAG = re.compile(r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|/([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*+|(?=>|\Z)))*+)(?:>|\Z)|/[^a-zA-Z][^>]*(?:>|\Z))", re.DOTALL)
_ATTR = re.compile(r"([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]*)))?")
_READ = re.compile(r"class|id|role|hidden|itemprop|style", re.IGNORECASE)
#: What a style says of an element that a reader doesn't see.
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!\s*important\s*)?(?:;|$)", re.IGNORECASE)
_WHITE = re.compile(r"\s+")


class Node:
    """An element: its tag, parent, children (nodes and strings), prior, whether it is out of the question, a mark."""

    __slots__ = ("tag", "parent", "items", "prior", "hard", "mark", "chars", "tags", "link_chars", "link_tags", "weight", "density", "total")

    def __init__(self, tag: str, parent: Node | None, prior: float = PLAIN, mark: bool = False) -> None:
        self.tag, self.parent, self.prior, self.hard, self.mark = tag, parent, prior, prior == 0, mark
        self.items: list[Node | str] = []

    def kept(self) -> list[Node]:
        return [x for x in self.items if not isinstance(x, str) and not x.hard]


def attributes(source: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name, references decoded; of repeated names the first."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(source):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def name_prior(names: str) -> float:
    """What class or id names tell: a name counts if all of its words are furniture's or neutral ones."""
    prior = PLAIN
    for name in names.split():
        words = [w.lower() for w in _NAME.findall(name)]
        told = {w for w in words if w in FURNITURE_WORDS or w in COMMENT_WORDS}
        rest = {w for w in words if w not in told and w not in NEUTRAL_WORDS and len(w) > 1}
        if not told or rest - OWN_WORDS or (rest and told <= OF_ARTICLE):
            continue
        prior = min(prior, BY_KIND if told & COMMENT_WORDS else NAMED)
    return prior


def _prior(tag: str, source: str, inside_mark: bool) -> tuple[float, bool]:
    """An element's prior (0: never text) and whether it marks an article."""
    if tag in HARD:
        return 0, False
    mark = tag in MARKS
    prior = BY_KIND if tag in FURNITURE or (tag == "header" and not inside_mark) else FORM if tag == "form" else PLAIN
    if source and tag not in ("html", "body") and _READ.search(source):
        found = attributes(source)
        role = found.get("role", "").lower()
        if "hidden" in found and found["hidden"].lower() != "until-found":
            return 0, False
        if found.get("aria-hidden", "").strip().lower() == "true" or _UNSEEN.search(found.get("style", "")):
            return 0, False
        mark |= role in MARKS or found.get("itemprop", "").lower() == "articlebody"
        if role in FURNITURE_ROLES:
            prior = min(prior, BY_KIND)
        named = min(name_prior(found.get("class", "")), name_prior(found.get("id", "")))
        if not mark or named == BY_KIND:  # marks are used for reader comments too
            prior, mark = min(prior, named), mark and named != BY_KIND
    return (MARKED if mark and prior == PLAIN else prior), mark


def parse(page: str) -> Node:
    """The tree of a page. Unclosed and stray tags are repaired; text of raw elements is left out."""
    root = here = Node("#root", None)
    at, articles = 0, 0
    while True:
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            here.items.append(text)
        if not m:
            return root
        at = m.end()
        if closing := m[1]:
            tag = closing.lower()
            if tag == "br":
                here.items.append(" ")
                continue
            node = here
            while node.parent is not None and node.tag != tag:
                if node.tag in ("td", "th", "article", "main", "body") and tag not in BLOCK:
                    node = root  # an inline end tag doesn't close these
                    break
                node = node.parent
            if node.parent is None:
                continue
            step = here
            while step is not node.parent:
                articles -= step.mark
                step = step.parent
            here = node.parent
        elif opening := m[2]:
            tag, source = opening.lower(), m[3]
            if tag == "br":
                here.items.append(" ")
                continue
            closes = CLOSES.get(tag, frozenset())
            if tag in CLOSES_P or closes:
                node, target = here, None
                while node.parent is not None and (node is here or node.tag not in SCOPE):
                    if node.tag in closes or (tag in CLOSES_P and node.tag == "p"):
                        target = node
                    if node.tag in SCOPE:
                        break
                    node = node.parent
                if target is not None:
                    here = target.parent
            node = Node(tag, here, *_prior(tag, source, articles > 0))
            here.items.append(node)
            if node.mark:  # what holds the article is no furniture, whatever its name, and no mere form
                above = here
                while above is not None:
                    above.prior = PLAIN if above.prior in (NAMED, FORM) else above.prior
                    above = above.parent
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            elif tag not in VOID and (tag not in SHAPES or not source.endswith("/")):
                here = node
                articles += node.mark


def _measure(root: Node) -> list[Node]:
    """Kept nodes, children before parents, with weight, and characters and tags below each."""
    order, stack = [], [root]
    root.weight = PLAIN
    while stack:
        node = stack.pop()
        order.append(node)
        for x in node.items:
            if not isinstance(x, str) and not x.hard:
                # a mark within a mark is favoured no further
                x.weight = max(node.weight, MARKED) if x.prior == MARKED and node.weight >= PLAIN else node.weight * x.prior
                stack.append(x)
    order.reverse()
    for node in order:
        chars = tags = link_chars = link_tags = 0
        for x in node.items:
            if isinstance(x, str):
                chars += _chars(x)
            elif not x.hard:
                chars += x.chars
                tags += x.tags + 1
                link_chars += x.link_chars
                link_tags += x.link_tags
        if node.tag == "a":  # a link is one to itself too
            link_chars, link_tags = chars, link_tags + 1
        node.chars, node.tags, node.link_chars, node.link_tags = chars, tags, link_chars, link_tags
    return order


def _chars(text: str) -> int:
    return len(text) - text.count(" ") - text.count("\n")


def composite_density(c: int, t: int, lc: int, lt: int, link_share: float) -> float:
    """The module's formula without the weight; ``link_share`` is LCbody/Cbody."""
    if not c:
        return 0.0
    t, b = max(t, 1), math.log(c / max(c - lc, 1) * lc + link_share * c + math.e)
    return c / t * max(0.0, math.log(c / max(lc, 1) * t / max(lt, 1)) / max(1.0, math.log(b)))


def densities(body: Node) -> list[Node]:
    """Sets density and density sum on all kept nodes of ``body``."""
    order = _measure(body)
    share = body.link_chars / max(body.chars, 1)
    for node in order:
        node.density = node.weight * composite_density(node.chars, node.tags, node.link_chars, node.link_tags, share)
        node.total = sum(x.density for x in node.kept())
        if own := sum(_chars(x) for x in node.items if isinstance(x, str)):
            inside = own if node.tag == "a" else 0
            node.total += node.weight * composite_density(own, 1, inside, min(inside, 1), share)
    return order


def _marks(core: Node) -> list[Node]:
    """The outermost marks below a node that furniture doesn't hold."""
    out, stack = [], core.kept()
    while stack:
        x = stack.pop()
        if x.mark:
            out.append(x)
        elif x.prior >= PLAIN:
            stack += x.kept()
    return out


def _chosen(body: Node) -> tuple[set[int], set[int]]:
    """Subtrees to take, and nodes above the core, which are no furniture (both by id)."""
    order = densities(body)
    core = max(reversed(order), key=lambda n: n.total)
    path = [core]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold, above = min(n.density for n in path), {id(n) for n in path}
    if marked := [n for n in path if n.mark]:
        path = path[path.index(marked[-1]) :]
        taken = {id(marked[-1])}
    else:
        inside = _marks(core)
        marked = inside if inside and sum(x.total for x in inside) >= STANDS * core.total else []
        taken = {id(x) for x in marked} or {id(core)}
    joins = lambda x: x.density >= threshold or x.total >= JOINS * core.total
    for node, child in zip(path[1:], path, strict=False):
        before = True
        for x in node.kept():
            if x is child or x.prior < PLAIN:
                before &= x is not child
                continue
            if before and not marked and x.tag == "h1" and 2 * x.link_chars < x.chars:
                taken.add(id(x))
                continue
            taken |= {id(y) for y in ([x] if x.mark else _marks(x)) if y.chars and joins(y)} if marked else {id(x)} if x.chars and joins(x) else set()
        if not marked and (own := sum(_chars(x) for x in node.items if isinstance(x, str))) and node.weight * composite_density(own, 1, 0, 0, 0.0) >= threshold:
            taken.add(-id(node))  # its own text alone
    return taken, above


def _blocks(body: Node, taken: set[int], above: set[int], weighed: bool) -> list[list[str]]:
    """The text of the subtrees that are taken, in page order, as blocks."""
    out: list[list[str]] = [[]]
    stack: list[tuple[Node | str | None, bool]] = [(body, id(body) in taken)]
    while stack:
        x, inside = stack.pop()
        if x is None:
            out.append([])
        elif isinstance(x, str):
            if inside:
                out[-1].append(x)
        else:
            block = x.tag in BLOCK or (id(x) in taken and not inside)
            inside = inside or id(x) in taken
            if block:
                out.append([])
                stack.append((None, False))
            own = inside or -id(x) in taken
            for y in reversed(x.items):
                if isinstance(y, str):
                    stack.append((y, own))
                elif not y.hard and (not inside or not weighed or y.prior >= PLAIN or id(y) in above):
                    stack.append((y, inside))
    return out


def _body(root: Node) -> Node:
    stack = [root]
    while stack:
        kids = [x for x in stack.pop().items if not isinstance(x, str)]
        if body := next((x for x in kids if x.tag == "body"), None):
            return body
        stack += [x for x in kids if x.tag == "html"]
    return root


def _text(blocks: list[list[str]]) -> str:
    found = (_WHITE.sub(" ", html.unescape("".join(b))).strip() for b in blocks)
    return "\n".join(x for x in found if x)


def main_text(page: str) -> str:
    """The article: blocks in page order, joined by a newline, with references decoded and white space made single.

    A page without marks of which nothing but furniture by name or forms would be left is taken whole, with these.
    """
    if not page:
        return ""
    body = _body(parse(page))
    taken, above = _chosen(body)
    if text := _text(_blocks(body, taken, above, True)):
        return text
    stack, marked, other = [body], False, False
    while stack:
        for x in stack.pop().kept():
            marked |= x.mark
            if x.prior in (NAMED, FORM, BY_KIND) and (x.prior != BY_KIND or x.tag not in FURNITURE | {"header"}):
                x.prior, other = PLAIN, True
            stack.append(x)
    return _text(_blocks(body, {id(body)}, set(), True)) if other and not marked else ""


def extract(df: DataFrame, *, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default page_id, url), text and n_chars (code points), a row for each row.

    Null, empty and markup-only pages give an empty text. Unclosed markup counts up to the page's end. Whole pages
    are read, however long; ties between nodes go to the outer, then the later one. Other columns are not read.
    """
    prepare(df.sparkSession)
    keep = keep or ["page_id", "url"]
    schema = ", ".join([*[f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep], "text string", "n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*keep, "text", "n_chars"])

    return df.select(*keep, html_col).mapInArrow(run, schema)
