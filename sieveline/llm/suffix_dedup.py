"""Repeated passages by sparse suffix arrays.

Suffixes are kept at minimiser positions: a position is kept if its 8-word hash is the least of some 25 successive ones.
The choice rests on content alone, so any two places that share 50 words keep a suffix at the same offset among the
first 25 of them, with at least 26 shared words from there on. The first 26 words, as one 64-bit hash, are the leading
sort key of a suffix; those whose key occurs once can't repeat and go before anything else is gathered. For the
others the words that follow and those before (24 on either side) are fetched from the text. Suffixes of a key that
occurs up to ``group`` times are sorted by key, following and preceding words and each is compared with all others of its
key; the match is extended right and left word by word, on the words themselves, and counts if it reaches ``min_words``. That
the keys agree is told by two hashes, together of 128 bits, of which one is of the key's text.

Suffixes of a key that occurs more often meet by their splits: for each r from 0 to 24 by key, r words to the right and
24 - r to the left, which any two places with 50 words in common share for some r. Such a split is a run of 50 words, whose
text is hashed to 128 bits; the least document of each is found by an aggregation, so that no group stands in one task as a whole.

Every passage of 50 or more words that two documents share is found, whatever the size of its group. Long passages are
covered by one match after another, and matches of a document are merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import WORDS, Scratch, integral, prepare, windows_hash


@dataclass(frozen=True)
class Sparse:
    """Parameters; a match of ``min_words`` words has at least ``key`` of them from the first kept suffix on."""

    min_words: int = 50
    gram: int = 8
    window: int = 25
    #: Suffixes of one key of which all pairs are compared; larger groups meet by their splits.
    group: int = 5

    @property
    def key(self) -> int:
        return self.min_words - self.window + 1

    @property
    def context(self) -> int:
        return self.window - 1


#: Words of more bytes stand in contexts by a hash of 128 bits.
LONG = 40
#: Ids up to this number are broadcast (8 bytes each) to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 500_000


def _sliding(x: np.ndarray, n: int, reduce) -> np.ndarray:
    """Least (or largest) of every n successive values, by doubling."""
    width = 1
    while 2 * width <= n:
        x = reduce(x[:-width], x[width:])
        width *= 2
    return x if width == n else reduce(x[: len(x) - (n - width)], x[n - width :])


def kept_positions(h: np.ndarray, sparse: Sparse) -> np.ndarray:
    """Minimiser positions in a sequence of word hashes that leave room for a key; ties are all kept."""
    grams = windows_hash(h, sparse.gram)
    if len(h) < sparse.min_words or len(grams) < sparse.window:
        return np.empty(0, np.int64)
    least = _sliding(grams, sparse.window, np.minimum)
    pad = np.zeros(sparse.window - 1, np.uint64)
    best = _sliding(np.concatenate([pad, least, pad]), sparse.window, np.maximum)  # the largest least over windows with the position
    at = np.flatnonzero(best == grams)
    return at[at <= len(h) - sparse.key]


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def _suffixes(df: DataFrame, sparse: Sparse) -> DataFrame:
    """(id, pos, h): kept suffixes with the hash of their first ``key`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places, keys = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = _words(text.as_py() or "")
                if doc is None or len(words) < sparse.min_words:
                    continue
                h = WORDS.of(words)
                at = kept_positions(h, sparse)
                if len(at):
                    ids.append(np.full(len(at), doc, np.int64))
                    places.append(at.astype(np.int32))
                    keys.append(windows_hash(h, sparse.key)[at].view(np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ids, places, keys)], ["id", "pos", "h"])

    return df.mapInArrow(run, "id long, pos int, h long")


def _contexts(df: DataFrame, sparse: Sparse) -> DataFrame:
    """From (id, text, pos[], h[]) the suffixes with their following and preceding words.

    Suffixes of a document that agree in all of these are one row, whose further positions are ``also``.
    """
    names = ["h", "h2", "following", "preceding", "id", "pos", "also"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, pos, key in zip(batch.column(0).to_pylist(), batch.column(1), *[c.to_pylist() for c in batch.columns[2:]], strict=True):
                words = _words(text.as_py() or "")
                keys = windows_hash(WORDS.of(words), sparse.key).view(np.int64)
                short = [w if len(w) <= LONG and w[:1] != b"\0" else b"\0" + xxhash.xxh3_128_digest(w).hex().encode() for w in words]
                same: dict[tuple, list] = {}
                for p, k in sorted(zip(pos, key, strict=True)):
                    if p >= len(keys) or keys[p] != k:
                        continue  # of another row with the same id
                    end = p + sparse.key
                    k2 = xxhash.xxh3_64_intdigest(b" ".join(words[p:end]), 1) - 2**63
                    right = b" ".join(short[end : end + sparse.context])
                    left = b" ".join(reversed(short[max(0, p - sparse.context) : p]))
                    if (found := same.get((k, k2, right, left))) is not None:
                        if found[1][-1:] != [p] and found[0] != p:
                            found[1].append(p)
                    else:
                        same[k, k2, right, left] = [p, []]
                rows += [(*of, doc, p, also or None) for of, (p, also) in same.items()]
                if len(rows) >= 20_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return df.mapInArrow(run, "h long, h2 long, following binary, preceding binary, id long, pos int, also array<int>")


def _splits(df: DataFrame, sparse: Sparse) -> DataFrame:
    """(g, g2, id, start): from (id, text, pos[], h[]) the runs of ``min_words`` words around suffixes, by their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, pos, key in zip(batch.column(0).to_pylist(), batch.column(1), *[c.to_pylist() for c in batch.columns[2:]], strict=True):
                words = _words(text.as_py() or "")
                keys = windows_hash(WORDS.of(words), sparse.key).view(np.int64)
                at = np.array([p for p, k in zip(pos, key, strict=True) if p < len(keys) and keys[p] == k], np.int64)
                starts = np.unique((at[:, None] - np.arange(sparse.context + 1)[None, :]).ravel())
                starts = starts[(starts >= 0) & (starts <= len(words) - sparse.min_words)]
                raw, ends = b" ".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                for part in np.split(starts, range(50_000, len(starts), 50_000)) if len(starts) else ():
                    first = np.where(part > 0, ends[part - 1], 0).tolist()
                    digests = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(first, (ends[part + sparse.min_words - 1] - 1).tolist(), strict=True)])
                    g = np.frombuffer(digests, "<i8").reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (g[:, 0], g[:, 1], np.full(len(part), doc, np.int64), part.astype(np.int32))], ["g", "g2", "id", "start"])

    return df.mapInArrow(run, "g long, g2 long, id long, start int")


def _split_matches(splits: DataFrame, sparse: Sparse, scratch: Scratch, across: bool) -> DataFrame:
    """As :func:`_matches`, from (g, g2, id, start): runs of words that another document (or place) has."""
    place, of = (F.col("id") if across else F.struct("id", "start")), ["g", "g2"]
    splits = scratch.table(splits.withColumn("place", place), "splits")
    least = splits.groupBy(*of).agg(F.min("place").alias("m"), F.max("place").alias("n")).where("m < n").drop("n")
    held = scratch.table(splits.join(scratch.table(least, "least"), of), "held")
    scratch.drop("splits", "least")
    doc = (lambda c: F.col(c)) if across else (lambda c: F.col(f"{c}.id"))
    later = held.where("place <> m").select(*of, "id", "start", F.lit(True).alias("cut"), doc("m").alias("other"), "place")
    second = later.groupBy(*of).agg(F.min("place").alias("s"))
    first = held.where("place = m").join(second, of).select("id", "start", F.lit(False).alias("cut"), doc("s").alias("other"))
    found = later.select("id", "start", "cut", "other").unionByName(first)
    stop = (F.col("start") + sparse.min_words).cast("int")
    none = F.lit(np.iinfo(np.int32).max.__int__())
    return found.select("id", "start", stop.alias("stop"), F.when(F.col("cut"), F.col("start")).otherwise(none).alias("cut_start"), F.when(F.col("cut"), stop).otherwise(none).alias("cut_stop"), "other")


def _coded(rows: np.ndarray, width: int, codes: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of a matrix, equal words by equal numbers, and how many each row has."""
    out, sizes = np.zeros((len(rows), width), np.int32), np.zeros(len(rows), np.int32)
    for i, row in enumerate(rows):
        if row:
            words = row.split(b" ")
            sizes[i] = len(words)
            out[i, : len(words)] = [codes.setdefault(w, len(codes) + 1) for w in words]
    return out, sizes


def _common(words: np.ndarray, sizes: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Words that rows x and y have in common from the start."""
    same = words[x] == words[y]
    n = np.where(same.all(axis=1), words.shape[1], np.argmin(same, axis=1))
    return np.minimum(n, np.minimum(sizes[x], sizes[y]))


def _matches(ordered: DataFrame, sparse: Sparse, across: bool) -> DataFrame:
    """(id, start, stop, cut_start, cut_stop, other): what a suffix repeats, and what of it an earlier place holds."""
    none = np.iinfo(np.int32).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            bytes_of = lambda name: np.array([*batch.column(name).to_pylist(), None], dtype=object)[:-1]  # noqa: B023, E731
            cols = [batch.column("h").to_numpy(), batch.column("h2").to_numpy(), batch.column("id").to_numpy(), batch.column("pos").to_numpy().astype(np.int64), bytes_of("following"), bytes_of("preceding"), bytes_of("also")]
            old = 0 if held is None else len(held[0])
            if held is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(held, cols, strict=True)]
            h, h2, ids, pos, ahead, behind, also = cols
            codes: dict[bytes, int] = {}
            following, n_following = _coded(ahead, sparse.context, codes)
            preceding, n_preceding = _coded(behind, sparse.context, codes)
            size = len(h)
            begins = np.ones(size, bool)
            begins[1:] = (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])
            group = np.cumsum(begins)
            first = np.maximum.accumulate(np.where(begins, np.arange(size), 0))
            new = np.arange(old, size)
            most = int((np.arange(size) - first).max())  # each with all before it in its group
            sides = [(new[:0], new[:0])] + [(at := new[new - first[new] >= k], at - k) for k in range(1, most + 1)]
            x, y = (np.concatenate([s[i] for s in sides]) for i in (0, 1))
            fit = (x != y) & (group[x] == group[y])
            if across:
                fit &= ids[x] != ids[y]
            x, y = x[fit], y[fit]
            right, left = sparse.key + _common(following, n_following, x, y), _common(preceding, n_preceding, x, y)
            fit = right + left >= sparse.min_words
            x, y, right, left = x[fit], y[fit], right[fit], left[fit]
            within = np.empty(0, np.int64) if across else np.array([i for i in range(old, size) if also[i] is not None and sparse.key + n_following[i] + n_preceding[i] >= sparse.min_words], np.int64)
            if len(x) or len(within):
                later = (ids[x] > ids[y]) | ((ids[x] == ids[y]) & (pos[x] > pos[y]))
                one, other = np.concatenate([x, y]), np.concatenate([y, x])
                right, left, cut = np.tile(right, 2), np.tile(left, 2), np.concatenate([later, ~later])
                best = {name: np.full(size, -1) for name in ("l", "r", "cl", "cr")}
                np.maximum.at(best["l"], one, left)
                np.maximum.at(best["r"], one, right)
                np.maximum.at(best["cl"], one[cut], left[cut])
                np.maximum.at(best["cr"], one[cut], right[cut])
                partner = np.full(size, np.iinfo(np.int64).max)
                np.minimum.at(partner, one, ids[other])
                best["l"][within], best["r"][within] = n_preceding[within], sparse.key + n_following[within]
                partner[within] = np.minimum(partner[within], ids[within])
                at = np.flatnonzero(best["r"] >= 0)
                more = [(i, p) for i in at.tolist() if also[i] is not None for p in also[i]]
                rows = np.concatenate([at, np.array([i for i, _ in more], np.int64)])
                place = np.concatenate([pos[at], np.array([p for _, p in more], np.int64)])
                cl, cr = best["cl"][rows], best["cr"][rows]
                if not across:  # what a row's further positions hold, its first one holds before them
                    copy = np.arange(len(rows)) >= len(at)
                    full = copy & np.isin(rows, within)
                    cl, cr = np.where(full, n_preceding[rows], cl), np.where(full, sparse.key + n_following[rows], cr)
                has = cr >= 0
                out = [place - best["l"][rows], place + best["r"][rows], np.where(has, place - cl, none), np.where(has, place + cr, none)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), *[pa.array(v.astype(np.int32)) for v in out], pa.array(partner[rows])], ["id", "start", "stop", "cut_start", "cut_stop", "other"])
            held = [c[first[size - 1] :] for c in cols]  # the last group's rows may match what comes next

    return ordered.mapInArrow(run, "id long, start int, stop int, cut_start int, cut_stop int, other long")


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open spans, as spans that don't touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges matches that come sorted by document and start; of a passage only the merged cuts are held."""
    none = np.iinfo(np.int32).max
    kind = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("other", pa.int64()), ("cuts", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))])
    now: list | None = None  # id, start, stop, other, cuts
    done: list[dict] = []

    def close() -> None:
        done.append({"id": now[0], "start": now[1], "stop": now[2], "other": now[3], "cuts": [{"a": a, "b": b} for a, b in merge(now[4])]})

    for batch in batches:
        for doc, start, stop, a, b, other in zip(*(batch.column(n).to_pylist() for n in ("id", "start", "stop", "cut_start", "cut_stop", "other")), strict=True):
            if now is not None and now[0] == doc and start <= now[2]:
                now[2], now[3] = max(now[2], stop), min(now[3], other)
            else:
                if now is not None:
                    close()
                now = [doc, start, stop, other, []]
            if a != none:
                now[4].append((a, b))
                if len(now[4]) > 4096:
                    now[4] = merge(now[4])
        if len(done) >= 4096:
            yield pa.RecordBatch.from_pylist(done, kind)
            done.clear()
    if now is not None:
        close()
    yield pa.RecordBatch.from_pylist(done, kind)


def matches(df: DataFrame, sparse: Sparse, scratch: Scratch, *, id_col: str, text_col: str, across: bool) -> DataFrame:
    """(id, start, stop, other, cuts array of (a, b)): a row per passage, merged as the sorted matches stream by."""
    spark = prepare(df.sparkSession)
    slim = integral(df, id_col).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    suffixes = scratch.table(_suffixes(slim, sparse), "suffixes")
    keys = suffixes.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).where("a < b" if across else "n > 1").select("h", "n")
    keys = scratch.table(keys, "keys")  # written, so that the join's partitions of a hot key can be split
    shared = suffixes.join(keys, "h").select("id", "pos", "h", (F.col("n") > sparse.group).alias("large"))
    shared = scratch.table(shared, "shared")
    scratch.drop("suffixes", "keys")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def texts(rows: DataFrame, name: str) -> DataFrame:
        of_doc = rows.groupBy("id").agg(F.collect_list(F.struct("pos", "h")).alias("at"))
        ids = scratch.table(rows.select("id").distinct(), name, thin=True)
        picked = slim.join(F.broadcast(ids), "id", "left_semi") if ids.count() <= BROADCAST_IDS else slim
        return picked.join(of_doc, "id").select("id", "text", "at.pos", "at.h")

    ordered = _contexts(texts(shared.where("not large"), "ids"), sparse).repartition(parts, "h").sortWithinPartitions("h", "h2", "following", "preceding", "id", "pos")
    few = scratch.table(_matches(ordered, sparse, across), "matches")
    many = scratch.table(_split_matches(_splits(texts(shared.where("large"), "ids2"), sparse), sparse, scratch, across), "split_matches")
    scratch.drop("shared", "held")
    found = few.unionByName(many)
    return found.repartition("id").sortWithinPartitions("id", "start").mapInArrow(_passages, "id long, start long, stop long, other long, cuts array<struct<a: long, b: long>>")


def repeated_passages(df: DataFrame, sparse: Sparse = Sparse(), *, id_col: str = "doc_id", text_col: str = "text", across: bool = True) -> DataFrame:
    """id, start_word, n_words, cut_words (how many of them an earlier place holds) and other_id, a row per passage.

    A passage is a maximal run of words that matches cover; words are runs of bytes other than 0x20 and 0x09-0x0D,
    counted from 0. An earlier place is one in a document of smaller id (or, unless ``across``, further up in the same
    one). Null, empty and short texts have no passages; rows without an id take no part; rows that share an id are
    one document; ids that are no integers raise. Other columns are not read.
    """
    scratch = Scratch(df.sparkSession, "suffix")
    spans = matches(df, sparse, scratch, id_col=id_col, text_col=text_col, across=across)
    gone = F.aggregate("cuts", F.lit(0).cast("long"), lambda n, c: n + c["b"] - c["a"])
    return spans.select(F.col("id").alias(id_col), F.col("start").alias("start_word"), (F.col("stop") - F.col("start")).alias("n_words"), gone.alias("cut_words"), F.col("other").alias("other_id"))


_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after each of them."""
    raw = text.encode("utf-8", "surrogatepass")
    starts = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : starts[a]])
        at = starts[min(b, len(starts) - 1)]
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def deduplicated(df: DataFrame, sparse: Sparse = Sparse(), *, id_col: str = "doc_id", text_col: str = "text", across: bool = True) -> DataFrame:
    """``df`` without the words that an earlier place holds; a document of which nothing is left goes.

    All columns stay, and n_chars, where there is one, counts the new text. Cases as for :func:`repeated_passages`;
    documents without repeated passages stay as they are.
    """
    scratch = Scratch(df.sparkSession, "suffix")
    spans = matches(df, sparse, scratch, id_col=id_col, text_col=text_col, across=across)
    # Merged cuts: of each some min_words words, so that a document's list is a small part of its text.
    cuts = scratch.table(spans.where(F.size("cuts") > 0).groupBy(F.col("id").alias("__id")).agg(F.flatten(F.collect_list("cuts")).alias("__cuts")), "cuts")
    names, place = df.columns, df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, whole = [], []
            for text, found in zip(batch.column(place).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                if found and text:
                    text = without(text, merge([(s["a"], s["b"]) for s in found]))
                    whole.append(bool(text.strip()))
                else:
                    whole.append(True)
                texts.append(text)
            cols = list(batch.columns[: len(names)])
            cols[place] = pa.array(texts, pa.string())
            if "n_chars" in names and names.index("n_chars") != place:
                cols[names.index("n_chars")] = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(cols, names).filter(pa.array(whole, pa.bool_()))

    schema = df.schema
    if "n_chars" in names:
        df = df.withColumn("n_chars", F.col("n_chars").cast("long"))
        schema = df.schema
    joined = df.join(cuts, df[f"`{id_col}`"] == cuts["__id"], "left").select(*[df[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(names)], cuts["__cuts"])
    return joined.mapInArrow(run, schema)
