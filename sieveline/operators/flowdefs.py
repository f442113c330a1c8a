"""Flow definitions on the driver: nested activities, their inputs and outputs, and roles as the code has them."""

from __future__ import annotations

import ast
import datetime as dt
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from sieveline.functions.exprlang import Hole, evaluate
from sieveline.operators.flow import UNRESOLVED

#: Where containers hold their activities, with the branch that each list stands for.
_BRANCHES: dict[str, Callable[[dict], list[tuple[str | None, list]]]] = {
    "foreach": lambda p: [(None, p.get("activities") or [])],
    "until": lambda p: [(None, p.get("activities") or [])],
    "ifcondition": lambda p: [("true", p.get("ifTrueActivities") or []), ("false", p.get("ifFalseActivities") or [])],
    "switch": lambda p: [(str(c.get("value")), c.get("activities") or []) for c in p.get("cases") or []] + [("default", p.get("defaultActivities") or [])],
}


@dataclass
class Activity:
    """An activity and where it stands."""

    name: str
    kind: str
    definition: dict
    inside: tuple[str, ...] = ()
    branch: str | None = None
    cut: str | None = None


def flatten(activities: Sequence[dict], read: Callable[[str], dict | None] | None = None, depth: int = 6) -> Iterator[Activity]:
    """All activities, containers first, those of invoked flows included.

    ``read`` gives an invoked flow's definition by id. A flow that invokes itself, one that can't be read, and what lies
    deeper than ``depth`` are marked as cut, not lost silently.
    """
    seen: set[str] = set()

    def walk(items: Sequence[dict], inside: tuple[str, ...], branch: str | None) -> Iterator[Activity]:
        for a in items:
            props, kind = a.get("typeProperties") or {}, str(a.get("type") or "")
            out = Activity(a.get("name") or "", kind, a, inside, branch)
            lists = _BRANCHES.get(kind.lower(), lambda _: [])(props)
            called = props.get("pipelineId") or ((props.get("pipeline") or {}).get("referenceName"))
            child = None
            if (lists or called) and len(inside) >= depth:
                out.cut, lists, called = f"deeper than {depth} levels", [], None
            elif called in seen:
                out.cut, called = "cycle", None
            elif called:
                seen.add(called)
                child = read(called) if read else None
                out.cut = None if child is not None else f"{called} can't be read"
            yield out
            for label, inner in lists:
                yield from walk(inner, (*inside, out.name), label)
            if child is not None:
                yield from walk((child.get("properties") or child).get("activities") or [], (*inside, out.name), None)

    yield from walk(activities, (), None)


def io_of(definition: dict, context: Mapping[str, Any] | None = None, read: Callable[[str], dict | None] | None = None, now: dt.datetime | None = None) -> list[dict]:
    """A register row per input and output of the flow's copies: role, path, its template and what is unresolved in it."""
    rows = []
    for a in flatten((definition.get("properties") or definition).get("activities") or [], read):
        for side, role in (("source", "input"), ("sink", "output")):
            settings = ((a.definition.get("typeProperties") or {}).get(side) or {}).get("datasetSettings") or {}
            place = (settings.get("typeProperties") or {}).get("location") or {}
            templates = [x.get("value") if isinstance(x, dict) else x for x in (place.get("folderPath"), place.get("fileName"))]
            values = [str(evaluate(t, context, now)) if t else "" for t in templates]
            path = "/".join(v.strip("/") for v in values if v)
            if path:
                rows.append({
                    "activity": a.name, "inside": " / ".join(a.inside) or None, "branch": a.branch, "role": role, "path": path, "template": "/".join(t for t in templates if t),
                    "per_item": any(t and "item()" in t for t in templates), "unresolved": sorted(k for k, p in UNRESOLVED.items() if re.search(p, path)),
                })
    return rows


@dataclass
class Roles:
    """Parameters of a job by what its code does with them."""

    inputs: list[str] = field(default_factory=list)
    outputs: list[str] = field(default_factory=list)
    both: list[str] = field(default_factory=list)
    modes: list[str] = field(default_factory=list)


def used_parameters(source: str, name: str = "params") -> set[str]:
    """Attributes of ``params`` that code refers to; by text where it doesn't parse."""
    try:
        tree = ast.parse(source)
    except SyntaxError:
        return set(re.findall(rf"\b{re.escape(name)}\.([A-Za-z_]\w*)", source))
    return {n.attr for n in ast.walk(tree) if isinstance(n, ast.Attribute) and isinstance(n.value, ast.Name) and n.value.id == name}


def declared_parameters(source: str, name: str = "Params") -> list[str]:
    """Annotated fields of the class that declares a job's parameters."""
    try:
        tree = ast.parse(source)
    except SyntaxError:
        return []
    return next(([s.target.id for s in c.body if isinstance(s, ast.AnnAssign) and isinstance(s.target, ast.Name)] for c in ast.walk(tree) if isinstance(c, ast.ClassDef) and c.name == name), [])


_PLACE = re.compile(r"_(path|table|dir|folder|file)\Z")


def roles_from_code(files: Mapping[str, str]) -> Roles:
    """What extract modules refer to is read, what load modules refer to is written; both is both."""
    of = lambda end: set().union(*[used_parameters(s) for n, s in files.items() if n.endswith(end)])
    read, written = ({p for p in of(end) if _PLACE.search(p)} for end in ("extract.py", "load.py"))
    declared = [p for n, s in files.items() if n.endswith("params.py") for p in declared_parameters(s)]
    return Roles(sorted(read - written), sorted(written - read), sorted(read & written), sorted(p for p in declared if p.endswith(("write_mode", "output_mode"))))


def correct_roles(register: Sequence[dict], roles: Roles) -> list[dict]:
    """The register (flag, role, ...) with roles as the code has them, and whether that changed them."""
    of = {p: r for r, ps in (("input", roles.inputs), ("output", roles.outputs), ("both", roles.both)) for p in ps}
    out = []
    for row in register:
        known = of.get(row["flag"].lstrip("-").replace("-", "_"))
        out.append({**row, "role": known or row["role"], "changed": known is not None and known != row["role"], "from_code": known is not None})
    return out


def write_modes(arguments: Sequence[str]) -> dict[str, str]:
    """Flag prefixes and the write mode that is given for each ('--sales-write-mode append')."""
    out = {}
    for flag, value in zip(arguments, arguments[1:], strict=False):
        if m := re.fullmatch(r"--(?:(.*?)-)?(?:(?:write|save|output)-)?mode", flag):
            out[m[1] or ""] = value.strip().lower()
    return out


def mode_of(flag: str, modes: Mapping[str, str]) -> str | None:
    """The mode of an output flag: that of the longest prefix which fits, else the common one."""
    name = flag.lstrip("-")
    fits = [p for p in modes if p and name.startswith(p)]
    return modes[max(fits, key=len)] if fits else modes.get("")


def is_hole(value: Any) -> bool:
    return isinstance(value, Hole)
