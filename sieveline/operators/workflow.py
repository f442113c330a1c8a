"""Small records around a migration: approvals, code rules, caches, pointers into documents, usage findings."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any


@dataclass
class Gates:
    """Ordered approvals, each bound to the fingerprint of what was approved."""

    order: Sequence[str]
    decisions: dict[str, tuple[str, str, str]] = field(default_factory=dict)

    def decide(self, gate: str, decision: str, fingerprint: str, by: str) -> None:
        """Records a decision; an earlier gate has to be approved for the same content first."""
        at = self.order.index(gate)
        for before in self.order[:at]:
            if not self.valid(before, fingerprint):
                raise ValueError(f"{gate} needs {before} to be approved for this content")
        self.decisions[gate] = (decision, fingerprint, by)

    def valid(self, gate: str, fingerprint: str) -> bool:
        """Approved, and nothing has changed since."""
        decision, of, _ = self.decisions.get(gate, ("", "", ""))
        return decision == "APPROVED" and of == fingerprint

    def complete(self, fingerprint: str) -> bool:
        return all(self.valid(g, fingerprint) for g in self.order)


#: A cached table's states, in order.
STATES = ("DOWNLOADED", "MEASURED", "COMPARED", "PUBLISHED")


def advance(current: str | None, to: str) -> str:
    """The next state of a cached table: one step ahead, or any step back (it was loaded or measured again)."""
    at = -1 if current is None else STATES.index(current)
    if STATES.index(to) > at + 1:
        raise ValueError(f"{current} can't become {to}")
    return to


def fits(free_bytes: int, cap_bytes: int, used_bytes: int, new_bytes: int, reserve: float = 0.1) -> bool:
    """Whether new data fits below the cache's cap and leaves a reserve of the disk free."""
    return used_bytes + new_bytes <= cap_bytes and new_bytes <= free_bytes * (1 - reserve)


def pointer(document: Any, path: str) -> Any:
    """The value at 'a.b[0].c'; KeyError where there is none, so that no figure is cited that isn't there."""
    here = document
    for name, index in re.findall(r"([^.\[\]]+)|\[(\d+)\]", path):
        try:
            here = here[name] if name else here[int(index)]
        except (KeyError, IndexError, TypeError):
            raise KeyError(f"{path} has nothing at {name or index}") from None
    return here


def thousands(n: int | float) -> str:
    """A number with dots between thousands."""
    return f"{n:,}".replace(",", "\x00").replace(".", ",").replace("\x00", ".") if isinstance(n, float) else f"{n:,}".replace(",", ".")


def missing_fields(document: Mapping, required: Sequence[str]) -> list[str]:
    """Pointers of a document that have no value yet: what keeps it from being published."""
    out = []
    for p in required:
        try:
            value = pointer(document, p)
        except KeyError:
            value = None
        if value in (None, "", [], {}):
            out.append(p)
    return out


def reusable(before: Mapping, now: Mapping, scope: str) -> list[str]:
    """Why an earlier cycle's measurement can't be used again: what its scope doesn't cover must be unchanged."""
    parts = {"code": ["source", "target"], "source": ["target", "code"], "target": ["source", "code"]}[scope]
    return [f"{p} changed" for p in parts if before.get(p) != now.get(p)]


def mermaid(links: Sequence[tuple[str, str]]) -> str:
    """A graph of links as Mermaid text, nodes in order of appearance."""
    names: dict[str, str] = {}
    for pair in links:
        for x in pair:
            names.setdefault(x, f"n{len(names)}")
    body = [f'  {i}["{n}"]' for n, i in names.items()] + [f"  {names[a]} --> {names[b]}" for a, b in links]
    return "\n".join(["graph LR", *body])
