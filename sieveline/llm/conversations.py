"""Conversation structure repair: the cheapest edits that make each conversation's roles legal, by dynamic programming over a trie.

A row of a conversation is told by one symbol of its role and fault; the symbols of a conversation in order are its *signature*.
Signatures are few compared with conversations. The distinct ones are sorted over the cluster and each task inserts its run of
them into a prefix trie, of which only the path to the current signature is kept: what two neighbours share is computed once.

What the edits may make of the roles is ``(s?(ua)+)?``, four states: 0 before anything, 1 after the system's turn, 2 after the
user's, 3 after the assistant's; 0 and 3 are legal ends. A layer of the dynamic programme holds, for each state, the least cost
of edits that end in it with the row's own edit, and the rank of these edits' text among those of the other states. Such texts
have the same number of letters that use up a row and end in one, so none begins another, and comparing by rank and then by
what is added is comparing the whole texts. Layers that differ by a constant cost are one and the same, so that few exist and
their transitions are computed once per worker.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import Scratch, integral

#: White space by the contract, for trimming.
WHITE = " \t\n\x0b\x0c\r"
#: Costs of the edits, and what a truncated row costs that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Where a turn of the letter leads from each state; a turn that is inserted or given a new role is the one that is due.
NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "x": (None,) * 4}
DUE, WORD = (2, 2, 3, 2), ("user", "user", "assistant", "user")
LEGAL_PAIRS = ("su", "ua", "au")


class Layers:
    """All layers seen, up to a constant cost, and the transitions between them, numbered."""

    def __init__(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.layers: list[tuple] = []
        self.known: dict[tuple[int, str], int] = {}
        self.steps: list[tuple[int, int, tuple]] = []
        self.start = self.number(((0, 0), None, None, None))

    def number(self, layer: tuple) -> int:
        at = self.numbers.setdefault(layer, len(self.layers))
        if at == len(self.layers):
            self.layers.append(layer)
        return at

    def step(self, layer: int, symbol: str) -> int:
        """The number of the transition: (next layer, cost to add, and per state the state before and the edits)."""
        key = layer, symbol
        if key not in self.known:
            self.known[key] = len(self.steps)
            self.steps.append(self._step(self.layers[layer], symbol))
        return self.known[key]

    @staticmethod
    def _step(layer: tuple, symbol: str) -> tuple[int, int, tuple]:
        best: list[tuple | None] = [None] * 4
        stays = TRUNCATED if symbol.isupper() else 0
        for before, held in enumerate(layer):
            if held is None:
                continue
            state, (cost, rank) = before, held
            for edits in ("", "I", "II"):
                ways = [(state, DELETE, "D")]
                if symbol != "d":
                    ways += [(NEXT[symbol.lower()][state], stays, "K"), (DUE[state], REROLE + stays, "R")]
                for to, more, letter in ways:
                    offer = (cost + more, rank, edits + letter, before)
                    if to is not None and (best[to] is None or offer < best[to]):
                        best[to] = offer
                state, cost = DUE[state], cost + INSERT
        # From 3 (or from 2 with a turn put in) all goes that goes from 1, and from 0 but for a system's turn, which costs a deletion.
        reach = min([best[3][0]] * bool(best[3]) + [best[2][0] + INSERT] * bool(best[2]), default=None)
        for state, more in ((0, DELETE), (1, 0)):
            if reach is not None and best[state] and best[state][0] > reach + more:
                best[state] = None
        least = min(o[0] for o in best if o)
        order = sorted((o[1], o[2], to) for to, o in enumerate(best) if o)
        rank = {to: i for i, (_, _, to) in enumerate(order)}
        return tuple((o[0] - least, rank[to]) if o else None for to, o in enumerate(best)), least, tuple(o and (o[3], o[2]) for o in best)

    def advance(self, layer: int, symbol: str) -> tuple[int, int, int]:
        """(transition, next layer, cost to add)."""
        number = self.step(layer, symbol)
        to, cost, _ = self.steps[number]
        return number, self.number(to), cost

    def ends(self, layer: int) -> tuple[int, int, str]:
        """(cost beyond the layer's, state, trailing edits) of the best legal end."""
        offers = []
        for before, held in enumerate(self.layers[layer]):
            state = before
            for edits in ("", "I", "II") if held else ():
                if state in (0, 3):
                    offers.append((held[0] + INSERT * len(edits), held[1], edits, before))
                state = DUE[state]
        cost, _, edits, before = min(offers)
        return cost, before, edits


class Path:
    """The trie's path from its root to the signature inserted last: transitions, layers and costs by depth."""

    def __init__(self, layers: Layers) -> None:
        self.layers, self.signature, self.computed = layers, "", 0
        self.moves, self.at, self.costs = array("i"), array("i", [layers.start]), array("q", [0])

    def insert(self, signature: str) -> tuple[int, str]:
        """(least cost, ASCII-least edits) at the signature's terminal node; what it shares with the last one isn't computed again."""
        shared, both = 0, min(len(signature), len(self.signature))
        while shared < both and signature[shared : shared + 4096] == self.signature[shared : shared + 4096]:
            shared = min(both, shared + 4096)
        while shared < both and signature[shared] == self.signature[shared]:
            shared += 1
        del self.moves[shared:], self.at[shared + 1 :], self.costs[shared + 1 :]
        for symbol in signature[shared:]:
            move, layer, cost = self.layers.advance(self.at[-1], symbol)
            self.moves.append(move)
            self.at.append(layer)
            self.costs.append(self.costs[-1] + cost)
            self.computed += 1
        self.signature = signature
        cost, state, tail = self.layers.ends(self.at[-1])
        pieces = [tail]
        for move in reversed(self.moves):
            state, edits = self.layers.steps[move][2][state]
            pieces.append(edits)
        return self.costs[-1] + cost, "".join(reversed(pieces))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a checksum of ``conv_id:turn``: dropped, emptied, without stops, repeated, or given to the user.

    Columns conv_id, turn, role, text and ``live``; a dropped row stays with live = false, so that its conversation isn't lost.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(space("conv_id"), F.lit(":"), space("turn")), "UTF-8")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != 0).alias("live"), copies.alias("copy")).drop("copy")


def _digest() -> Column:
    """Of role and text; the role's length goes first, so that no other two make the same bytes."""
    return F.unhex(F.md5(F.encode(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), "UTF-8")))


def _told(rows: DataFrame) -> DataFrame:
    """Rows without their texts: the digest of role and text, the role's initial, whether blank, whether truncated."""
    trimmed = F.rtrim("text", F.lit(WHITE))
    first = F.substring("role", 1, 1)
    letter = F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("x"))
    ends = F.substring(trimmed, -1, 1)
    return rows.select("conv_id", "turn", "role", _digest().alias("digest"), letter.alias("letter"), first.alias("initial"), (trimmed == "").alias("blank"), (~ends.isin(".", "!", "?")).alias("truncated"), "live")


def _order() -> list[Column]:
    """Rows of one conversation in order; those that tie in turn and role go by the digest of their text."""
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from rows sorted by conversation and order; a conversation costs a byte a row."""
    names = ("gaps", "blank", "duplicate", "truncated", "illegal")
    out: list[tuple] = []
    schema = kind = None
    open_, held = False, None

    def close() -> None:
        conv, counts, turns, signature = held[0], held[1], held[2], held[3].decode()
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
        out.append((conv, gaps, *counts, signature))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:6]), pa.array(columns[6], pa.string())]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for batch in batches:
        if schema is None:
            kind = batch.schema.field("conv_id").type
            schema = pa.schema([("conv_id", kind), *((n, pa.int64()) for n in names), ("signature", pa.string())])
        for conv, turn, digest, letter, initial, blank, truncated, live, first in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "digest", "letter", "initial", "blank", "truncated", "live", "first")), strict=True):
            if not open_ or conv != held[0]:
                if open_:
                    close()
                # conversation, counts, (least, most, number of turns), signature, last row, last initial
                open_, held = True, [conv, [0, 0, 0, 0], [0, 0, 0], bytearray(), None, None]
                if len(out) >= 4096:
                    yield flush()
            if not live:
                continue
            counts, turns, last = held[1], held[2], held[4]
            if turn is not None and (not turns[2] or turn != turns[1]):
                turns[:] = [turns[0] if turns[2] else turn, turn, turns[2] + 1]
            if held[5] is not None and held[5] + initial not in LEGAL_PAIRS:
                counts[3] += 1
            again = first is not None or last == (turn, digest)
            symbol = letter
            if blank or again:
                counts[0 if blank else 1] += 1
                symbol = "d"
            elif truncated:
                counts[2] += 1
                symbol = letter.upper()
            held[3] += symbol.encode()
            held[4], held[5] = (turn, digest), initial
    if open_:
        close()
        yield flush()


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path = Path(Layers())
    for batch in batches:
        signatures = batch.column(0).to_pylist()
        costs, audits = zip(*map(path.insert, signatures), strict=True) if signatures else ((), ())
        yield pa.RecordBatch.from_pydict({"signature": pa.array(signatures, pa.string()), "cost": pa.array(costs, pa.int64()), "audit": pa.array(audits, pa.string())})


def answers(signatures: DataFrame) -> DataFrame:
    """signature, cost and audit of each distinct ``signature``; sorted runs of them share their prefixes in each task's trie."""
    distinct = signatures.select("signature").distinct()
    return distinct.repartitionByRange("signature").sortWithinPartitions("signature").mapInArrow(_answers, "signature string, cost long, audit string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams each conversation's answer and then its rows; holds the audit and a hash, never the rows."""
    heads: list[dict] = []
    hashes: list[str] = []
    schema = None
    feed = None

    def follow(audit: str) -> Iterator[None]:
        """A coroutine that takes the rows and hashes what the edits make of them."""
        sha, state, between = hashlib.sha256(), 0, b""
        for letter in audit:
            if letter == "D":
                yield
                continue
            if letter == "I":
                line, to = f"{WORD[state]}:", DUE[state]
            else:
                role, text = yield
                line, to = (f"{WORD[state]}:{text}", DUE[state]) if letter == "R" else (f"{role}:{text}", NEXT[role[0]][state])
            sha.update(between + line.encode())
            state, between = to, b"\n"
        hashes.append(sha.hexdigest())
        yield

    for batch in batches:
        if schema is None:
            fields = [f for f in batch.schema if f.name not in ("kind", "turn", "role", "digest", "text")]
            schema = pa.schema([*fields, ("repaired_sha256", pa.string())])
        kinds, roles, texts = (batch.column(n).to_pylist() for n in ("kind", "role", "text"))
        for i, kind in enumerate(kinds):
            if kind == 0:
                heads.append({f.name: batch.column(f.name)[i].as_py() for f in fields})
                feed = follow(heads[-1]["audit"])
                next(feed)
            else:
                feed.send((roles[i], texts[i]))
        ready = min(len(hashes), len(heads))
        if ready >= 1024:
            yield pa.RecordBatch.from_pylist([h | {"repaired_sha256": s} for h, s in zip(heads[:ready], hashes[:ready], strict=True)], schema)
            del heads[:ready], hashes[:ready]
    if heads:
        yield pa.RecordBatch.from_pylist([h | {"repaired_sha256": s} for h, s in zip(heads, hashes, strict=True)], schema)


def repair(conversations: DataFrame, damaged: DataFrame | None = None) -> DataFrame:
    """The cheapest repair of every conversation of columns conv_id, turn (integer), role, text.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. ``damaged`` are rows as ``damage`` gives
    them; by default those of ``conversations``.

    Texts are shuffled once, to be hashed in order; everything before works on digests. Which rows repeat an earlier one comes
    from an aggregation by conversation and digest. A conversation of any size is streamed: a task holds a byte a row for its
    signature and its audit (which the result holds too), never its rows. That one conversation's rows pass through one task is
    due to the hash of the whole repaired text, which can only be computed in order.

    Nulls: a null conv_id is a conversation of its own; a null turn goes before all others, null roles and texts are one space.
    Rows of the same turn go by role and then by the MD5 digest of role and text; equal rows are adjacent. An empty table gives
    no rows; a conversation that lost all its rows gives zeros, an empty audit and the hash of nothing.
    """
    integral(conversations, "turn")
    spark = conversations.sparkSession
    scratch = Scratch(spark, "repair")
    rows = damaged if damaged is not None else damage(conversations)
    told = _told(rows)
    turn = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    seen = told.where("live").groupBy("conv_id", "digest").agg(F.min(turn).alias("least"), F.max(turn).alias("most"))
    again = seen.where(F.col("least") != F.col("most")).select(F.col("conv_id").alias("of"), F.col("digest").alias("seen"), F.col("least").alias("first"))
    later = told["conv_id"].eqNullSafe(again["of"]) & (told["digest"] == again["seen"]) & told["live"] & (turn > F.col("first"))
    marked = told.join(again, later, "left").select("conv_id", "turn", "role", "digest", "letter", "initial", "blank", "truncated", "live", F.col("seen").alias("first"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long"
    signed = marked.repartition("conv_id").sortWithinPartitions("conv_id", *_order()).mapInArrow(_signatures, f"conv_id {kind}, {counts}, signature string")
    signed = scratch.table(signed, "signatures")
    solved = signed.join(answers(signed), "signature").drop("signature")
    heads = solved.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    nothing = [F.lit(None).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    bodies = rows.where("live").select("conv_id", F.lit(1).alias("kind"), "turn", "role", _digest().alias("digest"), "text", *nothing, F.lit(None).cast("string").alias("audit"))
    every = heads.unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_order())
    return every.mapInArrow(_digests, f"conv_id {kind}, {counts}, cost long, audit string, repaired_sha256 string")
