"""Conversation repair against a shortest-path search over whole conversations."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from itertools import groupby

import pytest

from sieveline.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows: list[tuple]) -> dict:
    """Conversations after damage, in order; the contract told once more, row by row."""
    convs: dict = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    digest = lambda role, text: hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
    return {c: sorted(k, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[1], r[2]))) for c, k in convs.items()}


def searched(rows: list[tuple]) -> tuple[int, str, str]:
    """Least cost, least audit and repaired text by a search in order of (cost, audit) over (row, roles so far's last state)."""
    seen, faults = set(), []
    for _, role, text in rows:
        stripped = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("dead" if not stripped or (role, text) in seen else "cut" if stripped[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, "\n".join(lines)
        if (i, roles[-1:]) in done:
            continue
        done.add((i, roles[-1:]))
        offers = [(cost + 3, audit + "I", i, roles + w[0], (*lines, f"{w}:")) for w in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            offers.append((cost + 4, audit + "D", i + 1, roles, lines))
            if faults[i] != "dead":
                more = 3 if faults[i] else 0
                offers.append((cost + more, audit + "K", i + 1, roles + (role[:1] or "-"), (*lines, f"{role}:{text}")))
                offers += [(cost + 3 + more, audit + "R", i + 1, roles + w[0], (*lines, f"{w}:{text}")) for w in ("user", "assistant")]
        for o in offers:
            if re.fullmatch("(s?(ua)*u?)?", o[3]):
                heapq.heappush(heap, o)
    raise AssertionError("no repair")


def expected(rows: list[tuple]) -> dict:
    found = {}
    for conv, kept in damaged(rows).items():
        turns = sorted({t for t, _, _ in kept if t is not None})
        seen, blank, duplicate, cut = set(), 0, 0, 0
        for _, role, text in kept:
            stripped = text.rstrip(" \t\n\x0b\x0c\r")
            if not stripped:
                blank += 1
            elif (role, text) in seen:
                duplicate += 1
            elif stripped[-1] not in ".!?":
                cut += 1
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, text = searched(kept)
        gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
        found[conv] = (gaps, blank, duplicate, cut, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return found


def got(df) -> dict:
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def test_given_conversations(spark, data):
    table = spark.read.parquet(f"{data}/conversations.parquet")
    assert got(C.repair(table)) == expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_query_is_the_operator(spark, data):
    from sieveline.llm.queries import QUERIES

    table = spark.read.parquet(f"{data}/conversations.parquet")
    assert got(QUERIES["op13_trie_repair"](spark, data)) == expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_random_faults(spark):
    """Ties in turn, nulls in every column, repeated rows, empty and white texts, other roles, several thousand small conversations."""
    rng = random.Random(5)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "User"], ["a.", "b?", "c", "", " \n", None, "d! \t", "e.f", "éä.", " ", "a."]
    rows = [(rng.choice([None, *range(900)]), rng.choice([None, *range(6)]), rng.choice(roles[:3] if rng.random() < 0.8 else roles), rng.choice(texts)) for _ in range(6000)]
    rows += [(5000 + i, t, r, "x.") for i in range(300) for t, r in enumerate(rng.choice(["su", "uaua", "uu", "aa", "s", "ss", "ua", "asu"]).replace("s", "S"))]
    rows = [(c, t, {"u": "user", "a": "assistant", "S": "system"}.get(r, r), x) for c, t, r, x in rows]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("kind", C.F.lit(1)).withColumn("digest", C.F.lit("mine"))
    assert got(C.repair(table.repartition(7))) == expected(rows)


def test_hot_conversation(spark):
    """One conversation holds most rows, many of them equal, over several tasks and batches."""
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["same.", f"text {t}.", f"text {t}"])) for t in range(3000)]
    rows += [(2 + i, t, "user" if t % 2 == 0 else "assistant", f"{t} of {i}.") for i in range(200) for t in range(4)]
    found, want = got(C.repair(spark.createDataFrame(rows, SCHEMA).repartition(5))), expected(rows)
    assert {c: w for c, w in want.items() if c != 1} == {c: f for c, f in found.items() if c != 1}
    assert found[1] == want[1]


def test_long_text_and_all_dropped(spark):
    gone = next(c for c in range(10_000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    rows = [(gone, 0, "user", "x."), (-1, 0, "user", "long words " * 200_000 + "end."), (-1, 1, "assistant", "."), (-2, None, None, None)]
    found = got(C.repair(spark.createDataFrame(rows, SCHEMA)))
    assert found == expected(rows)
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table_and_types(spark):
    assert C.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    by_name = spark.createDataFrame([("c", 0, "user", "a."), ("c", 1, "assistant", "b.")], "conv_id string, turn int, role string, text string")
    assert got(C.repair(by_name)) == expected([("c", 0, "user", "a."), ("c", 1, "assistant", "b.")])
    with pytest.raises(TypeError):
        C.repair(by_name.withColumn("turn", C.F.col("turn").cast("string")))


def test_shared_prefixes_are_computed_once():
    rng = random.Random(7)
    signatures = sorted({"".join(rng.choice("suaxSUAXd") for _ in range(rng.randrange(9))) for _ in range(4000)})
    path, alone = C.Path(C.Layers()), C.Path(C.Layers())
    answers = [path.insert(s) for s in signatures]
    nodes = {s[:i] for s in signatures for i in range(1, len(s) + 1)}
    assert path.computed == len(nodes)
    assert all(C.Path(alone.layers).insert(s) == a for s, a in zip(signatures, answers, strict=True))
    assert len(path.layers.layers) < 400
    for s in ("u" * 5000, "sXd" * 3000):  # no more layers, however long a conversation
        path.insert(s)
    assert len(path.layers.layers) < 400
    assert max(len(list(g)) for _, g in groupby(sorted(signatures))) == 1
