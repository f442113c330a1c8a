from __future__ import annotations

import struct
import zlib
from collections import Counter, defaultdict

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveline.llm import queries, sharding


def keyed(seed: int, i: int, x: int) -> int:
    h = 42
    for v in (seed, i, x):
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
    return h - 2**64 if h >= 2**63 else h


def image(x: int, n: int, seed: int) -> int:
    """The permutation by hand."""
    a, b = sharding.halves(n)
    while True:
        left, right = divmod(x, b)
        for i in range(sharding.ROUNDS):
            if i % 2 == 0:
                left = (left + keyed(seed, i, right) % a) % a
            else:
                right = (right + keyed(seed, i, left) % b) % b
        x = left * b + right
        if x < n:
            return x


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 2**40))
def test_brute_force_is_a_permutation(n, seed):
    assert sorted(image(x, n, seed) for x in range(n)) == list(range(n))
    a, b = sharding.halves(n)
    assert n <= a * b < n + max(a, b)


def test_query_equals_brute_force(spark, data):
    got = {r["doc_id"]: r for r in queries.op1_feistel_sharding(spark, data).collect()}
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{data}/documents.parquet").collect())
    assert len(got) == len(docs)
    for place, (doc, text) in enumerate(docs):
        r, p = got[doc], image(place, len(docs), 20240229)
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text.encode()) + 1, zlib.crc32(text.encode()), "rows")
        assert (r["row_number"], r["shard"], r["slot"], r["grown_shard"]) == (place, p % 16, p // 16, None)


def check(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [(None, None, 1, 1)] * 5 + [(3, "a", 2, 2)] * 40 + [(i % 7, "b", i, 9) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, part int").repartition(5)
    out = sharding.shard(df, 8)
    assert set(out.columns) == {"doc_id", "text", "part", "row_number", "shard", "slot"}
    got = out.collect()
    assert Counter((r["doc_id"], r["text"], r["part"]) for r in got) == Counter((r[0], r[1], r[3]) for r in rows)
    check(got, 8)
    assert sorted(r["row_number"] for r in got) == list(range(105))
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["row_number"])][:5] == [None] * 5


def test_reproducible_over_layouts(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    one, other = ({(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard(x, 16).collect()} for x in (df.repartition(3), df.repartition(11)))
    assert one == other


def test_tiny_and_empty(spark):
    empty = spark.range(0).withColumnRenamed("id", "doc_id")
    assert sharding.shard(empty, 4).collect() == []
    for n in (1, 2, 3, 5):
        check(sharding.shard(spark.range(n).withColumnRenamed("id", "doc_id"), 4).collect(), 4)
