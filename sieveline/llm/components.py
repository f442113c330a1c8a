"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import Scratch

#: Links that one call of the local contraction holds.
CHUNK = 200_000


def _root(parent: dict[int, int], x: int) -> int:
    top = x
    while (up := parent.get(top, top)) != top:
        top = up
    while x != top:
        parent[x], x = top, parent.get(x, x)
    return top


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A star per component of each chunk of links: fewer links that connect the same nodes."""

    def flush() -> pa.RecordBatch:
        pairs = [(x, r) for x in parent if (r := _root(parent, x)) != x]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["x", "y"])

    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ra, rb = _root(parent, a), _root(parent, b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
        if len(parent) >= CHUNK:
            yield flush()
    yield flush()


def components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) for all nodes of ``links`` (two long columns): the smallest node that can be reached.

    Self-links, repeated and reversed links change nothing; rows with a null end are no links. No links: no rows.
    """
    a, b = links.columns
    ends = links.where(F.col(a) != F.col(b)).select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y"))
    edges = scratch.table(ends.mapInArrow(_contract, "x long, y long").distinct(), f"{name}0", thin=True)
    if edges.count() <= CHUNK:  # a bounded number of links is one chunk
        edges = scratch.table(edges.coalesce(1).mapInArrow(_contract, "x long, y long"), f"{name}-stars")
        scratch.drop(f"{name}0")
        return _members(edges)
    step, before = 0, None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum("y")).first()
        if not mark[0] or mark == before:
            break
        before, step = mark, step + 1
        # large star: a node's larger neighbours move to its smallest neighbour
        both = edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them; x > y holds in every row
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        moved = large.join(low, "x").where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        edges = scratch.table(moved.unionByName(low.select("x", F.col("m").alias("y"))).distinct(), f"{name}{step}", thin=True)
        scratch.drop(f"{name}{step - 1}")
    return _members(edges)


def _members(edges: DataFrame) -> DataFrame:
    """From stars (x, their smallest node y) every node with its component."""
    stars = edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("component"))
    return stars.unionByName(edges.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct())
