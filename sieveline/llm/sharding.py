"""Sharding by a Feistel permutation with cycle walking over global row numbers, in DataFrame functions only.

Rows are numbered by the order of their key. A generalised Feistel network permutes [0, a*b) for the smallest
near-square a*b >= N: two halves in Z_a and Z_b take turns to add a keyed hash of the other. Images beyond N walk on
along their cycle until they are below N, so [0, N) is permuted in itself. The permuted number r gives
shard = r mod shards and slot = r div shards: counts differ by one at most and slots have no gaps. Both can be
computed for any row number from N, the seed and the number of shards alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import Scratch

ROUNDS = 6
#: Walks beyond this length are an error, never a wrong number; a step leaves [0, N) with a chance under 1/sqrt(N).
LONGEST_WALK = 128


def halves(n: int) -> tuple[int, int]:
    """a, b with a*b >= n, as near to the root of n as can be."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _round(left: Column, right: Column, i: int, seed: int, a: int, b: int) -> tuple[Column, Column]:
    keyed = lambda x: F.xxhash64(F.lit(seed).cast("long"), F.lit(i).cast("long"), x.cast("long"))
    if i % 2 == 0:
        return F.pmod(left + F.pmod(keyed(right), F.lit(a).cast("long")), F.lit(a).cast("long")), right
    return left, F.pmod(right + F.pmod(keyed(left), F.lit(b).cast("long")), F.lit(b).cast("long"))


def _once(x: Column, seed: int, a: int, b: int) -> Column:
    """One pass as a fold over the rounds, for the few rows that walk on."""
    size = F.lit(b).cast("long")
    start = F.struct(((x - F.pmod(x, size)) / size).cast("long").alias("l"), F.pmod(x, size).alias("r"))

    def step(s: Column, i: Column) -> Column:
        keyed = lambda y: F.xxhash64(F.lit(seed).cast("long"), i.cast("long"), y)
        left = F.pmod(s["l"] + F.pmod(keyed(s["r"]), F.lit(a).cast("long")), F.lit(a).cast("long"))
        right = F.pmod(s["r"] + F.pmod(keyed(s["l"]), size), size)
        return F.when(i % 2 == 0, F.struct(left.alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), right.alias("r")))

    end = F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, step)
    return end["l"] * size + end["r"]


def permuted(df: DataFrame, number: str, n: int, seed: int, out: str) -> DataFrame:
    """``df`` with ``out``: the image of the row number under the keyed permutation of [0, n)."""
    a, b = halves(n)
    size = F.lit(b).cast("long")
    df = df.withColumns({"__l": F.expr(f"`{number}` div {b}L"), "__r": F.pmod(F.col(number), size)})
    for i in range(ROUNDS):
        left, right = _round(F.col("__l"), F.col("__r"), i, seed, a, b)
        df = df.withColumns({"__l": left, "__r": right})
    df = df.withColumn("__x", F.col("__l") * size + F.col("__r"))
    total = F.lit(n).cast("long")
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(LONGEST_WALK)), F.col("__x"), lambda x, _: F.when(x < total, x).otherwise(_once(x, seed, a, b)))
    found = F.when(F.col("__x") < total, F.col("__x")).otherwise(walk)
    df = df.withColumn(out, found).drop("__l", "__r", "__x")
    safe = F.when(F.col(out) < total, F.col(out)).otherwise(F.raise_error(F.lit("cycle walk is too long")).cast("long"))
    return df.withColumn(out, safe)


def numbered(df: DataFrame, order: list[str], scratch: Scratch) -> tuple[DataFrame, int]:
    """(row, row_number): the rows as structs with global numbers 0..N-1 in the order of their columns ``order``, and N.

    One range shuffle sorts the rows; each row's partition and place in it are written with the row, so a recomputed
    task can't renumber it. Partitions' offsets come from a count of a row per partition. Rows that are equal in
    ``order`` are told apart by where they were read, which also lets a hot key spread over several partitions.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).withColumn("read", F.monotonically_increasing_id())
    keys = [F.col(f"row.`{c}`") for c in order] + [F.col("read")]
    laid = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("read")
    laid = scratch.table(laid.withColumn("place", F.monotonically_increasing_id()), "numbered")
    part, index = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = laid.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each partition
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    total = laid.count()
    numbers = laid.withColumn("part", part).join(F.broadcast(starts), "part")
    return numbers.select("row", (F.col("start") + index).alias("row_number")), total


def shard(df: DataFrame, shards: int = 16, *, order: list[str] | None = None, seed: int = 20240229) -> DataFrame:
    """``df`` with row_number, shard int and slot long.

    ``order`` (default doc_id) numbers the rows; nulls come first, equal rows in the order they are read. All
    columns of ``df`` stay; those named row_number, shard or slot are replaced. An empty table stays empty.
    """
    scratch = Scratch(df.sparkSession, "sharding")
    rows, n = numbered(df, order or ["doc_id"], scratch)
    rows = permuted(rows, "row_number", max(n, 1), seed, "image")
    keep = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c.lower() not in ("row_number", "shard", "slot")]
    return rows.select(*keep, "row_number", F.pmod(F.col("image"), F.lit(shards)).cast("int").alias("shard"), F.expr(f"image div {int(shards)}L").alias("slot"))
