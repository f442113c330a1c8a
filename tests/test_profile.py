"""Sums, distinct values and quartiles at the edges of number types."""

from __future__ import annotations

import math
import random
from decimal import Decimal, localcontext

from pyspark.sql import functions as F

from sieveline.functions import scale
from sieveline.operators import profile


def test_sums_of_amounts_and_others_are_exact(spark):
    rng = random.Random(4)
    amounts = [round(rng.uniform(-1e6, 1e6), rng.randrange(5)) for _ in range(3000)]
    odd = [0.1234567891, 1e-7, 123456789012.5, -9e15, 0.0, -0.0, 1e11, -99999999999.9999]
    rows = [(x, x, i) for i, x in enumerate(amounts)] + [(x, None, -i) for i, x in enumerate(odd)] + [(math.nan, None, 0), (math.inf, None, 0), (None, None, None)]
    found = {r["column_name"]: r for r in profile.numeric(spark.createDataFrame(rows, "a double, b double, c long").repartition(5)).collect()}
    assert Decimal(found["a"]["exact_sum"]) == sum(Decimal(repr(x)) for x in amounts + odd)
    assert Decimal(found["b"]["exact_sum"]) == sum(Decimal(repr(x)) for x in amounts)
    assert int(found["c"]["exact_sum"]) == sum(r[2] for r in rows if r[2] is not None)
    assert (found["a"]["nans"], found["a"]["infinities"], found["a"]["inexact"], found["b"]["inexact"]) == (1, 1, 0, 0)
    assert found["a"]["zeros"] == 2 + amounts.count(0.0) and found["a"]["negatives"] == sum(x < 0 for x in amounts + odd)
    none = profile.numeric(spark.createDataFrame([(None,)], "a double")).first()
    assert none["exact_sum"] is None and none["mean"] is None
    few = profile.numeric(spark.createDataFrame([(1e-12,), (2.5,)], "a double")).first()
    assert (few["inexact"], few["exact_sum"]) == (1, "2.5000000000")
    single = profile.numeric(spark.createDataFrame([(0.1,), (2.5,)], "a float")).first()
    assert single["exact_sum"] == "2.6000000000"


def test_sums_of_any_size_are_exact(spark):
    """Sums of 28 digits before the point, beyond what a decimal of 38 digits holds, and just below zero and the cut."""
    big = 2.0**70
    for values in ([big] * 900 + [0.0, 0.25], [9e27] * 50 + [0.5], [-9e27] * 50 + [0.5], [-big] * 900 + [-0.1], [-1e14, 0.1], [1e14, -0.1], [-1e-10, 0.0], [-3e14, -1e-10], [1e14, 1e14, -2e14, 0.0], [-0.125, 0.1234567891]):
        found = profile.numeric(spark.createDataFrame([(v,) for v in values], "a double").repartition(3)).first()
        with localcontext(prec=80):
            want = sum(Decimal(repr(v)) for v in values)
            assert found["exact_sum"] == f"{want:.10f}" and found["inexact"] == 0
        assert math.isclose(found["mean"], float(want) / len(values), rel_tol=1e-15, abs_tol=1e-6)


def test_signed_zeros_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (-0.0,)], "a double")
    assert profile.distincts(df).first()["n_distinct"] == 2
    assert [(r["value"], r["frequency"]) for r in profile.frequent_values(df).collect()] == [("0.0", 3), ("1.0", 1)]


def test_quartiles_of_infinities(spark):
    df = spark.createDataFrame([(1.0,), (math.inf,), (math.inf,), (math.inf,)], "a double")
    assert tuple(profile.quartiles(df).first())[1:] == ("1.0000000000", "Infinity", "Infinity")
    low = spark.createDataFrame([(-math.inf,), (-math.inf,), (-math.inf,), (2.0,)], "a double")
    assert tuple(profile.quartiles(low).first())[1:] == ("-Infinity", "-Infinity", "-Infinity")


def test_values_are_gathered_in_parts_that_grow_with_the_input(spark, data, monkeypatch):
    """More parts for a larger input, none of them empty or heavy though all rows are equal; the counts stay."""
    rows = spark.read.parquet(f"{data}/lineitem.parquet")
    want = sorted(map(tuple, profile.distincts(rows).collect())), sorted(map(tuple, profile.frequent_values(rows).collect()))
    monkeypatch.setattr(scale, "PER_PART", 4096)
    parts = scale.dealt(rows)
    assert parts.columns == rows.columns and 8 < parts.rdd.getNumPartitions() <= scale.MOST_PARTS
    same = scale.dealt(spark.range(4000, numPartitions=1).select(F.lit(1).alias("a")))
    sizes = [r["count"] for r in same.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 3 * 4000 / same.rdd.getNumPartitions()
    assert want == (sorted(map(tuple, profile.distincts(rows).collect())), sorted(map(tuple, profile.frequent_values(rows).collect())))


def test_sketches_are_near(spark):
    """A sketch is off by a tenth rarely, not once in twenty times."""
    df = spark.range(6000).select(*[F.xxhash64(F.lit(i), "id").alias(f"c{i}") for i in range(12)])
    assert all(abs(r["n_distinct"] - 6000) <= 300 for r in profile.distincts(df, approximate=True).collect())
