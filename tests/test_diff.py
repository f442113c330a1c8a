"""Keys and differences on small pairs with known causes."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from pyspark.sql import functions as F

from sieveline.operators import diff, keys, profile


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


SCHEMA = "id int, kind string, person string, amount decimal(10,2), seen timestamp_ntz, note string, code string, day string"
SOURCE = [
    (1, "A", "Marta", 10.50, at("2024-01-01 10:00:00"), "x", "007", "2024-01-05"), (1, "B", "Eva ", 20.00, at("2024-01-02 10:00:00"), "y", "008", "2024-02-05"),
    (2, "A", "PABLO", 30.25, at("2024-02-01 10:00:00"), None, "009", "2024-03-05"), (2, "B", "Andrés", 40.00, at("2024-02-02 10:00:00"), "z", "010", "2024-04-05"),
    (3, "A", "Peña", 50.00, at("2024-03-01 10:00:00"), "w", "011", "2024-05-05"), (4, "A", "left", 1.0, at("2024-03-02 10:00:00"), "v", "012", "2024-06-05"),
]
TARGET = [
    (1, "A", "Marta", 10.5, at("2024-01-01 15:00:00"), "x", "7", "05/01/2024"), (1, "B", "Eva", 20.00, at("2024-01-02 15:00:00"), "y", "008", "2024-02-05"),
    (2, "A", "pablo", 30.26, at("2024-02-01 15:00:00"), "", "009", "2024-03-05"), (2, "B", "Andres", 40.00, at("2024-02-02 10:00:00"), "z", "010", "2024-04-05"),
    (3, "A", "PeÃ±a", 50.00, at("2024-03-01 10:00:00"), "w", "011", "2024-05-05"), (5, "A", "right", 1.0, at("2024-03-03 10:00:00"), "u", "013", "2024-07-05"),
]


def pair(spark):
    from decimal import Decimal

    fix = lambda rows: [(*r[:3], Decimal(str(r[3])), *r[4:]) for r in rows]
    return spark.createDataFrame(fix(SOURCE), SCHEMA), spark.createDataFrame(fix(TARGET), SCHEMA)


def test_composite_key_and_causes(spark):
    s, f = pair(spark)
    key = keys.discover(s, f)
    assert (sorted(key.columns), key.origin) == (["id", "kind"], "composite_2")
    d = diff.Diff(s, f, key.columns, "seen")
    r = d.summary().first()
    assert (r["only_source"], r["only_target"], r["common"], r["changed"]) == (1, 1, 5, 5)
    causes = defaultdict(dict)
    for x in d.patterns().collect():
        causes[x["column_name"]][x["pattern"]] = x["n"]
    assert causes == {
        "person": {"spaces": 1, "case": 1, "accents": 1, "mojibake": 1}, "amount": {"numeric_difference": 1}, "seen": {"time_shift": 3},
        "note": {"null_vs_blank": 1}, "code": {"leading_zeros": 1}, "day": {"same_instant_other_format": 1},
    }
    assert d.numeric_ranges().first()["max_abs"].startswith("0.01")
    assert [(x["hours"], x["n"]) for x in d.hour_offsets().collect()] == [(5.0, 3)]


def test_declared_key_that_repeats(spark):
    s, f = pair(spark)
    key = keys.discover(s, f, declared=["id"])
    assert key.origin == "composite_2" and "repeats" in key.notes[0]
    a, b = diff.multiset(s, f)
    assert (a.count(), b.count()) == (6, 6)


def test_same_number_other_scale(spark):
    s, f = (spark.createDataFrame(rows, "k int, v string") for rows in ([(1, "1.50"), (2, "2")], [(1, "1.5"), (2, "2.00")]))
    assert [(r["pattern"], r["n"]) for r in diff.Diff(s, f, ["k"]).patterns().collect()] == [("same_number_other_scale", 2)]


def test_almost_unique_key(spark):
    s = spark.createDataFrame([(f"k{i}", i % 3) for i in range(40)] + [("k5", 9)], "id_x string, v int")
    f = spark.createDataFrame([(f"k{i}", 99 if i == 7 else i % 3) for i in range(1, 41)], "id_x string, v int")
    key = keys.discover(s, f)
    assert (key.columns, key.origin) == (["id_x"], "almost_unique")
    d = diff.Diff(s, f, ["id_x"])
    r = d.summary().first()
    assert (r["repeated_keys"], r["repeated_source"], r["repeated_target"]) == (1, 2, 1)
    assert (r["only_source"], r["only_target"], r["common"]) == (1, 1, 38)
    assert d.columns_summary().first()["n_different"] == 1


def test_shifted_column_and_nulls(spark):
    schema = "k int, code string, name string, extra string"
    s = spark.createDataFrame([(1, "A1", "x", "p"), (2, "A2", "y", "q"), (3, "A3", "z", None)], schema)
    f = spark.createDataFrame([(1, "x", "x", None), (2, "y", "y", None), (3, "z", "z", "r")], schema)
    d = diff.Diff(s, f, ["k"])
    assert [tuple(r) for r in d.column_shift().collect()] == [("code", "name", 3)]
    assert {r["pattern"]: r["n"] for r in d.patterns().where("column_name = 'extra'").collect()} == {"null_in_target": 2, "null_in_source": 1}


def test_empty_side_has_no_key(spark):
    s, f = pair(spark)
    assert keys.discover(s, f.limit(0)).origin == "no_key"


def test_null_keys_pair_with_nothing(spark):
    s = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "k int, v string")
    f = spark.createDataFrame([(1, "a"), (None, "x")], "k int, v string")
    d = diff.Diff(s, f, ["k"])
    assert tuple(d.summary().first()) == (0, 0, 1, 0, 0, 0, 0)
    assert {tuple(r) for r in d.null_keys().collect()} == {("source", 2), ("target", 1)}


def test_exact_tests_of_keys_are_bounded(spark, monkeypatch):
    """Pairs that are nearly unique pass the sketches; no more than the stated number are tested."""
    tests = []
    unique = keys.is_unique
    monkeypatch.setattr(keys, "is_unique", lambda df, c: tests.append(c) or unique(df, c))
    rows = spark.range(400).selectExpr("id", *[f"cast((id * {p}) % 40 as int) as c{i}" for i, p in enumerate((1, 3, 7, 9, 11, 13))]).drop("id")
    rows = rows.unionByName(rows.limit(4))
    keys.discover(rows, rows)
    assert len(tests) <= 2 * keys.TESTS


def test_brackets_are_narrowed(spark, monkeypatch):
    """Quartiles stay exact when brackets have to be narrowed several times, also around values that repeat."""
    monkeypatch.setattr(profile, "INSIDE", 3)
    monkeypatch.setattr(profile, "BRACKET", 50)
    df = spark.range(5000).selectExpr("cast(id * 7919 % 5003 as double) as a", "cast(id % 3 as int) as b", "case when id % 2 = 0 then double('infinity') else 1.0 end as c")
    got = {r["column_name"]: (r["p25"], r["p50"], r["p75"]) for r in profile.quartiles(df).collect()}
    a = sorted(i * 7919 % 5003 for i in range(5000))
    assert [float(x) for x in got["a"]] == [a[1249], a[2499], a[3749]]
    assert got["b"] == ("0", "1", "2") and got["c"][:2] == ("1.0000000000", "1.0000000000") and got["c"][2] == "Infinity"


def test_sides_are_hashed_not_sorted(spark):
    s, f = pair(spark)
    plan = diff.Diff(s, f, ["id", "kind"]).summary()._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan


def test_changed_rows_are_found_without_a_shuffle_of_the_others(spark):
    """30 of 20,000 rows differ, besides NULL and repeated keys; whole rows would be 20 MB."""
    wide = spark.range(20000).select(F.when(F.col("id") != 5, F.col("id")).alias("id"), *[F.sha2(F.concat_ws("-", "id", F.lit(i)), 256).alias(f"w{i}") for i in range(8)])
    target = wide.withColumn("w0", F.when(F.col("id").isNull() | (F.col("id") % 500 == 0), F.col("w7")).otherwise(F.col("w0")))
    d = diff.Diff(wide.unionByName(wide.where("id between 1000 and 5999")), target, ["id"])
    assert 30 <= d._sieved(d.given[1], d._sieve("changed")).count() <= 40
    context = spark.sparkContext
    context.setJobGroup("few", "")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as in tables that are too large for it
    try:
        found = d.column_shift().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        context.setLocalProperty("spark.jobGroup.id", None)
    assert [tuple(r) for r in found] == [("w0", "w7", 30)]
    stages = {s for j in context.statusTracker().getJobIdsForGroup("few") for s in context.statusTracker().getJobInfo(j).stageIds if context.statusTracker().getStageInfo(s)}
    assert 0 < sum(context._jsc.sc().statusStore().lastStageAttempt(s).shuffleWriteBytes() for s in stages) < 4_000_000


def test_wide_rows_keep_to_methods_that_the_jvm_compiles(spark):
    """One generated method for all columns of a wide row would be interpreted."""
    wide = spark.range(3).select("id", *[F.concat(F.lit(f"{i}-"), "id").alias(f"c{i}") for i in range(50)])
    found = diff.Diff(wide, wide.withColumn("c0", F.col("c49")), ["id"]).column_shift().collect()
    assert [(r["column_name"], r["source_column"], r["n"]) for r in found] == [("c0", "c49", 3)]
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
