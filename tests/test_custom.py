"""Python data sources, gates, cited figures and collated bounds."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sieveline.operators import approvals, ops
from sieveline.sources import custom


def test_a_filter_on_the_folder_opens_no_other(spark, tmp_path):
    for name in ("k=1", "k=2", "k=3", "_hidden", ".dot"):
        (tmp_path / name / "deep").mkdir(parents=True)
        (tmp_path / name / "a.parquet").write_bytes(b"x" * 5)
        (tmp_path / name / "deep" / "b.csv").write_bytes(b"yy")
        (tmp_path / name / "_SUCCESS").write_bytes(b"")
    (tmp_path / "top.csv").write_bytes(b"t")
    files = custom.files_below(spark, str(tmp_path))
    assert {(r["folder"], r["name"], r["n_bytes"]) for r in files.collect()} == {(f"k={i}", n, s) for i in (1, 2, 3) for n, s in (("a.parquet", 5), ("b.csv", 2))} | {("", "top.csv", 1)}
    one = files.where("folder = 'k=2' and name like '%.csv'")
    assert [r["name"] for r in one.collect()] == ["b.csv"] and one.rdd.getNumPartitions() == 1
    reader = custom.ListingReader(str(tmp_path))
    assert list(reader.pushFilters([custom.EqualTo(("folder",), "k=2"), custom.GreaterThan(("modified",), 0)])) == [custom.GreaterThan(("modified",), 0)]
    assert [p.path.rsplit("/", 1)[1] for p in reader.partitions()] == ["k=2"]
    assert files.where("folder = 'none'").collect() == [] and files.where("n_bytes > 2 and folder like 'k=%'").count() == 3
    assert {r["name"] for r in files.where(F.col("folder").isin("k=1", "k=3") & (F.col("n_bytes") <= 2)).collect()} == {"b.csv"}
    assert files.where(F.year("modified") > 2000).count() == 7


def test_run_log_takes_all_of_a_batch_or_none(spark, tmp_path):
    at = str(tmp_path / "log")
    rows = spark.range(20).select("id", F.concat(F.lit("é"), "id").alias("what")).repartition(3)
    custom.append_to_log(rows, at)
    read = lambda: custom.read_log(spark, at, "id long, what string")
    assert sorted((r["id"], r["what"]) for r in read().collect()) == [(i, f"é{i}") for i in range(20)]

    def broken(batches):
        for pdf in batches:
            if (pdf["id"] == 7).any():
                raise ValueError("killed")
            yield pdf

    with pytest.raises(Exception, match="killed"):
        custom.append_to_log(rows.mapInPandas(broken, rows.schema), at)
    assert read().count() == 20 and len(list((tmp_path / "log" / "batches").iterdir())) == 1
    custom.append_to_log(rows.limit(0), at)
    custom.append_to_log(spark.range(1).selectExpr("cast(99 as bigint) id", "cast(null as string) what"), at)
    assert read().count() == 21 and read().select("batch").distinct().count() == 2
    order = read().orderBy("batch", "part", "line").collect()
    assert order[-1]["id"] == 99 and len({(r["batch"], r["part"], r["line"]) for r in order}) == 21
    with pytest.raises(Exception, match="appended"):
        rows.write.format("run_log").mode("overwrite").option("path", at).save()


def test_files_of_repeated_tasks_are_removed(tmp_path):
    writer = custom.LogWriter(str(tmp_path), ["a"])
    folder = tmp_path / "entries" / writer.batch
    folder.mkdir(parents=True)
    for name in ("000000-1.jsonl", "000000-2.jsonl", "000001-3.jsonl"):
        (folder / name).write_text("{}\n")
    writer.commit([custom.Part(str(folder / "000000-2.jsonl"), 1), custom.Part(str(folder / "000001-3.jsonl"), 1), None])
    assert sorted(p.name for p in folder.iterdir()) == ["000000-2.jsonl", "000001-3.jsonl"]
    manifest = json.loads(next((tmp_path / "batches").glob("*.json")).read_text())
    assert manifest["entries"] == 2 and len(manifest["files"]) == 2


def test_gates_fall_with_their_content(spark):
    order = spark.createDataFrame([(f, i, g, s) for f in ("x", "y") for i, g, s in ((1, "a", "t1"), (2, "b", "t2"), (3, "c", "t1"))], "flow string, place int, gate string, subject string")
    said = [(1, "x", "a", "APPROVED", "p", "f1"), (2, "x", "b", "APPROVED", "p", "f2"), (3, "x", "c", "APPROVED", "q", "f1"), (4, "y", "a", "APPROVED", "p", "f1"), (5, "y", "b", "REJECTED", "p", "f2"), (6, "y", "c", "APPROVED", "p", "f1")]
    decisions = spark.createDataFrame(said, "seq long, flow string, gate string, decision string, by string, fingerprint string")
    now = lambda a, b: spark.createDataFrame([("t1", a), ("t2", b)], "subject string, fingerprint string")
    valid = lambda d, c: {(r["flow"], r["gate"]): r["valid"] for r in approvals.gates(order, d, c).collect()}
    assert valid(decisions, now("f1", "f2")) == {("x", "a"): True, ("x", "b"): True, ("x", "c"): True, ("y", "a"): True, ("y", "b"): False, ("y", "c"): False}
    assert valid(decisions, now("f1", "new")) == {("x", "a"): True, ("x", "b"): False, ("x", "c"): False, ("y", "a"): True, ("y", "b"): False, ("y", "c"): False}
    later = decisions.unionByName(spark.createDataFrame([(7, "x", "b", "APPROVED", "p", "new"), (8, "y", "b", "APPROVED", "p", "new")], decisions.schema))
    assert set(valid(later, now("f1", "new")).values()) == {True}
    assert valid(decisions.limit(0), now("f1", "f2")) == dict.fromkeys([(f, g) for f in "xy" for g in "abc"], False)


def test_cited_figures(spark):
    document = {"a": {"b": [1, {"c": 2.5}]}, "t": "x", "n": None}
    reports = spark.createDataFrame([("r", json.dumps(document)), ("s", "{}")], "report string, document string")
    said = [("r", "a.b[0]", "1.0"), ("r", "a.b[1].c", "2.6"), ("r", "t", "x"), ("r", "n", "0"), ("s", "t", "x"), ("gone", "t", "x")]
    cited = spark.createDataFrame(said, "report string, pointer string, cited string")
    found = {(r["report"], r["pointer"]): r["state"] for r in approvals.cited_figures(reports, ["a.b[0]", "a.b[1].c", "t", "n"], cited).collect()}
    assert found == {("r", "a.b[0]"): "MATCHES", ("r", "a.b[1].c"): "FALSIFIED", ("r", "t"): "MATCHES", ("r", "n"): "MISSING", ("s", "t"): "MISSING", ("gone", "t"): "MISSING"}
    near = approvals.cited_figures(reports, ["a.b[1].c"], cited.where("pointer = 'a.b[1].c'"), tolerance=0.2).first()
    assert near["state"] == "MATCHES"


def test_bounds_by_collation(spark):
    chunks = spark.createDataFrame([("c", 2, 2, "Beta", "alpha", 1), ("c", 1, 1, "ALFA", "zeta", 2), ("c", 1, 0, None, None, None)], "column_name string, n long, non_null long, low string, high string, total long")
    by_case, by_bytes = ops.combine_chunks(chunks, "UTF8_LCASE").first(), ops.combine_chunks(chunks).first()
    assert (by_case["low"], by_case["high"], by_case["n"]) == ("ALFA", "zeta", 4)
    assert (by_bytes["low"], by_bytes["high"]) == ("ALFA", "zeta")
    mixed = spark.createDataFrame([("c", 1, 1, "beta", "beta", 1), ("c", 1, 1, "ALFA", "Zeta", 1), ("c", 1, 1, "Gamma", "omega", 1)], chunks.schema)
    assert (ops.combine_chunks(mixed, "UTF8_LCASE").first()["high"], ops.combine_chunks(mixed).first()["high"]) == ("Zeta", "omega")


def test_as_of_over_buckets(spark):
    """The last commit at or before each run, in and across buckets, with ties, nulls and keys without commits."""
    import datetime as dt
    import random

    from sieveline.operators import lineage

    rng, day = random.Random(9), dt.datetime(2024, 1, 1)
    at = lambda: day + dt.timedelta(minutes=rng.randrange(40)) + dt.timedelta(hours=rng.choice([0, 1, 30, 31, 90]))
    commits = [(rng.choice(["a", "b", None]), at(), i) for i in range(80)]
    runs = [(rng.choice(["a", "b", "c", None]), at() - dt.timedelta(hours=rng.choice([0, 1])), i) for i in range(60)]
    c, r = spark.createDataFrame(commits, "k string, ts timestamp_ntz, version long"), spark.createDataFrame(runs, "k string, start timestamp_ntz, run_id long")
    for bucket in (3600, 86_400):
        got = {x["run_id"]: (x["commit_ts"], x["version"]) for x in lineage.asof(r, c, ["k"], bucket).collect()}
        assert got == {i: max(((t, v) for k2, t, v in commits if k2 == k and t <= s), default=(None, None)) for k, s, i in runs}
