"""Sinks, readers, names, types and the expression language."""

from __future__ import annotations

import json

import pytest

from sieveline.functions import exprlang
from sieveline.functions.types import common_type
from sieveline.operators import compare
from sieveline.sources import scans, sinks


def test_sinks(tmp_path):
    assert json.loads(sinks.document(tmp_path / "a" / "r.json", {"x": 1}).read_text()) == {"x": 1}
    assert sinks.unused_name(tmp_path / "a", "r").name == "r_v2.json"
    (tmp_path / "a" / "r_v7.json").write_text("{}")
    assert sinks.unused_name(tmp_path / "a", "r").name == "r_v8.json"
    assert [sinks.append_log(tmp_path / "log.jsonl", {"a": i}) for i in range(3)] == [1, 2, 3]


def test_read_any(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p.parquet"))
    df, how, errors = scans.read_any(spark, str(tmp_path / "p.parquet"))
    assert (how, df.count(), errors) == ("parquet", 3, {})
    df, how, errors = scans.read_any(spark, str(tmp_path / "missing"))
    assert df is None and "parquet" in errors


def test_delta_with_checkpoint(spark, tmp_path):
    log = tmp_path / "t" / "_delta_log"
    log.mkdir(parents=True)
    add = lambda p: json.dumps({"add": {"path": p, "size": 1, "modificationTime": 5, "stats": '{"numRecords": 2}'}})
    (log / f"{0:020d}.json").write_text(add("old.parquet"))
    spark.createDataFrame([(("a.parquet", 1, 5, '{"numRecords": 3}'),)], "add struct<path:string,size:long,modificationTime:long,stats:string>").coalesce(1).write.parquet(str(tmp_path / "cp"))
    part = next((tmp_path / "cp").glob("part-*.parquet"))
    part.rename(log / f"{1:020d}.checkpoint.parquet")
    (log / f"{2:020d}.json").write_text(add("b.parquet") + "\n" + json.dumps({"commitInfo": {"timestamp": 9, "operation": "WRITE"}}))
    actions = scans.delta_actions(spark, str(tmp_path / "t"))
    assert {(r["path"], r["rows"]) for r in scans.delta_live_files(actions).collect()} == {("a.parquet", 3), ("b.parquet", 2)}
    assert {(r["version"], r["operation"]) for r in scans.delta_commits(actions).where("version = 2").collect()} == {(2, "WRITE")}


def test_deletion_vectors_are_refused(spark, tmp_path):
    log = tmp_path / "t" / "_delta_log"
    log.mkdir(parents=True)
    (log / f"{0:020d}.json").write_text(json.dumps({"add": {"path": "a.parquet", "size": 1, "deletionVector": {"storageType": "u"}}}))
    with pytest.raises(ValueError, match="deletion vectors"):
        scans.delta_table(spark, str(tmp_path / "t"))


def test_names_and_types():
    assert compare.normalised("Código_Área 1") == "codigoarea1"
    assert [common_type(x) for x in ("NUMERIC", "numeric(10, 2)", "int4", "UUID", "integer[]", "HUGEINT")] == ["decimal(38,18)", "decimal(10,2)", "int", "string", "nested", "decimal(38,0)"]


def test_holes_stay_holes():
    assert isinstance(exprlang.evaluate("@toUpper(activity('x').output.value)"), exprlang.Hole)
    assert exprlang.evaluate("a/@{activity('x').output.value}/b") == "a/<activity(x).output.value>/b"
    assert exprlang.evaluate("@pipeline()?.nothing", {"pipeline": {}}) is None
    with pytest.raises(ValueError):
        exprlang.evaluate("@concat('a'")
