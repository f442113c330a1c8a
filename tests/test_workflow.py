"""Flow definitions and the small records around them."""

from __future__ import annotations

import datetime as dt

import pytest

from sieveline.functions import exprlang
from sieveline.functions.types import change_class
from sieveline.operators import flowdefs, workflow

COPY = {"name": "copy", "type": "Copy", "typeProperties": {
    "source": {"datasetSettings": {"typeProperties": {"location": {"folderPath": {"value": "@concat('in/', pipeline().parameters.env)"}, "fileName": "@{item().name}.csv"}}}},
    "sink": {"datasetSettings": {"typeProperties": {"location": {"folderPath": "out/day"}}}},
}}
FLOW = {"properties": {"activities": [
    {"name": "each", "type": "ForEach", "typeProperties": {"activities": [COPY]}},
    {"name": "if", "type": "IfCondition", "typeProperties": {"ifTrueActivities": [{"name": "yes", "type": "Wait"}], "ifFalseActivities": [{"name": "no", "type": "Wait"}]}},
    {"name": "call", "type": "InvokePipeline", "typeProperties": {"pipelineId": "p2"}}, {"name": "gone", "type": "InvokePipeline", "typeProperties": {"pipelineId": "p3"}},
]}}
CHILD = {"activities": [{"name": "inner", "type": "Wait"}, {"name": "self", "type": "InvokePipeline", "typeProperties": {"pipelineId": "p2"}}]}


def test_flatten():
    got = [(a.name, a.inside, a.branch, a.cut) for a in flowdefs.flatten(FLOW["properties"]["activities"], {"p2": CHILD}.get)]
    assert got == [
        ("each", (), None, None), ("copy", ("each",), None, None), ("if", (), None, None), ("yes", ("if",), "true", None), ("no", ("if",), "false", None),
        ("call", (), None, None), ("inner", ("call",), None, None), ("self", ("call",), None, "cycle"), ("gone", (), None, "p3 can't be read"),
    ]
    deep = {"name": "x", "type": "ForEach", "typeProperties": {"activities": []}}
    for _ in range(9):
        deep = {"name": "x", "type": "ForEach", "typeProperties": {"activities": [deep]}}
    assert [a.cut for a in flowdefs.flatten([deep])][-1] == "deeper than 6 levels"


def test_io():
    rows = flowdefs.io_of(FLOW, {"pipeline": {"parameters": {"env": "qa"}}})
    assert [(r["role"], r["path"], r["per_item"], r["unresolved"]) for r in rows] == [("input", "in/qa/<item.name>.csv", True, ["placeholder"]), ("output", "out/day", False, [])]


def test_roles():
    files = {"job/extract.py": "df = spark.read.table(params.sales_table)\nx = params.shared_path", "job/load.py": "df.write.save(params.out_path)\ny = params.shared_path; params.limit", "job/params.py": "class Params:\n    out_path: str\n    sales_write_mode: str = 'append'"}
    roles = flowdefs.roles_from_code(files)
    assert (roles.inputs, roles.outputs, roles.both, roles.modes) == (["sales_table"], ["out_path"], ["shared_path"], ["sales_write_mode"])
    fixed = flowdefs.correct_roles([{"flag": "--sales-table", "role": "output"}, {"flag": "--other", "role": "input"}], roles)
    assert [(r["role"], r["changed"], r["from_code"]) for r in fixed] == [("input", True, True), ("input", False, False)]
    modes = flowdefs.write_modes(["--sales-write-mode", "Append", "--mode", "overwrite", "--out-path", "x"])
    assert (flowdefs.mode_of("--sales-path", modes), flowdefs.mode_of("--out-path", modes)) == ("append", "overwrite")
    assert flowdefs.used_parameters("params.a +") == {"a"}


def test_gates():
    gates = workflow.Gates(["review", "client", "approval"])
    with pytest.raises(ValueError):
        gates.decide("client", "APPROVED", "f1", "x")
    for g in gates.order:
        gates.decide(g, "APPROVED", "f1", "x")
    assert gates.complete("f1") and not gates.complete("f2")


def test_records():
    assert workflow.advance(None, "DOWNLOADED") == "DOWNLOADED" and workflow.advance("COMPARED", "MEASURED") == "MEASURED"
    with pytest.raises(ValueError):
        workflow.advance("DOWNLOADED", "PUBLISHED")
    assert workflow.fits(100, 50, 10, 40) and not workflow.fits(100, 50, 20, 40)
    assert workflow.pointer({"a": {"b": [1, {"c": 2}]}}, "a.b[1].c") == 2
    with pytest.raises(KeyError):
        workflow.pointer({"a": []}, "a[0]")
    assert workflow.thousands(1234567) == "1.234.567"
    assert workflow.missing_fields({"a": 1, "b": ""}, ["a", "b", "c.d"]) == ["b", "c.d"]
    assert workflow.reusable({"source": 1, "target": 2, "code": 3}, {"source": 1, "target": 5, "code": 9}, "code") == ["target changed"]
    assert workflow.mermaid([("a", "b")]).splitlines()[-1] == "  n0 --> n1"


_NOW = dt.datetime(2024, 3, 31, 12, 30, 0, tzinfo=dt.timezone.utc)
EXPRESSIONS = [
    ("@concat('a', 'b', string(1))", "ab1"), ("@toUpper(trim('  x '))", "X"), ("@substring('abcdef', 1, 3)", "bcd"), ("@if(greater(2, 1), 'yes', 'no')", "yes"), ("@add(2, mul(3, 4))", "14"),
    ("@div(7, 2)", "3"), ("@mod(7, 4)", "3"), ("@formatDateTime('2024-01-05T10:11:12Z', 'yyyy-MM-dd HH:mm')", "2024-01-05 10:11"), ("@addDays('2024-02-28T00:00:00Z', 2, 'yyyyMMdd')", "20240301"),
    ("@utcNow('yyyy/MM/dd')", "2024/03/31"), ("@getPastTime(1, 'Month', 'yyyy-MM-dd')", "2024-02-29"), ("@startOfMonth('2024-05-17T01:02:03Z', 'yyyy-MM-dd')", "2024-05-01"), ("@join(createArray('x', 'y'), '-')", "x-y"),
    ("@last(split('a/b/c', '/'))", "c"), ("@coalesce(null, 'z')", "z"), ("@pipeline().parameters.env", "qa"), ("Files/@{pipeline().parameters.env}/@{item().name}", "Files/qa/<item.name>"),
    ("@variables('day')", "05"), ("@json('{\"a\": [1, 2]}').a[1]", "2"), ("@empty('')", "True"), ("@not(equals(1, 2))", "True"), ("@contains('Hello', 'ell')", "True"), ("@dayOfWeek('2024-03-31T00:00:00Z')", "0"),
    ("@max(1, 5, 3)", "5"), ("@length(union(createArray(1, 2), createArray(2, 3)))", "3"), ("@@literal", "@literal"), ("@convertFromUtc('2024-01-05T10:00:00Z', 'SA Pacific Standard Time', 'HH:mm')", "05:00"), ("plain", "plain"),
]


@pytest.mark.parametrize(("expression", "result"), EXPRESSIONS)
def test_expressions(expression, result):
    value = exprlang.evaluate(expression, {"pipeline": {"parameters": {"env": "qa"}}, "variables": {"day": "05"}}, _NOW)
    assert (str(value) if isinstance(value, exprlang.Hole) else exprlang._text(value)) == result


def test_type_changes():
    changes = [
        ("varchar(20)", "text", "TEXT_EQUIVALENT"), ("integer", "bigint", "WIDENING"), ("bigint", "integer", "INCOMPATIBLE"), ("numeric(10,2)", "numeric(12,2)", "PRECISION"), ("date", "timestamp without time zone", "WIDENING"),
        ("text", "text", "SAME"), ("integer", "numeric(10,0)", "WIDENING"), ("boolean", "text", "INCOMPATIBLE"), ("real", "double precision", "WIDENING"),
    ]
    assert [change_class(a, b) for a, b, _ in changes] == [c for _, _, c in changes]


def test_deletion_vector_files(spark):
    from pyspark.sql import functions as F

    from sieveline.sources.scans import deletion_vector_file

    rows = [("ab" + "0" * 20,), ("ab^-aqEH.-t@S}K{vb[*k^",), ("0" * 20,), ("short",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(deletion_vector_file(F.col("x"))).collect()]
    zero = "deletion_vector_00000000-0000-0000-0000-000000000000.bin"
    assert got == [f"ab/{zero}", "ab/deletion_vector_d2c639aa-8816-431a-aaf6-d3fe2512ff61.bin", zero, None, None]


def test_parts_of_evidence_grow_with_the_rows(spark, data, monkeypatch):
    """No task holds more as the tables grow: more rows, more parts, and each branch of the union has tasks of its own."""
    from sieveline.functions import scale
    from sieveline.plans.evidence import run_evidence_checks

    before = run_evidence_checks(spark, data)
    monkeypatch.setattr(scale, "PART_ROWS", 500)
    after = run_evidence_checks(spark, data)
    assert after.rdd.getNumPartitions() >= 9 * 15 and sorted(after.collect()) == sorted(before.collect())
