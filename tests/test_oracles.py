"""Every query of the library against DuckDB on the same files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from sieveline.plans import registry


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v: object) -> str:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_duckdb(spark, data, duck, name):
    df = registry.QUERIES[name](spark, data)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    cursor = duck.execute(registry.ORACLES[name])
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    want = sorted(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, data, name):
    assert registry.QUERIES[name](spark, data).count() > 0


def test_delta_live_files(spark, data):
    """Files added, removed, and added again with a deletion vector of three rows."""
    got = {r["path"]: (r["rows"], r["dv"], r["dv_rows"]) for r in registry.QUERIES["delta_live_files"](spark, data).collect()}
    nations = {r["c_custkey"]: r["c_nationkey"] for r in spark.read.parquet(f"{data}/customer.parquet").collect()}
    assert got == {f"p{k}": (n, k % 5 == 0, 3 if k % 5 == 0 else None) for k, n in nations.items() if k % 7 and (k % 5 == 0 or k % 3)}
