"""Inputs of the queries, in Spark and as DuckDB SQL: fixture tables, the perturbed pair, and inline rows."""

from __future__ import annotations

import datetime as dt
import math
import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions.canon import COLUMN_VERSION, ROW_VERSION, SLICE_WIDTH, SLICES

#: Categories of the fixture tables' columns, in physical order: i integer, f floating, s text, t time.
TABLES = {
    "region": "r_regionkey:i r_name:s", "nation": "n_nationkey:i n_name:s n_regionkey:i",
    "customer": "c_custkey:i c_name:s c_nationkey:i c_acctbal:f c_mktsegment:s",
    "supplier": "s_suppkey:i s_name:s s_nationkey:i s_acctbal:f",
    "part": "p_partkey:i p_name:s p_brand:s p_type:s p_size:i p_retailprice:f",
    "orders": "o_orderkey:i o_custkey:i o_orderstatus:s o_totalprice:f o_orderdate:t o_orderpriority:s",
    "lineitem": "l_orderkey:i l_partkey:i l_suppkey:i l_linenumber:i l_quantity:f l_extendedprice:f l_discount:f l_tax:f l_returnflag:s l_linestatus:s l_shipdate:t",
    "events": "event_id:i ts:t user_id:i event_type:s value:f props:s",
    "documents": "doc_id:i text:s lang:s source:s n_chars:i",
}


def columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split(":")) for c in TABLES[table].split()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for files that a query writes and reads: below the shared one on a cluster, a temporary one in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base.rstrip('/')}/sieveline-{name}-{uuid.uuid4().hex}" if base else tempfile.mkdtemp(prefix=f"sieveline-{name}-")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that a query wrote, in whatever store it lies."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


# DuckDB text of the canonical forms


def text_sql(c: str, kind: str) -> str:
    if kind == "f":
        return f"case when isnan({c}) then 'NaN' else cast(cast(cast({c} as varchar) as decimal(38,10)) as varchar) end"
    if kind == "t":
        return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%g')"
    return c if kind == "s" else f"cast({c} as varchar)"


def canon_sql(c: str, kind: str) -> str:
    return f"coalesce({text_sql(c, kind)}, chr(0) || 'NULL' || chr(0))"


def digest_sql(cols: Sequence[tuple[str, str]]) -> str:
    return f"sha256(concat_ws(chr(1), {', '.join(canon_sql(c, k) for c, k in cols)}))"


def slice_sql(h: str, start: int) -> str:
    return f"('0x' || substr({h}, {start}, {SLICE_WIDTH}))::BIGINT::HUGEINT"


def sums_sql(h: str, when: str = "") -> str:
    tail = f" filter (where {when})" if when else ""
    return ", ".join(f"cast(coalesce(sum({slice_sql(h, s)}){tail}, 0) as varchar) as s{i}" for i, s in enumerate(SLICES, 1))


def final_sql(n: str, *parts: str, version: str = ROW_VERSION) -> str:
    return f"sha256(concat_ws('|', '{version}', cast({n} as varchar), {', '.join(parts)}))"


def column_final_sql(c: str, kind: str) -> str:
    return f"sha256(concat_ws('|', '{COLUMN_VERSION}', cast(count(*) as varchar), cast(coalesce(sum({slice_sql(f'sha256({canon_sql(c, kind)})', 1)}), 0) as varchar)))"


# The pair: orders as the source, and a target with known differences


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with rows dropped (key % 97), changed, repeated (% 103) and added under new keys (% 101)."""
    k = F.col("o_orderkey")
    p = F.col("o_orderpriority")
    changed = source(spark, sf_dir).where(k % 97 != 0).withColumns({
        "o_totalprice": F.when(k % 7 == 0, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")),
        "o_orderdate": F.when(k % 23 == 0, F.col("o_orderdate") + F.expr("INTERVAL 5 HOURS")).otherwise(F.col("o_orderdate")),
        "o_orderpriority": F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, "").when(k % 13 == 0, F.concat(p, F.lit(" "))).when(k % 11 == 0, F.lower(p)).otherwise(p),
    })
    extra = F.explode(F.when(k % 103 == 0, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))).alias("add")
    rows = changed.select("*", extra)
    added = changed.where(k % 101 == 0).withColumn("o_orderkey", k + 10_000_000)
    return rows.drop("add").unionByName(added)


TARGET_SQL = """
chg as (select o_orderkey, o_custkey, o_orderstatus,
  case when o_orderkey % 7 = 0 then o_totalprice + 0.01::double else o_totalprice end as o_totalprice,
  case when o_orderkey % 23 = 0 then o_orderdate + interval 5 hours else o_orderdate end as o_orderdate,
  case when o_orderkey % 17 = 0 then null when o_orderkey % 19 = 0 then '' when o_orderkey % 13 = 0 then o_orderpriority || ' '
       when o_orderkey % 11 = 0 then lower(o_orderpriority) else o_orderpriority end as o_orderpriority
  from orders where o_orderkey % 97 <> 0),
tgt as (select * from chg union all select * from chg where o_orderkey % 103 = 0
  union all select o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from chg where o_orderkey % 101 = 0)
"""


def _canon_cte(name: str, of: str) -> str:
    return f"{name} as (select {', '.join(f'{canon_sql(c, k)} as {c}' for c, k in columns('orders'))} from {of})"


#: Canonical sides _s and _f without rows of repeated keys, and _j, their join.
DIFF_SQL = (
    f"with {TARGET_SQL}, {_canon_cte('cs', 'orders')}, {_canon_cte('cf', 'tgt')}, "
    "rep as (select o_orderkey from cs group by 1 having count(*) > 1 union select o_orderkey from cf group by 1 having count(*) > 1), "
    "_s as (select * from cs where o_orderkey not in (select o_orderkey from rep)), _f as (select * from cf where o_orderkey not in (select o_orderkey from rep)), "
    "_j as (select _s.o_orderkey, " + ", ".join(f"_s.{c} as s_{c}, _f.{c} as f_{c}" for c, _ in columns("orders")[1:]) + " from _s join _f using (o_orderkey))"
)


# Inline rows for both engines

_DUCK = {"string": "varchar", "int": "integer", "long": "bigint", "bigint": "bigint", "double": "double", "boolean": "boolean", "timestamp_ntz": "timestamp", "date": "date", "array<string>": "varchar[]", "array<long>": "bigint[]", "binary": "blob"}


def _literal(v: object) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, (int, float)):
        return repr(v) if isinstance(v, int) or math.isfinite(v) else f"'{v}'"
    if isinstance(v, (list, tuple)):
        return "[" + ", ".join(map(_literal, v)) + "]"
    if isinstance(v, bytes):
        return "'" + "".join(f"\\x{b:02X}" for b in v) + "'::blob"
    if isinstance(v, (dt.datetime, dt.date)):
        v = v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    return "'" + str(v).replace("'", "''") + "'"


class Inline:
    """A small table of given rows."""

    def __init__(self, schema: str, *rows: tuple) -> None:
        self.schema, self.rows = schema, rows
        self.names = [c.strip().split()[0] for c in schema.split(",")]
        self.types = [c.strip().split()[1] for c in schema.split(",")]

    def df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), self.schema)

    @property
    def sql(self) -> str:
        rows = ", ".join("(" + ", ".join(f"cast({_literal(v)} as {_DUCK[t]})" for v, t in zip(r, self.types, strict=True)) + ")" for r in self.rows)
        return f"(select * from (values {rows}) v({', '.join(self.names)}))"


class Derived:
    """A register (of flows, runs, states, ...) made from the given tables by one SELECT that both engines read alike.

    ``names``: columns whose names one engine reserves, renamed for Spark. ``duck``: what DuckDB writes in another way.
    """

    def __init__(self, select: str, duck: dict[str, str] | None = None, **names: str) -> None:
        self.select, self.duck, self.names = select, duck or {}, names

    def df(self, spark: SparkSession, d: str) -> DataFrame:
        text, used = self.select.replace("{", "{{").replace("}", "}}"), {}
        for name in TABLES:
            text, n = re.subn(rf"\b(from|join) {name}\b", rf"\1 {{{name}}}", text)
            if n:
                used[name] = table(spark, d, name)
        return spark.sql(text, **used).withColumnsRenamed(self.names)

    @property
    def sql(self) -> str:
        text = self.select
        for spark, duck in self.duck.items():
            text = text.replace(spark, duck)
        return f"({text})"


def pick(number: str, *values: object) -> str:
    """SQL for the value at a number from 0 on; texts that begin with = are SQL themselves."""
    told = [v[1:] if isinstance(v, str) and v.startswith("=") else _literal(v) for v in values]
    return f"case {number} " + " ".join(f"when {i} then {v}" for i, v in enumerate(told[:-1])) + f" else {told[-1]} end"


def time(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)
