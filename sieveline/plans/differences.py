"""Queries on two sides: views, keys, differences, levels 0 and 1, comparisons and verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import patterns
from sieveline.operators import compare, diff, keys, ops, profile, rules
from sieveline.plans import common as C
from sieveline.plans import measure
from sieveline.sources import scans

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its oracle."""
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep


O = C.columns("orders")
COLS = [c for c, _ in O[1:]]
_WITH = f"with {C.TARGET_SQL} "


# Views and scans


@query("select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, cast(o_totalprice as bigint) as o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate from (select * replace (floor(o_totalprice) as o_totalprice) from orders) where o_orderdate >= timestamp '1994-01-01' and o_orderdate <= timestamp '1995-06-30'")
def view_exclude_cast_filter(spark: SparkSession, d: str) -> DataFrame:
    df = C.source(spark, d).withColumn("o_totalprice", F.floor("o_totalprice"))
    out = scans.view(df, exclude=["O_CUSTKEY", "o_orderpriority"], casts={"o_orderkey": "string", "o_totalprice": "bigint"}, date_column="o_orderdate", since="1994-01-01 00:00:00", until="1995-06-30 00:00:00")
    return out.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(f"{_WITH} select min(o_orderkey) as o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate, o_orderpriority from tgt group by o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority")
def dedup_except(spark, d):
    return scans.dedup_except(C.target(spark, d), ["o_orderkey"]).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query("select cast(n_nationkey as varchar) as id, n_name as name, cast(n_regionkey as bigint) as region from nation union all select r_name, null, null from region")
def union_by_name_cast(spark, d):
    n = C.table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("long").alias("region"))
    return scans.union_by_name([n, C.table(spark, d, "region").select(F.col("r_name").alias("id"))], as_text=["id"])


@query("select o_orderstatus, cast(count(*) as bigint) as n from orders where extract(year from o_orderdate) >= 1995 group by 1")
def partition_prune(spark, d):
    path = f"{C.folder(spark, 'parts')}/orders"
    C.source(spark, d).withColumn("year", F.year("o_orderdate")).write.mode("overwrite").partitionBy("year").parquet(path)
    return scans.parquet_folder(spark, path).where("year >= '1995'").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


CSV_ROWS = C.Derived(f"select cast(p_partkey as string) as id, {C.pick('p_partkey % 5', '=p_name', '=p_brand || chr(32) || chr(34) || p_type || chr(34) || chr(44)', '=p_name || chr(10) || p_brand', '=p_name || chr(32) || chr(241)', None)} as note from part")


@query(f"select * from {CSV_ROWS.sql}")
def csv_roundtrip(spark, d):
    path = f"{C.folder(spark, 'csv')}/notes"
    CSV_ROWS.df(spark, d).coalesce(1).write.mode("overwrite").options(header=True, quote='"', escape='"', encoding="ISO-8859-1").csv(path)
    return scans.csv(spark, path)[0]


@query("select column_name, n_rows, n_rows - nulls as non_null, low, high from (select 'id' as column_name, count(*) as n_rows, count(*) - count(id) as nulls, min(id) as low, max(id) as high from " + CSV_ROWS.sql + " union all select 'note', count(*), count(*) - count(note), min(note), max(note) from " + CSV_ROWS.sql + ")")
def level1_csv_profile(spark, d):
    return scans.table_profile(csv_roundtrip(spark, d)).select("column_name", "n_rows", "non_null", "low", "high")


def _profile1(c: str, k: str) -> str:
    lo, hi = (f"cast({f}({c}) as varchar)" for f in ("min", "max"))
    lengths = f"min(length({c}))::int, max(length({c}))::int" if k == "s" else "null::int, null::int"
    return f"select '{c}' as column_name, count(*) as n_rows, count({c}) as non_null, {lo} as low, {hi} as high, {lengths.replace(',', ' as min_length,', 1)} as max_length from customer"


@query(" union all ".join(_profile1(c, k) for c, k in C.columns("customer")))
def level1_sql_profile(spark, d):
    return scans.table_profile(C.table(spark, d, "customer"), block=3)


@query(" union all ".join(f"select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as nulls, true as exact from orders" for c, _ in O))
def level1_footer_profile(spark, d):
    return scans.footer_aggregate(scans.footer_profile(spark, f"{d}/orders.parquet")).drop("kinds")


_TWO_FILES = "(select case when n_nationkey % 3 = 0 then null else cast(n_nationkey as bigint) end as id, null as note from nation union all select o_orderkey, case when o_orderkey % 4 > 0 then o_orderstatus end from orders)"


@query(" union all ".join(f"select '{c}' as column_name, count(*) - 1 as n_rows, count(*) - count({c}) as nulls, false as exact, {n} as n_kinds from {_TWO_FILES}" for c, n in (("id", 2), ("note", 1))))
def level1_footer_drift(spark, d):
    """Two files that disagree in a type and a column, and a deletion vector that takes one row."""
    path = f"{C.folder(spark, 'drift')}/t"
    nations, orders = C.table(spark, d, "nation"), C.source(spark, d)
    nations.select(F.when(F.col("n_nationkey") % 3 > 0, F.col("n_nationkey")).alias("id")).coalesce(1).write.mode("overwrite").parquet(f"{path}/a")
    orders.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderstatus")).alias("note")).coalesce(1).write.mode("overwrite").parquet(f"{path}/b")
    footers = scans.footer_profile(spark, f"{path}/*")
    file = footers.agg(F.min("file")).first()[0]
    deleted = spark.createDataFrame([(file, 1)], "path string, dv_rows long")
    return scans.footer_aggregate(footers, deleted).select("column_name", "n_rows", "nulls", "exact", F.size("kinds").alias("n_kinds"))


@query("select 'o_totalprice' as column_name, count(*) as n, count(o_totalprice) as non_null, min(o_totalprice) as low, max(o_totalprice) as high, cast(sum(cast(cast(o_totalprice as varchar) as decimal(38,10))) as varchar) as total from orders")
def chunked_combine(spark, d):
    price = F.col("o_totalprice")
    parts = C.source(spark, d).groupBy((F.col("o_orderkey") % 16).alias("chunk")).agg(F.lit("o_totalprice").alias("column_name"), F.count(F.lit(1)).alias("n"), F.count(price).alias("non_null"), F.min(price).alias("low"), F.max(price).alias("high"), F.sum(price.cast("string").cast("decimal(28,10)")).alias("total"))
    return ops.combine_chunks(parts).withColumn("total", F.col("total").cast("decimal(38,10)").cast("string"))


#: Actions of a small log: (version, op, path, rows, size, rows deleted by a vector).
LOG = C.Derived(
    "select 0 as version, 'add' as op, 'p' || c_custkey as path, cast(c_nationkey as bigint) as rows, c_custkey * 10 as size, cast(null as bigint) as dv_rows from customer "
    "union all select 1, 'remove', 'p' || c_custkey, null, null, null from customer where c_custkey % 3 = 0 "
    "union all select 2, 'remove', 'p' || c_custkey, null, null, null from customer where c_custkey % 5 = 0 and c_custkey % 3 > 0 "
    "union all select 2, 'add', 'p' || c_custkey, cast(c_nationkey as bigint), c_custkey * 10, cast(3 as bigint) from customer where c_custkey % 5 = 0 "
    "union all select 3, 'remove', 'p' || c_custkey, null, null, null from customer where c_custkey % 7 = 0"
)


@query(
    f"select path, rows, size, dv_rows is not null as dv, dv_rows from (select *, row_number() over (partition by path order by version desc, op = 'add' desc) as place from {LOG.sql}) where place = 1 and op = 'add'"
)
def delta_live_files(spark, d):
    """A log written for the purpose: files added, replaced, removed, and one with a deletion vector."""
    import json

    path = f"{C.folder(spark, 'delta')}/t"
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    add = F.to_json(F.struct(F.struct("path", "size", (F.col("version") * 1000).alias("modificationTime"), F.to_json(F.struct(F.col("rows").alias("numRecords"))).alias("stats"), F.when(F.col("dv_rows").isNotNull(), F.struct(F.lit("u").alias("storageType"), F.col("dv_rows").alias("cardinality"))).alias("deletionVector")).alias("add")))
    gone = F.to_json(F.struct(F.struct("path").alias("remove")))
    lines = LOG.df(spark, d).select("version", F.when(F.col("op") == "add", add).otherwise(gone).alias("value"))
    for v in range(4):
        commit = spark.createDataFrame([(json.dumps({"commitInfo": {"timestamp": 1000 * v, "operation": "WRITE"}}),)], "value string")
        lines.where(F.col("version") == v).select("value").unionByName(commit).coalesce(1).write.mode("overwrite").text(f"{path}/_made/{v}")
        where = fs.Path(f"{path}/_delta_log")
        store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        store.mkdirs(where)
        part = next(s.getPath() for s in store.listStatus(fs.Path(f"{path}/_made/{v}")) if s.getPath().getName().startswith("part-"))
        store.rename(part, fs.Path(f"{path}/_delta_log/{v:020d}.json"))
    return scans.delta_live_files(scans.delta_actions(spark, path))


@query(f"{_WITH} select o_orderstatus, count(*) as n from tgt where o_orderkey not in (select o_orderkey from orders) group by 1")
def adhoc_sql(spark, d):
    return scans.adhoc(spark, C.source(spark, d), C.target(spark, d), "select o_orderstatus, count(*) as n from F left anti join S using (o_orderkey) group by 1")


# Keys


@query(f"{_WITH} select 'source' as side, count(*) as n_rows, count(o_orderkey) as n_whole, count(distinct o_orderkey) as n_distinct from orders union all select 'target', count(*), count(o_orderkey), count(distinct o_orderkey) from tgt")
def key_unique(spark, d):
    parts = [keys.uniqueness(f(spark, d), ["o_orderkey"]).select(F.lit(n).alias("side"), "n_rows", "n_whole", "n_distinct") for n, f in (("source", C.source), ("target", C.target))]
    return parts[0].unionByName(parts[1])


@query(f"{_WITH} select (select count(*) from orders s join tgt f using (o_orderkey)) as n_pairs, (select count(distinct o_orderkey) from tgt where o_orderkey in (select o_orderkey from orders)) as n_keys")
def key_coverage(spark, d):
    return keys.coverage(C.source(spark, d), C.target(spark, d), ["o_orderkey"])


@query("select 'o_orderkey' as key, 'almost_unique' as origin")
def key_discovery(spark, d):
    found = keys.discover(C.source(spark, d), C.target(spark, d))
    return spark.createDataFrame([(",".join(found.columns or []), found.origin)], "key string, origin string")


@query(f"{_WITH} select o_orderkey from orders group by 1 having count(*) > 1 union select o_orderkey from tgt group by 1 having count(*) > 1")
def repeated_keys(spark, d):
    return keys.repeated_keys(C.source(spark, d), C.target(spark, d), ["o_orderkey"])


# Differences


def _diff(spark: SparkSession, d: str) -> diff.Diff:
    return diff.Diff(C.source(spark, d), C.target(spark, d), ["o_orderkey"], "o_orderdate")


_CHANGED = " or ".join(f"s_{c} <> f_{c}" for c in COLS)


@query(
    f"{C.DIFF_SQL} select (select count(*) from _s where o_orderkey not in (select o_orderkey from _f)) as only_source, (select count(*) from _f where o_orderkey not in (select o_orderkey from _s)) as only_target, "
    f"(select count(*) from _j) as common, (select count(*) from _j where {_CHANGED}) as changed, (select count(*) from rep) as repeated_keys, "
    "(select count(*) from cs where o_orderkey in (select o_orderkey from rep)) as repeated_source, (select count(*) from cf where o_orderkey in (select o_orderkey from rep)) as repeated_target"
)
def diff_rows(spark, d):
    return _diff(spark, d).summary()


@query(
    f"{C.DIFF_SQL}, k as (select coalesce(s.o_orderkey, f.o_orderkey) as o_orderkey, coalesce(s.n, 0) as ns, coalesce(f.n, 0) as nf from (select o_orderkey, count(*) as n from cs group by 1) s full join (select o_orderkey, count(*) as n from cf group by 1) f using (o_orderkey)), "
    f"c as (select o_orderkey from _j where {_CHANGED}) "
    "select case when ns > 1 or nf > 1 then 'repeated' when nf = 0 then 'only_source' when ns = 0 then 'only_target' when o_orderkey in (select o_orderkey from c) then 'changed' else 'equal' end as what, count(*) as n_keys, sum(ns)::bigint as n_source, sum(nf)::bigint as n_target from k group by 1"
)
def diff_summary(spark, d):
    return _diff(spark, d).classes()


@query(f"{C.DIFF_SQL} " + " union all ".join(f"select '{c}' as column_name, count(*) filter (where s_{c} <> f_{c}) as n_different from _j" for c in COLS))
def diff_columns(spark, d):
    return _diff(spark, d).columns_summary()


_MARKS = ", ".join(C._literal(x) for x in patterns.BLANKS)


def _pattern_sql(s: str, f: str) -> str:
    n = "chr(0) || 'NULL' || chr(0)"
    s, f = f"nullif({s}, {n})", f"nullif({f}, {n})"

    def moji(x: str) -> str:
        for a, b in patterns.MOJIBAKE:
            x = f"replace({x}, {C._literal(a)}, {C._literal(b)})"
        return x

    ts = lambda x: f"(case when regexp_matches({x}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') then try_cast({x} as timestamp) end)"
    num = lambda x: f"try_cast({x} as decimal(38,10))"
    any_ = lambda x: f"coalesce({ts(x)}, try_strptime({x}, '%d/%m/%Y'), try_strptime({x}, '%d/%m/%Y %H:%M:%S'), try_strptime({x}, '%Y%m%d'), try_strptime({x}, '%m/%d/%Y'))"
    plain = lambda x: f"strip_accents(lower(nfc_normalize({x})))"
    both_ts, both_num = f"{ts(s)} is not null and {ts(f)} is not null", f"{num(s)} is not null and {num(f)} is not null"
    mid = lambda x: f"cast({ts(x)} as time) = time '00:00:00'"
    same_day = f"cast({ts(s)} as date) = cast({ts(f)} as date)"
    strange = " or ".join(f"contains({x}, '{c}')" for x in (s, f) for c in "ÃÂ")
    return (
        f"case when ({s} is null and coalesce({f}, '') in ({_MARKS})) or ({f} is null and coalesce({s}, '') in ({_MARKS})) then 'null_vs_blank' when {f} is null then 'null_in_target' when {s} is null then 'null_in_source' "
        f"when trim({s}, ' ') = trim({f}, ' ') then 'spaces' when lower(trim({s}, ' ')) = lower(trim({f}, ' ')) then 'case' when {plain(s)} = {plain(f)} then 'accents' when {moji(s)} = {moji(f)} and ({strange}) then 'mojibake' "
        f"when ltrim({s}, '0') = ltrim({f}, '0') then 'leading_zeros' when {both_num} and {num(s)} = {num(f)} then 'same_number_other_scale' when {both_num} then 'numeric_difference' "
        f"when {both_ts} and date_diff('second', date_trunc('second', {ts(s)}), date_trunc('second', {ts(f)})) % 1800 = 0 then 'time_shift' "
        f"when {both_ts} and (date_trunc('second', {ts(s)}) = date_trunc('second', {ts(f)}) or ({same_day} and ({mid(s)} or {mid(f)}))) then 'time_truncation' when {both_ts} and {same_day} then 'same_day_other_time' "
        f"when {any_(s)} is not null and {any_(s)} = {any_(f)} then 'same_instant_other_format' else 'other' end"
    )


_CELLS = " union all ".join(f"select o_orderkey, '{c}' as column_name, s_{c} as source, f_{c} as target from _j where s_{c} <> f_{c}" for c in COLS)
_PATTERNED = f"{C.DIFF_SQL}, cells as ({_CELLS}), p as (select *, {_pattern_sql('source', 'target')} as pattern from cells) "


@query(f"{_PATTERNED} select column_name, pattern, count(*) as n from p group by 1, 2")
def diff_patterns(spark, d):
    return _diff(spark, d).patterns()


_K = "cast(c_custkey as string)"
TEXT_PAIRS = C.Derived(
    "select c_custkey as id, "
    + C.pick("c_custkey % 16", f"='Peña ' || {_K}", "=c_name || ' '", "=upper(c_name)", f"='00' || {_K}", f"={_K} || '.50'", None, f"='Andrés ' || {_K}", f"='2024-01-05 10:' || lpad(cast(c_custkey % 60 as string), 2, '0') || ':33'", "05/01/2024", None, "=c_name", None, "=c_mktsegment", "20240105", "", "5/1/2024 1:02:03")
    + " as source, "
    + C.pick("c_custkey % 16", f"='PeÃ±a ' || {_K}", "=c_name", "=lower(c_name)", f"={_K}", f"={_K} || '.5'", "", f"='Andres ' || {_K}", f"='2024-01-05 11:' || lpad(cast(c_custkey % 60 as string), 2, '0') || ':33'", "2024-01-05", "N/A", None, "=c_name", "=c_name", "20240106", None, "2024-01-05 01:02:03")
    + " as target from customer"
)


@query(f"with t as (select id, coalesce(source, chr(0) || 'NULL' || chr(0)) as source, coalesce(target, chr(0) || 'NULL' || chr(0)) as target from {TEXT_PAIRS.sql}) select id, {_pattern_sql('source', 'target')} as pattern from t")
def diff_patterns_text(spark, d):
    null = F.lit("\x00NULL\x00")
    return TEXT_PAIRS.df(spark, d).select("id", patterns.pattern(F.coalesce("source", null), F.coalesce("target", null)).alias("pattern"))


@query(f"{_PATTERNED} select column_name, cast(min(abs(cast(source as decimal(38,10)) - cast(target as decimal(38,10))))::decimal(38,10) as varchar) as min_abs, cast(max(abs(cast(source as decimal(38,10)) - cast(target as decimal(38,10))))::decimal(38,10) as varchar) as max_abs from p where pattern = 'numeric_difference' group by 1")
def diff_numeric_range(spark, d):
    return _diff(spark, d).numeric_ranges()


@query(f"{_PATTERNED} select column_name, date_diff('second', cast(source as timestamp), cast(target as timestamp)) / 3600.0::double as hours, count(*) as n from p where pattern = 'time_shift' group by 1, 2 order by n desc limit 3")
def diff_hour_offsets(spark, d):
    return _diff(spark, d).hour_offsets()


@query(f"{C.DIFF_SQL}, cells as ({_CELLS}) select cast(o_orderkey as varchar) as o_orderkey, column_name, source, target from cells where column_name = 'o_totalprice' order by o_orderkey limit 5")
def diff_examples(spark, d):
    return _diff(spark, d).examples("o_totalprice")


SHIFTED = [
    C.Derived("select c_custkey as k, 'C' || c_custkey as cod, c_name as nombre, case when c_custkey % 4 > 0 then c_mktsegment end as extra from customer"),
    C.Derived("select c_custkey as k, case when c_custkey % 5 = 0 then c_name else 'C' || c_custkey end as cod, case when c_custkey % 11 = 0 then c_mktsegment else c_name end as nombre, case when c_custkey % 3 > 0 then c_mktsegment else '' end as extra from customer"),
]


@query(f"with j as (select s.cod as s_cod, s.nombre as s_nombre, s.extra as s_extra, f.cod as f_cod, f.nombre as f_nombre, f.extra as f_extra from {SHIFTED[0].sql} s join {SHIFTED[1].sql} f using (k)), r as (" + " union all ".join(f"select '{a}' as column_name, '{b}' as source_column, count(*) filter (where s_{a} is distinct from f_{a} and f_{a} = s_{b} and f_{a} <> '') as n from j" for a in ("cod", "nombre", "extra") for b in ("cod", "nombre", "extra") if a != b) + ") select * from r where n > 0")
def diff_column_shift(spark, d):
    return diff.Diff(SHIFTED[0].df(spark, d), SHIFTED[1].df(spark, d), ["k"]).column_shift()


@query(
    f"{C.DIFF_SQL}, r as (select substr(o_orderdate, 1, 7) as month, 's' as w from _s where o_orderkey not in (select o_orderkey from _f) union all select substr(o_orderdate, 1, 7), 'f' from _f where o_orderkey not in (select o_orderkey from _s) union all select substr(s_o_orderdate, 1, 7), 'c' from _j where {_CHANGED}) "
    "select month, count(*) filter (where w = 's') as only_source, count(*) filter (where w = 'f') as only_target, count(*) filter (where w = 'c') as changed from r group by 1"
)
def diff_by_month(spark, d):
    return _diff(spark, d).by_month()




def _slim(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"), F.coalesce("o_orderpriority", F.lit("(null)")).alias("o_orderpriority"))


_SLIM_SQL = "o_orderkey, o_custkey, o_orderstatus, cast(cast(o_totalprice as decimal(18,2)) as varchar) as o_totalprice, coalesce(o_orderpriority, '(null)') as o_orderpriority"
_EXCEPT = f"{_WITH}, s as (select {_SLIM_SQL} from orders), f as (select {_SLIM_SQL} from tgt), x as (select 'source' as side, * from (select * from s except all select * from f) union all select 'target', * from (select * from f except all select * from s)) "


def _except(spark: SparkSession, d: str) -> DataFrame:
    s, f = diff.multiset(_slim(C.source(spark, d)), _slim(C.target(spark, d)))
    return s.select(F.lit("source").alias("side"), "*").unionByName(f.select(F.lit("target").alias("side"), "*"))


@query(f"{_EXCEPT} select * from x")
def except_all(spark, d):
    return _except(spark, d)


@query(f"{_EXCEPT} select * from x order by all limit 5")
def except_all_examples(spark, d):
    df = _except(spark, d)
    return df.orderBy(*df.columns).limit(5)


@query(f"{_WITH}, v as (select o_orderpriority as value, 1 as s, 0 as f from orders union all select o_orderpriority, 0, 1 from tgt) select value, sum(s)::bigint as n_source, sum(f)::bigint as n_target, (sum(f) - sum(s))::bigint as delta from v group by 1 having sum(f) <> sum(s)")
def column_distribution_diff(spark, d):
    return diff.distribution(C.source(spark, d), C.target(spark, d), "o_orderpriority")


_Y, _M, _D = "cast(year(o_orderdate) as string)", "cast(month(o_orderdate) as string)", "cast(day(o_orderdate) as string)"
_MM, _DD = (f"lpad({x}, 2, '0')" for x in (_M, _D))
DATES = C.Derived(
    "select o_orderkey as id, "
    + C.pick("o_orderkey % 10", f"={_Y} || '-' || {_MM} || '-' || {_DD}", f"={_DD} || '/' || {_MM} || '/' || {_Y}", f"={_D} || '/' || {_M} || '/' || {_Y} || ' 1:02:03'", f"={_Y} || {_MM} || {_DD}", f"={_MM} || '/' || {_DD} || '/' || {_Y}", f"={_Y} || '-' || {_MM} || '-' || {_DD} || ' 10:11:12'", "=o_orderpriority", None, f"='31/' || {_MM} || '/' || {_Y}", "99/99/9999")
    + " as v from orders"
)


@query(f"select id, strftime(coalesce(case when regexp_matches(v, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') then try_cast(v as timestamp) end, try_strptime(v, '%d/%m/%Y'), try_strptime(v, '%d/%m/%Y %H:%M:%S'), try_strptime(v, '%Y%m%d'), try_strptime(v, '%m/%d/%Y')), '%Y-%m-%d %H:%M:%S') as parsed from {DATES.sql}")
def date_formats(spark, d):
    return DATES.df(spark, d).select("id", F.date_format(patterns.any_time(F.col("v")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


# Schemas and comparisons

@query("with c as (select column_name as n from information_schema.columns where table_name = 'customer') select n as source, case when n = 'c_acctbal' then null else upper(replace(n, '_', ' ')) end as target from c union all select null, 'new'")
def column_pairing(spark, d):
    names = C.table(spark, d, "customer").columns
    pairs, s, f = compare.pair_columns(names, ["new", *[n.upper().replace("_", " ") for n in names if n != "c_acctbal"]])
    return spark.createDataFrame([*pairs.items(), *[(x, None) for x in s], *[(None, x) for x in f]], "source string, target string")


@query("select * from (values ('o_orderkey','O_ORDERKEY','renamed','bigint','int','INCOMPATIBLE'),('o_totalprice','o_totalprice','same_name','double','double','SAME'),('o_orderdate',null,'only_source','timestamp_ntz',null,null),(null,'loaded','only_target',null,'string',null)) t(column_name,target_name,status,source_type,target_type,type_change)")
def schema_diff(spark, d):
    s = C.source(spark, d).select("o_orderkey", "o_totalprice", "o_orderdate")
    return compare.schema_diff(s, s.select(F.col("o_orderkey").cast("int").alias("O_ORDERKEY"), "o_totalprice", F.lit("x").alias("loaded")))


def _metrics(table: str) -> str:
    cols = [c for c, k in O if k == "s"]
    names = ["min_length", "max_length", "min_value", "max_value", "empty", "edge_spaces"]
    exprs = ["min(length({c}))", "max(length({c}))", "min({c})", "max({c})", "count(*) filter (where length({c}) = 0)", "count(*) filter (where {c} <> trim({c}, ' '))"]
    return " union all ".join(f"select '{c}' as column_name, '{n}' as metric, cast({e.replace('{c}', c)} as varchar) as v from {table}" for c in cols for n, e in zip(names, exprs, strict=True))


@query(f"{_WITH}, s as ({_metrics('orders')}), f as ({_metrics('tgt')}) select column_name, metric, s.v as source, f.v as target from s join f using (column_name, metric) where s.v is distinct from f.v")
def profile_diff(spark, d):
    keep = ["column_name", "min_length", "max_length", "min_value", "max_value", "empty", "edge_spaces"]
    return compare.profile_diff(profile.text(C.source(spark, d)).select(*keep), profile.text(C.target(spark, d)).select(*keep))


#: The target's customers: keys that repeat, longer names, nulls, another type, a column less and one more.
CONTRACT_TARGET = C.Derived("select case when c_custkey % 50 = 0 then 1 else c_custkey end as C_CUSTKEY, c_name || '!!' as c_name, case when c_nationkey % 9 > 0 then c_nationkey end as c_nationkey, cast(floor(c_acctbal) as bigint) as c_acctbal, 'x' || c_custkey as fresh from customer")
_CONTRACTS = [f"({measure.contract_sql('customer', measure.CU, {'c_nationkey': 'int'})})", f"({measure.contract_sql(CONTRACT_TARGET.sql + ' t', [('C_CUSTKEY', 'i'), ('c_name', 's'), ('c_nationkey', 'i'), ('c_acctbal', 'i'), ('fresh', 's')], {'c_nationkey': 'int'})})"]


@query(
    f"with b as (select s.column_name as sn, f.column_name as fn, s.data_type as st, f.data_type as ft, s.nullable as sx, f.nullable as fx, s.candidate_key as sk, f.candidate_key as fk, s.max_length as sl, f.max_length as fl from {_CONTRACTS[0]} s full join {_CONTRACTS[1]} f on lower(s.column_name) = lower(f.column_name)) "
    "select sn as column_name, 'column_missing_in_target' as rule from b where fn is null union all select fn, 'column_new_in_target' from b where sn is null union all select sn, 'type' from b where st <> ft union all select sn, 'no_longer_mandatory' from b where not sx and fx union all select sn, 'no_longer_key' from b where sk and not fk union all select sn, 'max_length_grew' from b where fl > sl"
)
def contract_breaks(spark, d):
    return compare.contract_breaks(rules.contract(C.table(spark, d, "customer")), rules.contract(CONTRACT_TARGET.df(spark, d)))


VERDICTS = C.Derived(
    "select o_orderkey as id, o_custkey % 5 as ns, (case when o_orderkey % 6 = 0 then o_custkey + 1 else o_custkey end) % 5 as nf, o_orderkey % 4 = 0 as same_rows, o_orderkey % 5 < 2 as same_set, cast(o_orderkey % 11 as int) as pairs, "
    "cast(o_custkey % 11 as int) as equal, cast(case when o_orderkey % 3 = 0 then o_custkey % 4 else 0 end as int) as different, cast(case when o_orderkey % 7 = 0 then 1 else 0 end as int) as one_sided, o_orderkey % 13 > 0 as measured from orders"
)


@query(
    "select id, case when not measured then 'NOT_MEASURED' when ns = nf and same_rows then 'IDENTICAL' when ns = nf and same_set then 'SAME_DATA_OTHER_ORDER_OR_NAMES' when ns = nf and different = 0 and pairs > 0 and one_sided = 0 then 'SAME_DATA_BY_COLUMN' "
    f"when different > 0 or ns <> nf then case when ns = nf and round(100.0 * equal / greatest(1, pairs), 2) >= 90 then 'ALMOST_IDENTICAL' else 'DIFFERENT' end else 'NO_PARITY' end as verdict from {VERDICTS.sql}"
)
def data_verdict(spark, d):
    c = F.col
    return VERDICTS.df(spark, d).select("id", compare.data_verdict(c("ns"), c("nf"), c("same_rows"), c("same_set"), c("pairs"), c("equal"), c("different"), c("one_sided"), c("measured")).alias("verdict"))


_CODES = [*rules.CONTROLS]
_CODE = C.pick(f"o_orderkey % {len(_CODES) + 2}", *_CODES, "XX-01")
_STATE_OF = "case when max({c}) % 4 = 0 then 'ERROR' when max({c}) % 4 = 1 then 'ALERT' when max({c}) % 4 = 2 then 'INFO' else 'OK' end"
#: A state per control and side, from the orders that fall to the control.
STATES = C.Derived(
    f"select code, {_STATE_OF.format(c='a')} as source, {_STATE_OF.format(c='b')} as target, case when max(c) % 3 > 0 then max(c) % 3 = 1 end as equal, max(b) % 2 = 0 as new_empty "
    f"from (select {_CODE} as code, o_custkey as a, o_custkey * 7 + o_orderkey as b, o_orderkey as c from orders) r where code <> 'XX-01' group by code"
)
_CATALOGUE = C.Inline("code string, level int, criterion string", *[(c, x[0], x[1]) for c, x in rules.CONTROLS.items()])


@query(
    f"with j as (select c.code, c.level, c.criterion, s.source, s.target, s.equal, s.new_empty from {_CATALOGUE.sql} c left join {STATES.sql} s using (code)) select code, level, criterion, source, target, case when code = 'ID-03' and new_empty then 'NOT_MET' when level = 2 then 'PENDING_LEVEL_2' "
    "when code in ('CP-01', 'CP-02') then case when equal then 'MET' else 'NOT_MET' end when code = 'CP-05' then case target when 'OK' then 'MET' when 'ERROR' then 'NOT_MET' when 'NOT_APPLICABLE' then 'NOT_APPLICABLE' else 'NOT_EVALUATED' end "
    "when criterion = 'no_failures' then case when target = 'ERROR' and coalesce(source, '') <> 'ERROR' then 'NOT_MET' when target = 'ERROR' then 'INHERITED' else 'MET' end "
    "when criterion = 'no_regression' then case when (case target when 'ERROR' then 2 when 'ALERT' then 1 else 0 end) > (case source when 'ERROR' then 2 when 'ALERT' then 1 else 0 end) then 'NOT_MET' else 'MET' end else 'INFORMATIVE' end as result from j"
)
def quick_compare(spark, d):
    return compare.quick_compare(STATES.df(spark, d), "ingestion")


@query(f"with t as (select code, case when source = 'OK' and target <> 'OK' then 'regression' when source <> 'OK' and target = 'OK' then 'improvement' when source = 'ERROR' and target = 'ERROR' then 'inherited' end as change from {STATES.sql}) select * from t where change is not null")
def control_regressions(spark, d):
    return compare.control_regressions(STATES.df(spark, d))


RESULTS = C.Derived(f"select {_CODE} as code, {C.pick('(o_custkey * 3 + o_orderkey) % 7', 'MET', 'INHERITED', 'NOT_MET', 'NOT_EVALUATED', 'PENDING_LEVEL_2', 'INFORMATIVE', 'MET')} as result from orders")


@query(f"select split_part(code, '-', 1) as family, count(*) as n, count(*) filter (where result in ('MET', 'INHERITED')) as met, case when count(*) filter (where result in ('MET', 'INHERITED', 'NOT_MET')) > 0 then round(100.0 * count(*) filter (where result in ('MET', 'INHERITED')) / count(*) filter (where result in ('MET', 'INHERITED', 'NOT_MET')), 2)::double end as pct from {RESULTS.sql} group by 1")
def control_rollup(spark, d):
    return compare.control_rollup(RESULTS.df(spark, d))


DECIDED = C.Derived(f"select o_orderkey as id, {C.pick('o_custkey % 7', 'MET', 'NOT_MET', 'PENDING_LEVEL_2', 'INFORMATIVE', 'NOT_APPLICABLE', 'NOT_EVALUATED', 'INHERITED')} as result, {C.pick('o_orderkey % 4', 'justified', 'to_verify', None, None)} as decided, o_orderkey % 3 = 0 as warned from orders")


@query(f"select id, case result when 'NOT_APPLICABLE' then 'not_applicable' when 'NOT_EVALUATED' then 'not_evaluated' when 'PENDING_LEVEL_2' then 'pending' when 'NOT_MET' then case decided when 'justified' then 'justified' when 'to_verify' then 'to_verify' else 'fails' end else case when warned then 'warning' else 'ok' end end as word from {DECIDED.sql}")
def control_words(spark, d):
    return DECIDED.df(spark, d).select("id", compare.control_word(F.col("result"), F.col("decided"), F.col("warned")).alias("word"))


WORDS = C.Derived(f"select 'f' || (c_custkey % 40) as flow, 't' || (c_custkey % 120) as tab, {C.pick('(c_custkey * 13 + c_nationkey) % 40', 'fails', 'pending', 'not_evaluated', 'to_verify', 'justified', 'to_verify', 'justified', 'justified', 'ok')} as word from customer")
_TABLE_STATE = f"select flow, tab, case when bool_or(word = 'pending') then 'IN_PROGRESS' when bool_or(word = 'fails') then 'RETURNED' when bool_or(word = 'not_evaluated') then 'IN_REVIEW' when bool_or(word = 'to_verify') then 'APPROVED_WITH_VERIFICATION' when bool_or(word = 'justified') then 'APPROVED_WITH_JUSTIFICATION' else 'APPROVED' end as state from {WORDS.sql} group by 1, 2"


@query(_TABLE_STATE)
def table_state(spark, d):
    return compare.table_state(WORDS.df(spark, d), ["flow", "tab"])


CHECKS = C.Derived(f"select 'f' || (c_custkey % 45 + 3) as flow, {C.pick('(c_custkey * 5 + c_nationkey) % 90', 'fails', 'not_evaluated', 'ok')} as word from customer")
_RANKED = "case state " + " ".join(f"when '{s}' then {i}" for i, s in enumerate(compare.STATE_ORDER)) + " end"


@query(
    f"with t as ({_TABLE_STATE}), w as (select flow, arg_min(state, {_RANKED}) as s from t group by 1), c as (select flow, bool_or(word = 'fails') as bad, bool_or(word = 'not_evaluated') as open from {CHECKS.sql} group by 1) "
    "select flow, case when bad or s = 'RETURNED' then 'RETURNED' when s = 'IN_PROGRESS' then 'IN_PROGRESS' when open or s is null then 'IN_REVIEW' else s end as state from w full join c using (flow)"
)
def flow_state(spark, d):
    return compare.flow_state(table_state(spark, d), CHECKS.df(spark, d))


OUTCOMES = C.Derived(
    f"select o_orderkey as id, case when o_custkey % 2 = 0 then 'ingestion' else 'analytics' end as grp, o_orderkey % 5 > 0 as same_rows, o_orderkey % 7 > 0 as same_hash, o_orderkey % 11 > 0 as same_columns, "
    f"{C.pick('o_custkey % 6', 'SAME', 'TEXT_EQUIVALENT', 'WIDENING', 'PRECISION', 'INCOMPATIBLE', 'SAME')} as type_change, cast(case when o_orderkey % 13 = 0 then 1 else 0 end as int) as vg, cast(case when o_custkey % 9 = 0 then 1 else 0 end as int) as regr, "
    "case when o_orderkey % 3 = 0 then 'DIFFERENT' else 'IDENTICAL' end as verdict, o_custkey % 8 = 0 as renamed, o_custkey % 10 = 0 as justified, o_orderkey % 4 = 0 as cut from orders"
)


@query(f"select id, case when shape and same_type and rest then case when not renamed and not justified and (grp <> 'ingestion' or verdict = 'IDENTICAL') then 'APPROVED' else 'APPROVED_WITH_JUSTIFICATION' end when (cut and shape and same_type and (grp = 'ingestion' or regr = 0)) or (type_change in ('WIDENING', 'PRECISION') and shape and rest) then 'APPROVED_WITH_JUSTIFICATION' else 'REVIEW' end as outcome from (select *, same_columns and vg = 0 as shape, type_change in ('SAME', 'TEXT_EQUIVALENT') as same_type, case when grp = 'ingestion' then same_rows and same_hash else regr = 0 end as rest from {OUTCOMES.sql}) o")
def comparison_outcome(spark, d):
    c = F.col
    return OUTCOMES.df(spark, d).select("id", compare.comparison_outcome(c("grp"), c("same_rows"), c("same_hash"), c("same_columns"), c("type_change"), c("vg"), c("regr"), c("verdict"), c("renamed"), c("justified"), c("cut")).alias("outcome"))


FINDINGS = C.Derived(
    f"select 'f' || (o_custkey % 150) as flow, {C.pick('(o_orderkey * 7 + o_custkey) % 90', 'run_not_completed', 'validator_blocker', 'output_without_commit', 'control_not_met', 'roles_swapped', 'comparison_missing', 'nulls_differ', 'control_not_met', 'ok')} as kind, "
    "case when o_custkey % 4 = 0 then 'ID-01' when o_custkey % 4 = 1 then 'CP-01' end as detail from orders"
)


@query(f"with t as (select flow, count(*) filter (where kind in ('run_not_completed', 'validator_blocker', 'output_without_commit', 'child_not_completed') or (kind = 'control_not_met' and detail = 'ID-01')) as n_red, count(*) filter (where kind in ('roles_swapped', 'comparison_missing', 'cp05_not_evaluated', 'nulls_differ', 'code_review_open', 'no_run') or (kind = 'control_not_met' and detail <> 'ID-01')) as n_yellow from {FINDINGS.sql} group by 1) select flow, case when n_red > 0 then 'RED' when n_yellow > 0 then 'YELLOW' else 'GREEN' end as light, n_red, n_yellow from t")
def traffic_light(spark, d):
    return compare.traffic_light(FINDINGS.df(spark, d))


@query("select code, case when level = 2 then 'PENDING_LEVEL_2' when code = 'ID-01' then 'OK' when code = 'ID-03' then 'OK' when code = 'ID-04' then 'INFO' when code = 'ID-06' then 'OK' end as state from " + _CATALOGUE.sql + " where code like 'ID-%'")
def level01_controls(spark, d):
    """What footers alone can decide about orders; duplicates and keys wait for level 2."""
    foot = scans.footer_profile(spark, f"{d}/orders.parquet")
    agg = scans.footer_aggregate(foot)
    bounds = foot.groupBy("column_name").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("has_stats").alias("ok"))
    one = agg.join(bounds, "column_name").agg(F.max("n_rows").alias("n"), F.count(F.when(F.col("exact") & (F.col("nulls") == F.col("n_rows")), 1)).alias("empty"), F.count(F.when(F.col("ok") & (F.col("low") == F.col("high")), 1)).alias("constant"))
    codes = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(x[0]).alias("level")) for c, x in rules.CONTROLS.items() if c.startswith("ID-")])
    state = F.when(F.col("x.level") == 2, "PENDING_LEVEL_2").when(F.col("x.code") == "ID-01", F.when(F.col("n") > 0, "OK").otherwise("ERROR")).when(F.col("x.code") == "ID-03", F.when(F.col("empty") == 0, "OK").otherwise("ALERT")).when(F.col("x.code") == "ID-06", F.when(F.col("constant") == 0, "OK").otherwise("INFO")).otherwise("INFO")
    return one.select("*", F.explode(codes).alias("x")).select("x.code", state.alias("state"))
