"""Queries on what is read, copied and measured again: databases, drifting folders, encodings, ledgers and copies."""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import patterns
from sieveline.operators import approvals, copies, diff, fingerprint, ops, profile
from sieveline.operators.ledger import Ledger
from sieveline.plans import common as C
from sieveline.sources import custom, drift, scans, sinks
from sieveline.sources.databases import Database, packed_derby
from sieveline.sources.ranges import listing, on_workers, open_file

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


#: A key a third of whose values are equal and whose others lie far apart.
SKEW_SQL = "case when o_orderkey % 3 = 0 then 7 else o_orderkey ** 3 end"
#: Such a key for any ``o_orderkey``: whole numbers, the cube up to 2,097,151, above which no 64-bit number holds it.
BOUNDED_SKEW = "case when o_orderkey % 3 = 0 then 7 else pmod(o_orderkey, 2097152) * pmod(o_orderkey, 2097152) * pmod(o_orderkey, 2097152) end"
PARTS = 8


def _cube(key: int | None) -> int | None:
    """The cube as SQL takes it, by the C library's ``pow``, which above 2**53 rounds unlike whole numbers and unlike the JVM's; None where 64 bits don't hold it."""
    cube = math.nan if key is None else math.pow(key, 3)
    return int(cube) if -(2**63) <= cube < 2**63 else None


def _skew(spark: SparkSession) -> Column:
    """``SKEW_SQL``, with a NULL for each cube that its cast to a bigint refuses."""
    on_workers(spark)
    key = F.col("o_orderkey")
    return F.when(key % 3 == 0, F.lit(7)).otherwise(F.udf(_cube, "long", useArrow=True)(key))


def _database(spark: SparkSession, d: str, skew: Column | None = None) -> Database:
    """``orders`` with a skewed key and a time of day, in a database that comes with Spark, packed for reading by any process.

    Spark writes the rows as delimited text in parallel. An embedded database has one process that writes: the driver's imports these
    files as a stream, closes the database and packs its pages, uncompressed, into one archive in the shared folder. From there every
    executor opens it read-only.
    """
    at = C.folder(spark, "database")
    orders = C.table(spark, d, "orders").withColumns({"skew": _skew(spark) if skew is None else skew, "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz")})
    text = lambda c, kind: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) if kind == "string" else c.cast("string")
    line = F.concat_ws(",", *[F.coalesce(text(F.col(c), kind), F.lit("")) for c, kind in orders.dtypes])
    orders.select(line.alias("value")).write.text(f"{at}/rows")
    # Times are local times, as in the given table: no zone moves them.
    properties = {"driver": "org.apache.derby.jdbc.EmbeddedDriver", "preferTimestampNTZ": "true"}
    empty = orders.limit(0).write.option("createTableColumnTypes", "o_orderstatus varchar(10), o_orderpriority varchar(40)")
    url = packed_derby(spark, at, "LOADED", lambda to: empty.jdbc(to, "loaded", mode="append", properties=properties))
    return Database(spark, url, "loaded", properties)


@query(f"select o_orderkey, o_custkey, o_orderstatus, cast(cast(o_totalprice as decimal(18,2)) as varchar) as o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate, o_orderpriority, cast({SKEW_SQL} as bigint) as skew from orders")
def database_extract(spark: SparkSession, d: str) -> DataFrame:
    """All rows of a database table, read in parallel parts of a skewed key; it is NULL where no bigint holds it, which ends the SQL."""
    rows = _database(spark, d).read("skew", PARTS, within="o_orderkey")
    return rows.withColumns({"o_totalprice": F.col("o_totalprice").cast("decimal(18,2)").cast("string"), "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")})


@query(f"select {PARTS} as n_parts, count(*) as n_rows, true as all_near_mean from orders")
def database_parts(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the parts as they are read: none may exceed the mean by a fifth."""
    rows = _database(spark, d, F.expr(BOUNDED_SKEW)).read("skew", PARTS, within="o_orderkey")
    sizes = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).cast("int").alias("n_parts"), F.sum("n").alias("n_rows"), (F.max("n") <= 1.2 * F.avg("n")).alias("all_near_mean"))


FILES = 20
_CHANGED = "select * from lineitem where l_orderkey % 20 not in (3, 9, 12, 1, 2) union all select * replace (l_quantity + 1 as l_quantity) from lineitem where l_orderkey % 20 in (1, 2) union all select * from lineitem where l_orderkey % 20 = 12 and l_linenumber > 1"
_LINE = C.columns("lineitem")


@query(
    f"with r as ({_CHANGED}), h as (select {C.digest_sql(_LINE)} as h from r), f as (select count(*) as n_rows, {C.sums_sql('h')} from h) "
    f"select n_rows, {C.final_sql('n_rows', 's1', 's2', 's3', 's4')} as fingerprint, 18 as files, 3 as files_read, 5 as files_gone, 'MEASURED' as state from f"
)
def changed_files_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """``lineitem`` in 20 files, measured, then three files replaced and two removed: the second measurement opens three files."""
    at, rows = C.folder(spark, "ledger"), C.table(spark, d, "lineitem")
    data = f"{at}/data"
    cut = rows.withColumn("cut", F.pmod("l_orderkey", F.lit(FILES)))
    cut.repartition(FILES, "cut").write.partitionBy("cut").parquet(data)
    ledger = Ledger(spark, f"{at}/ledger", rows.schema)
    ledger.update(data)
    changed = rows.where("l_orderkey % 20 in (1, 2)").withColumn("l_quantity", F.col("l_quantity") + 1).unionByName(rows.where("l_orderkey % 20 = 12 and l_linenumber > 1")).withColumn("cut", F.pmod("l_orderkey", F.lit(FILES)))
    for gone in (1, 2, 12, 3, 9):
        C.remove(spark, f"{data}/cut={gone}")
    changed.repartition(FILES, "cut").write.mode("append").partitionBy("cut").parquet(data)
    return ledger.update(data).select("n_rows", "fingerprint", F.col("files").cast("int").alias("files"), F.col("files_read").cast("int").alias("files_read"), F.col("files_gone").cast("int").alias("files_gone"), "state")


def drifting_folder(spark: SparkSession, d: str, files: int) -> str:
    """``orders`` in files of three schemas, as tables drift: a narrower key without priorities, customers as text."""
    at, k = C.folder(spark, "drift"), F.col("o_orderkey")
    orders = C.table(spark, d, "orders")
    parts = [
        orders.where(k % 3 == 0),
        orders.where(k % 3 == 1).drop("o_orderpriority").withColumn("o_orderkey", k.cast("int")),
        orders.where(k % 3 == 2).withColumn("o_custkey", F.concat(F.lit("C"), F.col("o_custkey"))),
    ]
    for part in parts:
        part.repartition(files // 3, "o_orderkey").write.mode("append").parquet(at)
    return at


_NARROW = "case when o_orderkey % 3 = 1 then null else o_orderpriority end"
_CUSTOMER = "case when o_orderkey % 3 = 2 then 'C' || o_custkey else cast(o_custkey as varchar) end"


@query(f"select o_orderkey, {_CUSTOMER} as o_custkey, o_orderstatus, cast(cast(o_totalprice as decimal(18,2)) as varchar) as o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, {_NARROW} as o_orderpriority from orders")
def drifting_scan(spark: SparkSession, d: str) -> DataFrame:
    """Files of three schemas as one table, by one scan per schema."""
    rows = drift.grouped_scan(spark, drifting_folder(spark, d, 24))
    return rows.withColumns({"o_totalprice": F.col("o_totalprice").cast("decimal(18,2)").cast("string"), "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd")})


_KEPT = "o_orderstatus <> 'F' and o_totalprice > 1000"


@query(f"select 'orders' as activity, count(*) as rows_read, count(*) filter (where {_KEPT}) as rows_copied, count(*) filter (where {_KEPT}) as n_rows, case when count(*) filter (where {_KEPT}) < count(*) then 'LOST' else 'BALANCED' end as outcome from orders")
def measured_copy(spark: SparkSession, d: str) -> DataFrame:
    """A copy of ``orders`` whose filter drops rows, counted by its own pass and by the footers of what it wrote."""
    return copies.measured_copy(C.table(spark, d, "orders"), f"{C.folder(spark, 'copy')}/out", "orders", lambda x: x.where(_KEPT))


#: Columns that lineitem is widened by; in the target, the first of them holds the last one's value in some rows.
WIDE = 57
_SHIFTED = "l_orderkey % 10 = 0 and l_linenumber = 1"


@query(f"select 'w0' as column_name, 'w{WIDE - 1}' as source_column, count(*) as n from (select l_orderkey, l_linenumber from lineitem group by all having count(*) = 1) where {_SHIFTED}")
def wide_column_shift(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a wide table that hold another column's value; rows of repeated keys are set aside."""
    rows = C.table(spark, d, "lineitem")
    wide = rows.withColumns({f"w{i}": F.concat(F.lit(f"{i}-"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")) for i in range(WIDE)})
    target = wide.withColumn("w0", F.when(F.expr(_SHIFTED), F.col(f"w{WIDE - 1}")).otherwise(F.col("w0")))
    return diff.Diff(wide, target, ["l_orderkey", "l_linenumber"]).column_shift()


@query("select p_partkey::varchar as id, p_name || case when p_partkey % 2 = 0 then ' é' else ' ü€' end as name, p_type || chr(10) || '\"' || p_brand || '\"' as note, 'UTF-8' as encoding from part where p_partkey % 2 = 1 union all select p_partkey::varchar, p_name || ' é', p_type || chr(10) || '\"' || p_brand || '\"', 'ISO-8859-1' from part where p_partkey % 2 = 0")
def csv_encodings(spark: SparkSession, d: str) -> DataFrame:
    """A folder with files of two encodings, each read in its own."""
    at, k = C.folder(spark, "csv"), F.col("p_partkey")
    rows = C.table(spark, d, "part").select(k.cast("string").alias("id"), F.concat("p_name", F.when(k % 2 == 0, " é").otherwise(" ü€")).alias("name"), F.concat("p_type", F.lit('\n"'), "p_brand", F.lit('"')).alias("note"))
    for odd, encoding in ((1, "UTF-8"), (0, "ISO-8859-1")):
        rows.where(F.col("id").cast("long") % 2 == odd).repartition(2, "id").write.options(header=True, quote='"', escape='"', encoding=encoding).mode("append").csv(at)
    return drift.csv_folder(spark, at, "*.csv").withColumnRenamed("_encoding", "encoding")


_WANTED = ("1-URGENT", "3-MEDIUM")


@query(f"select 'p=' || o_orderpriority as folder, count(*) as n_rows from orders where o_orderpriority in {_WANTED} group by 1")
def folder_listing(spark: SparkSession, d: str) -> DataFrame:
    """Rows by folder of a partitioned table, from a listing whose filter opens two folders and the footers of their files alone."""
    at = C.folder(spark, "listing")
    C.table(spark, d, "orders").withColumn("p", F.col("o_orderpriority")).repartition(4).write.partitionBy("p").parquet(at)
    files = custom.files_below(spark, at).where(F.col("folder").isin([f"p={w}" for w in _WANTED]) & F.col("name").endswith(".parquet"))
    rows = files.select("folder", "path").mapInPandas(_footer_rows, "folder string, n_rows long")
    return rows.groupBy("folder").agg(F.sum("n_rows").alias("n_rows"))


def _footer_rows(batches):
    import pyarrow.parquet as pq

    for pdf in batches:
        yield pdf.assign(n_rows=[pq.ParquetFile(open_file(p)).metadata.num_rows for p in pdf["path"]])[["folder", "n_rows"]]


#: Names in mixed case, so that the order by bytes isn't the declared one.
_CASED = "case when p_partkey % 3 = 0 then upper(p_name) when p_partkey % 3 = 1 then lower(p_name) else p_name end"


@query(f"select 'p_name' as column_name, count(*) as n, count(*) as non_null, lower(min({_CASED} collate nocase)) as low, lower(max({_CASED} collate nocase)) as high, sum(p_partkey)::bigint as total from part")
def collated_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Bounds of a text column by its collation, put together from 16 chunks."""
    name = F.collate(F.expr(_CASED), "UTF8_LCASE")
    parts = C.table(spark, d, "part").groupBy((F.col("p_partkey") % 16).alias("chunk")).agg(
        F.lit("p_name").alias("column_name"), F.count(F.lit(1)).alias("n"), F.count("p_name").alias("non_null"), F.min(name).cast("string").alias("low"), F.max(name).cast("string").alias("high"), F.sum("p_partkey").alias("total")
    )
    return ops.combine_chunks(parts, "UTF8_LCASE").withColumns({"low": F.lower("low"), "high": F.lower("high")})


_REPORT = "select l_returnflag as report, count(*) as n, sum(cast(l_quantity as bigint))::bigint as quantity, min(l_linenumber) as low, max(l_linenumber) as high from lineitem group by 1"
_POINTERS = ("rows.total", "rows.sums[0].value", "bounds[0]", "bounds[1]", "rows.gone")


@query(
    f"with r as ({_REPORT}), c as (select report, 'rows.total' as pointer, n as cited, n as found from r union all select report, 'rows.sums[0].value', case when report = 'R' then quantity + 1 else quantity end, quantity from r "
    "union all select report, 'bounds[0]', low, low from r union all select report, 'bounds[1]', case when report = 'N' then high - 1 else high end, high from r union all select report, 'rows.gone', 0, null from r) "
    "select report, pointer, cited::varchar as cited, found::varchar as found, case when found is null then 'MISSING' when cited = found then 'MATCHES' else 'FALSIFIED' end as state from c"
)
def cited_figures(spark: SparkSession, d: str) -> DataFrame:
    """Figures cited from measured reports: two are falsified, one stands nowhere."""
    measured = C.table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("report")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.min("l_linenumber").alias("low"), F.max("l_linenumber").alias("high"))
    sums = F.array(F.struct(F.lit("quantity").alias("column"), F.col("quantity").alias("value")))
    reports = measured.select("report", F.to_json(F.struct(F.struct(F.col("n").alias("total"), sums.alias("sums")).alias("rows"), F.array("low", "high").alias("bounds"))).alias("document"))
    said = {"rows.total": F.col("n"), "rows.sums[0].value": F.col("quantity") + (F.col("report") == "R").cast("long"), "bounds[0]": F.col("low"), "bounds[1]": F.col("high") - (F.col("report") == "N").cast("int"), "rows.gone": F.lit(0)}
    cited = measured.select("report", F.explode(F.array(*[F.struct(F.lit(p).alias("pointer"), c.cast("string").alias("cited")) for p, c in said.items()])).alias("x")).select("report", "x.*")
    return approvals.cited_figures(reports, _POINTERS, cited)


_GATES = [(1, "sources", "orders"), (2, "clients", "customer"), (3, "parts", "part")]


@query("select 'migration' as flow, place::int as place, gate, decision, 'x' as by, gate <> 'clients' as unchanged, place = 1 as valid from (values (1, 'sources', 'APPROVED'), (2, 'clients', 'APPROVED'), (3, 'parts', 'APPROVED')) g(place, gate, decision) where (select count(*) from customer where c_custkey % 7 = 0) > 0")
def content_gates(spark: SparkSession, d: str) -> DataFrame:
    """Approvals of three tables, of which the second then changes: its gate and the later one fall, the earlier holds."""
    tables = {t: C.table(spark, d, t) for _, _, t in _GATES}
    prints = lambda frames: reduce(DataFrame.unionByName, [fingerprint.row_fingerprint(df).select(F.lit(t).alias("subject"), "fingerprint") for t, df in frames.items()])
    order = spark.createDataFrame([("migration", *g) for g in _GATES], "flow string, place int, gate string, subject string")
    approved = prints(tables).join(order, "subject").select(F.col("place").cast("long").alias("seq"), "flow", "gate", F.lit("APPROVED").alias("decision"), F.lit("x").alias("by"), "fingerprint")
    first = approved.withColumns({"seq": F.lit(0).cast("long"), "decision": F.lit("REJECTED")})
    changed = tables["customer"].withColumn("c_acctbal", F.when(F.col("c_custkey") % 7 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return approvals.gates(order, approved.unionByName(first), prints(tables | {"customer": changed}))


@query("select event_type as action, count(*) as n, sum(value_cents)::bigint as cents from (select event_type, cast(round(value * 100) as bigint) as value_cents from events) group by 1")
def run_log(spark: SparkSession, d: str) -> DataFrame:
    """Events appended to a log in two batches and read back."""
    at, events = f"{C.folder(spark, 'log')}/log", C.table(spark, d, "events")
    entries = events.select("event_id", "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))
    for odd in (0, 1):
        custom.append_to_log(entries.where(F.col("event_id") % 2 == odd), at)
    log = custom.read_log(spark, at, "event_id long, event_type string, cents long")
    return log.groupBy(F.col("event_type").alias("action")).agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


def _put(spark: SparkSession, path: str, lines: list[str]) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray("\n".join(lines).encode()))
    out.close()


#: Parts of ``orders`` in the table's folder.
CUTS = 6


@query("select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders where o_orderkey % 6 not in (1, 4)")
def delta_table_read(spark: SparkSession, d: str) -> DataFrame:
    """A table by its transaction log: of the files of six cuts that were added those of two have been removed, though they still lie there."""
    at = C.folder(spark, "table")
    orders = C.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    for cut in range(CUTS):  # each as it is read: no task sorts or holds a cut of the table
        orders.where(F.pmod("o_orderkey", F.lit(CUTS)) == cut).write.parquet(f"{at}/files/cut={cut}")
    files = [r["path"].rsplit("/files/", 1)[1] for r in listing(spark, f"{at}/files", "*.parquet").select("path").collect()]
    _put(spark, f"{at}/_delta_log/{0:020d}.json", [json.dumps({"add": {"path": f"files/{p}", "size": 1, "modificationTime": 1}}) for p in files])
    _put(spark, f"{at}/_delta_log/{1:020d}.json", [json.dumps({"remove": {"path": f"files/{p}"}}) for p in files if p.startswith(("cut=1/", "cut=4/"))])
    return scans.delta_table(spark, at).select(*orders.columns)


@query("select f.format, count(*) as n_rows, sum(p_partkey)::bigint as keys from part, (values ('parquet'), ('csv'), ('json'), ('parquet without ending')) f(format) group by 1")
def formats_read(spark: SparkSession, d: str) -> DataFrame:
    """``part`` in files of three formats, and in one whose name doesn't tell it: each is read by the reader that fits."""
    at, part, out = C.folder(spark, "formats"), C.table(spark, d, "part").select("p_partkey", "p_name"), None
    for name, ending, write in (("parquet", "a.parquet", part.write.parquet), ("csv", "b.csv", part.write.option("header", True).csv), ("json", "c.json", part.write.json)):
        write(f"{at}/{ending}")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    store = fs.Path(at).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part.coalesce(1).write.parquet(f"{at}/made")
    made = next(s.getPath() for s in store.listStatus(fs.Path(f"{at}/made")) if s.getPath().getName().startswith("part-"))
    store.rename(made, fs.Path(f"{at}/d.extract"))
    for told, name in (("parquet", "a.parquet"), ("csv", "b.csv"), ("json", "c.json"), ("parquet without ending", "d.extract")):
        rows, how, _ = scans.read_any(spark, f"{at}/{name}")
        found = rows.agg(F.lit(told if how == told.split()[0] else how).alias("format"), F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("p_partkey").cast("long")).alias("keys"))
        out = found if out is None else out.unionByName(found)
    return out


@query(
    f"{C.DIFF_SQL} select 'only_source' as part, count(*) as n_rows from _s where o_orderkey not in (select o_orderkey from _f) union all select 'only_target', count(*) from _f where o_orderkey not in (select o_orderkey from _s) "
    f"union all select 'changed', count(*) from _j where {' or '.join(f's_{c} <> f_{c}' for c, _ in C.columns('orders')[1:])} union all select 'repeated_source', count(*) from cs where o_orderkey in (select o_orderkey from rep) union all select 'repeated_target', count(*) from cf where o_orderkey in (select o_orderkey from rep)"
)
def diff_detail_written(spark: SparkSession, d: str) -> DataFrame:
    """The detail of a comparison as it is written: rows of each part, read back from their files."""
    at, out = C.folder(spark, "detail"), None
    for part in sinks.detail(diff.Diff(C.source(spark, d), C.target(spark, d), ["o_orderkey"]), at):
        found = spark.read.parquet(f"{at}/{part}").agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n_rows"))
        out = found if out is None else out.unionByName(found)
    return out


@query("select column_name, true as near from information_schema.columns where table_name = 'lineitem'")
def approximate_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Sketched distinct counts lie within a tenth of the exact ones; verdicts use the exact ones alone."""
    rows = C.table(spark, d, "lineitem")
    exact, sketched = profile.distincts(rows), profile.distincts(rows, approximate=True).withColumnRenamed("n_distinct", "about")
    return exact.join(sketched, "column_name").select("column_name", (F.abs(F.col("about") - F.col("n_distinct")) <= 0.1 * F.col("n_distinct")).alias("near"))


@query("select o_orderkey, replace(format('{:,}', cast(o_orderkey * o_custkey * 1000 as bigint)), ',', '.') as shown from orders")
def thousands(spark: SparkSession, d: str) -> DataFrame:
    return C.table(spark, d, "orders").select("o_orderkey", patterns.thousands(F.col("o_orderkey") * F.col("o_custkey") * 1000).alias("shown"))


@query(
    "with c as (select c_custkey as report, c_custkey % 4 = 0 as a, c_custkey % 5 = 0 as b, c_custkey % 7 = 0 as c from customer) select report, 'owner.name' as pointer from c where a union all select report, 'figures[0]' from c where b union all select report, 'state' from c where c"
)
def unpublished_fields(spark: SparkSession, d: str) -> DataFrame:
    """Reports, one a customer, with fields that are absent, null or empty."""
    k = F.col("c_custkey")
    owner = F.struct(F.when(k % 4 > 0, F.col("c_name")).when(k % 8 == 0, F.lit("")).alias("name"))
    figures = F.when(k % 5 > 0, F.array("c_acctbal")).otherwise(F.array().cast("array<double>"))
    document = F.to_json(F.struct(owner.alias("owner"), figures.alias("figures"), F.when(k % 7 > 0, F.lit("DONE")).alias("state")))
    return approvals.missing_fields(C.table(spark, d, "customer").select(k.alias("report"), document.alias("document")), ["owner.name", "figures[0]", "state"])


ENTRIES = C.Derived(
    f"select o_orderkey as seq, 'd' || (o_custkey % 200) as difference, {C.pick('(o_orderkey * 7 + o_custkey) % 5', 'JUSTIFIED', 'OPEN', 'JUSTIFIED', 'TO_VERIFY', 'REJECTED')} as decision, {C.pick('o_orderkey % 4', '', None, 'rounding', 'load')} as cause, {C.pick('o_orderkey % 3', True, False, None)} as measured, cast(o_orderkey % 8 as int) as n_examples from orders"
)


@query(
    f"with e as (select * from {ENTRIES.sql}), l as (select *, row_number() over (partition by difference order by seq desc) as place, count(*) over (partition by difference) as revisions, first_value(decision) over (partition by difference order by seq) as first_decision, count(*) filter (where decision = 'JUSTIFIED') over (partition by difference) as n from e) "
    "select difference, revisions, first_decision, decision, concat_ws(',', case when decision = 'JUSTIFIED' and not (coalesce(cause, '') <> '' and coalesce(measured, false)) then 'unmeasured' end, case when n_examples > 5 then 'examples' end, case when decision <> 'JUSTIFIED' and n > 0 then 'reopened' end) as issues from l where place = 1"
)
def difference_registry(spark: SparkSession, d: str) -> DataFrame:
    return approvals.difference_registry(ENTRIES.df(spark, d))


CODE_RULES = C.Derived(
    f"select 'r' || p_partkey as rule, {C.pick('p_partkey % 7', 'SAME', 'EQUIVALENT', 'DIFFERENT', 'ONLY_SOURCE', 'ONLY_TARGET', 'OTHER', 'DIFFERENT')} as result, {C.pick('p_partkey % 5', 'PLATFORM', 'ORIGIN', 'LOGIC', None, 'ELSE')} as class, {C.pick('p_size % 3', '', None, '=p_type')} as why, {C.pick('p_size % 4', '', None, '=p_brand', '=p_brand')} as measured, {C.pick('p_partkey % 3', '', '=p_name', None)} as open_points from part"
)


@query(
    f"select rule, concat_ws(',', case when result = 'OTHER' then 'unknown_result' end, case when result not in ('SAME', 'EQUIVALENT', 'OTHER') and coalesce(class, '') not in ('PLATFORM', 'ORIGIN', 'LOGIC') then 'class' end, case when result not in ('SAME', 'EQUIVALENT', 'OTHER') and class = 'PLATFORM' then 'platform_is_equivalent' end, "
    f"case when result not in ('SAME', 'OTHER') and coalesce(why, '') = '' then 'why' end, case when result not in ('SAME', 'OTHER') and coalesce(measured, '') = '' then 'measured' end, case when result = 'EQUIVALENT' and coalesce(open_points, '') <> '' then 'open_points' end) as gaps from {CODE_RULES.sql}"
)
def rule_gaps(spark: SparkSession, d: str) -> DataFrame:
    return approvals.rule_gaps(CODE_RULES.df(spark, d))


WIDE_NULLS = 40


@query(" union all ".join(f"select 'w{i}' as column_name, count(*) as n_rows, count(*) filter (where l_orderkey % {i + 2} > 0) as non_null, count(*) filter (where l_orderkey % {i + 2} = 0) as nulls, round(100.0 * count(*) filter (where l_orderkey % {i + 2} = 0) / count(*), 4)::double as pct_null from lineitem" for i in range(WIDE_NULLS)))
def profile_wide(spark: SparkSession, d: str) -> DataFrame:
    """A profile of 40 columns, in blocks that each stay within generated code."""
    k = F.col("l_orderkey")
    return profile.nulls(C.table(spark, d, "lineitem").select(*[F.when(k % (i + 2) > 0, F.col("l_partkey")).alias(f"w{i}") for i in range(WIDE_NULLS)]))
