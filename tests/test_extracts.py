"""Database parts, ledgers by file, folders that drift, encodings by ranges, copies that measure themselves."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from functools import reduce
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators import copies, diff, fingerprint
from sieveline.operators.ledger import Ledger
from sieveline.plans import extracts
from sieveline.sources import databases, drift

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture(scope="module")
def loaded(spark, data):
    return extracts._database(spark, data)


def test_parts_of_a_skewed_key_are_near_the_mean(loaded, spark, data):
    parts = loaded.parts("skew", 8, within="o_orderkey")
    mean = sum(n for _, n in parts) / 8
    assert len(parts) == 8 and max(n for _, n in parts) <= 1.2 * mean
    rows = loaded.read("skew", 8, within="o_orderkey")
    sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sorted(sizes) == sorted(n for _, n in parts)
    assert sum(sizes) == spark.read.parquet(f"{data}/orders.parquet").count() == rows.select("o_orderkey").distinct().count()


def test_parts_of_keys_whose_cube_passes_64_bits(spark, data, tmp_path):
    """As in larger tables; negative keys, a null and the ends of the type too."""
    orders = spark.read.parquet(f"{data}/orders.parquet").where("o_orderkey < 500")
    far = [orders.withColumn("o_orderkey", F.expr(k)) for k in ("o_orderkey + 2097000", "-o_orderkey - 9000000000", f"{2**63 - 1} - o_orderkey", f"o_orderkey - {2**63 - 1} - 1")]
    reduce(DataFrame.unionByName, far).unionByName(orders.limit(1).withColumn("o_orderkey", F.lit(None).cast("long"))).write.parquet(f"{tmp_path}/orders.parquet")
    assert [tuple(r) for r in extracts.database_parts(spark, str(tmp_path)).collect()] == [(8, 2001, True)]


def test_cubes_are_those_of_the_sql(spark, data, tmp_path):
    """Above 2**53, where floating cubes are rounded, up to the ends of 64 bits; beyond, where a cast ends the SQL, they are NULL and no row is lost."""
    orders = spark.read.parquet(f"{data}/orders.parquet").where("o_orderkey < 500")
    far = [orders.withColumn("o_orderkey", F.expr(k)) for k in ("o_orderkey", "o_orderkey + 208000", "-o_orderkey - 700000", "o_orderkey + 2097000", "-o_orderkey - 2097000", "o_orderkey + 9000000000")]
    reduce(DataFrame.unionByName, far).unionByName(orders.limit(1).withColumn("o_orderkey", F.lit(None).cast("long"))).write.parquet(f"{tmp_path}/orders.parquet")
    sql = extracts.ORACLES["database_extract"].replace("from orders", f"from '{tmp_path}/orders.parquet/*.parquet'")
    found = [tuple(r) for r in extracts.database_extract(spark, str(tmp_path)).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, duckdb.sql(sql.replace("cast(case", "try_cast(case")).fetchall()))
    fits = [r for r in found if r[-1] is not None]
    assert sorted(fits) == sorted(duckdb.sql(f"{sql} where o_orderkey % 3 = 0 or o_orderkey between -2097152 and 2097151").fetchall()) and len(fits) < len(found) == 3001


def test_heavy_nulls_are_cut_by_the_second_column(spark):
    url = "jdbc:derby:memory:nulls;create=true"
    spark.createDataFrame([(i if i < 100 else None, i) for i in range(1000)], "k long, i int").write.jdbc(url, "nulls", mode="overwrite", properties=DERBY)
    db = databases.Database(spark, url, "nulls", DERBY)
    parts = [n for _, n in db.parts("k", 8, within="i")]
    assert len(parts) == 8 and sum(parts) == 1000 and max(parts) <= 1.2 * 1000 / 8
    assert sorted(r["i"] for r in db.read("k", 8, within="i").collect()) == list(range(1000))


def test_another_process_reads_the_database(loaded):
    """As executors do: a process that shares nothing but the folder."""
    code = "import sys\nfrom sieveline.session import local_session\nfrom sieveline.sources.databases import Database\nrows = Database(local_session(2, '1g'), sys.argv[1], 'loaded', {'driver': sys.argv[2]}).read('skew', 4, within='o_orderkey')\nprint('rows', rows.count(), rows.select('o_orderkey').distinct().count())"
    root = str(Path(extracts.__file__).resolve().parents[2])
    done = subprocess.run([sys.executable, "-c", code, loaded.url, DERBY["driver"]], capture_output=True, text=True, timeout=180, cwd=root, check=False)
    assert "rows 1500 1500" in done.stdout, done.stderr[-2000:]


def test_texts_and_nulls_come_through_the_import(spark, tmp_path):
    """Quotes, line ends, blanks at both ends, empty texts and NULLs."""
    rows = [("1", '"a, ""b"""'), ("2", '""'), ("3", ""), ("4", '"  x\ny "')]
    spark.createDataFrame([(",".join(r),) for r in rows], "value string").repartition(2).write.text(f"{tmp_path}/rows")
    empty = spark.createDataFrame([], "k int, v string").write.option("createTableColumnTypes", "v varchar(40)")
    url = databases.packed_derby(spark, str(tmp_path), "ODD_TEXTS", lambda to: empty.jdbc(to, "odd_texts", mode="append", properties=DERBY))
    db = databases.Database(spark, url, "odd_texts", DERBY)
    assert {r["k"]: r["v"] for r in db.read("k", 2).collect()} == {1: 'a, "b"', 2: "", 3: None, 4: "  x\ny "}
    with pytest.raises(RuntimeError, match="shared file system"):
        databases.packed_derby(spark, "hdfs://host/x", "T", empty.jdbc)


def test_files_are_loaded_at_once_and_each_once(spark, tmp_path):
    """More files than connections, one of them empty, one far larger; the table keeps its types."""
    rows = spark.range(3000).select(F.concat_ws(",", "id", F.concat(F.lit('"'), F.col("id") % 7, F.lit('"'))).alias("value"), (F.col("id") < 2000).alias("large"))
    rows.where("large").drop("large").coalesce(1).union(rows.where("not large").drop("large").repartition(2 * databases.LOADERS)).union(rows.drop("large").limit(0)).write.text(f"{tmp_path}/rows")
    empty = spark.createDataFrame([], "k long, v string").write.option("createTableColumnTypes", "v varchar(40)")
    url = databases.packed_derby(spark, str(tmp_path), "MANY", lambda to: empty.jdbc(to, "many", mode="append", properties=DERBY))
    db = databases.Database(spark, url, "many", DERBY)
    assert [(c.name, c.type_name, c.precision) for c in db.columns()] == [("k", "BIGINT", 19), ("v", "VARCHAR", 40)]
    assert sorted((r["k"], r["v"]) for r in db.read("k", 4).collect()) == [(i, str(i % 7)) for i in range(3000)]
    assert db.query("select count(*) n from \"MANY_7\"").first()[0] > 0


def test_counts_need_few_passes(spark, monkeypatch):
    """A heavy value among far ones: each pass narrows the range to a thousandth."""
    url, asked, ask = "jdbc:derby:memory:heavy;create=true", [], databases.Database.query
    spark.createDataFrame([(7 if i % 3 == 0 else (i * 1000) ** 3, i) for i in range(1500)], "k long, i int").write.jdbc(url, "heavy", mode="overwrite", properties=DERBY)
    monkeypatch.setattr(databases.Database, "query", lambda self, sql: asked.append(sql) or ask(self, sql))
    parts = databases.Database(spark, url, "heavy", DERBY).parts("k", 8, within="i")
    assert sum(n for _, n in parts) == 1500 and max(n for _, n in parts) <= 1.2 * 1500 / 8
    assert len(asked) <= 16  # 22, when ranges were fewer for smaller cells


def test_a_heavy_value_stays_whole_without_a_second_column(loaded):
    sizes = [n for _, n in loaded.parts("skew", 8)]
    assert sum(sizes) == 1500 and max(sizes) >= 500


def test_null_negative_and_far_keys(spark):
    url = "jdbc:derby:memory:odd;create=true"
    rows = [(k, i) for i, k in enumerate([None] * 30 + [-(2**63), 2**63 - 1, 0, -5] + list(range(-40, 40)))]
    spark.createDataFrame(rows, "k long, i int").write.jdbc(url, "odd", mode="overwrite", properties=DERBY)
    db = databases.Database(spark, url, "odd", DERBY)
    assert sorted((r["k"] is None, r["k"] or 0, r["i"]) for r in db.read("k", 4).collect()) == sorted((k is None, k or 0, i) for k, i in rows)
    some = databases.Database(spark, url, "odd", DERBY, where='"i" < 30')
    assert some.read("k", 4).count() == 30
    with pytest.raises(ValueError, match="integer"):
        databases.Database(spark, url, "(select cast(1.5 as double) x from sysibm.sysdummy1) t", DERBY).parts("X", 2)
    spark.createDataFrame([], "k long, i int").write.jdbc(url, "bare", mode="overwrite", properties=DERBY)
    assert databases.Database(spark, url, "bare", DERBY).read("k", 4).count() == 0


def test_types_that_spark_lacks_come_as_text(spark):
    jvm, url = spark.sparkContext._jvm, "jdbc:derby:memory:kinds;create=true"
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(DERBY["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url)
    connection.createStatement().execute("create table kinds (id int, clock time, doc xml, amount decimal(10, 2), day date, flag boolean)")
    connection.createStatement().execute("insert into kinds values (1, time('10:11:12'), xmlparse(document '<a>x</a>' preserve whitespace), 12.50, date('2024-01-02'), true), (2, null, null, null, null, null)")
    connection.close()
    db = databases.Database(spark, url, "kinds", DERBY)
    assert [(c.name, c.native) for c in db.columns()] == [("ID", True), ("CLOCK", False), ("DOC", False), ("AMOUNT", True), ("DAY", True), ("FLAG", True)]
    df = db.read("ID", 2)
    assert dict(df.dtypes) == {"ID": "int", "CLOCK": "string", "DOC": "string", "AMOUNT": "decimal(10,2)", "DAY": "date", "FLAG": "boolean"}
    first, second = sorted(df.collect())
    assert (first["CLOCK"], first["DOC"], str(first["AMOUNT"])) == ("10:11:12", "<a>x</a>", "12.50") and set(second[1:]) == {None}
    assert databases.Column("n", "NUMERIC", "NUMERIC", 0, 0).native is False


def test_ledger_opens_changed_files_only(spark, data, tmp_path):
    """15 of 20 files are made unreadable without a change of size or time: the update must not notice."""
    folder, rows = tmp_path / "data", spark.read.parquet(f"{data}/lineitem.parquet")
    rows.withColumn("cut", F.pmod("l_orderkey", F.lit(20))).repartition(20, "cut").write.partitionBy("cut").parquet(str(folder))
    ledger = Ledger(spark, str(tmp_path / "ledger"), rows.schema)
    with pytest.raises(ValueError):
        ledger.current()
    first = ledger.update(str(folder)).first()
    assert (first["files"], first["files_read"], first["fingerprint"]) == (20, 20, fingerprint.row_fingerprint(rows).first()["fingerprint"])
    again = ledger.update(str(folder)).first()
    assert (again["files_read"], again["files_gone"], again["fingerprint"]) == (0, 0, first["fingerprint"])
    for path in [p for i in range(5) for p in (folder / f"cut={i}").glob("*.parquet")]:
        path.unlink()
    now = rows.where("l_orderkey % 20 >= 5").unionByName(rows.where("l_orderkey % 20 < 3").withColumn("l_tax", F.col("l_tax") + 1))
    want = fingerprint.row_fingerprint(now).first()
    rows.where("l_orderkey % 20 < 3").withColumn("l_tax", F.col("l_tax") + 1).withColumn("cut", F.pmod("l_orderkey", F.lit(20))).repartition(20, "cut").write.mode("append").partitionBy("cut").parquet(str(folder))
    kept = [p for i in range(5, 20) for p in (folder / f"cut={i}").glob("*.parquet")]
    assert len(kept) == 15
    for path in kept:
        before = path.stat()
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
        path.write_bytes(b"\0" * before.st_size)
        os.utime(path, ns=(before.st_atime_ns, before.st_mtime_ns))
    third = ledger.update(str(folder)).first()
    assert (third["files"], third["files_read"], third["files_gone"]) == (18, 3, 5)
    assert (third["n_rows"], third["fingerprint"]) == (want["n_rows"], want["fingerprint"])


def test_ledger_states_schema_and_verification(spark, tmp_path):
    folder = tmp_path / "data"
    spark.range(40).repartition(4).write.parquet(str(folder))
    ledger = Ledger(spark, str(tmp_path / "ledger"), spark.range(1).schema)
    v = ledger.update(str(folder)).first()["version"]
    with pytest.raises(ValueError):
        ledger.mark("PUBLISHED", v)
    ledger.mark("COMPARED", v)
    with pytest.raises(ValueError, match="current"):
        ledger.mark("PUBLISHED", v)
    assert ledger.current().first()["state"] == "COMPARED" and ledger.entries().count() == 4
    assert ledger.verify(str(folder)).collect() == []
    one = sorted(folder.glob("*.parquet"))[0]
    before = one.stat()
    spark.range(100, 110).coalesce(1).write.parquet(str(tmp_path / "other"))
    other = next((tmp_path / "other").glob("*.parquet")).read_bytes()
    (one.parent / f".{one.name}.crc").unlink()
    one.write_bytes(other)
    os.utime(one, ns=(before.st_atime_ns, before.st_mtime_ns))
    assert {r["problem"] for r in ledger.verify(str(folder)).collect()} <= {"other_sums", "changed"} and ledger.verify(str(folder)).count() == 1
    wider = spark.range(1).withColumn("more", F.lit("x")).schema
    assert Ledger(spark, str(tmp_path / "ledger"), wider).update(str(folder)).first()["files_read"] == 4
    for p in folder.glob("*.parquet"):
        p.unlink()
    empty = Ledger(spark, str(tmp_path / "ledger"), wider).update(str(folder)).first()
    assert (empty["n_rows"], empty["files"], empty["files_gone"]) == (0, 0, 4)


def test_many_files_of_few_schemas(spark, data):
    """500 files in three schemas are three scans."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    rows = drift.grouped_scan(spark, extracts.drifting_folder(spark, data, 501))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3
    assert len(rows.inputFiles()) >= 400
    source = spark.read.parquet(f"{data}/orders.parquet")
    assert rows.count() == source.count() and dict(rows.dtypes)["o_custkey"] == "string" and dict(rows.dtypes)["o_orderkey"] == "bigint"
    assert rows.selectExpr("sum(o_orderkey)").first()[0] == source.selectExpr("sum(o_orderkey)").first()[0]


def test_wider_types():
    T = drift.T
    d = T.DecimalType
    assert drift.wider(T.IntegerType(), T.LongType()) == T.LongType() and drift.wider(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert drift.wider(T.LongType(), T.DoubleType()) == T.StringType() and drift.wider(d(10, 2), d(8, 4)) == d(12, 4)
    assert drift.wider(T.LongType(), d(20, 2)) == d(21, 2) and drift.wider(d(38, 0), d(38, 10)) == T.StringType()
    assert drift.wider(T.NullType(), T.DateType()) == T.DateType() and drift.wider(T.DateType(), T.StringType()) == T.StringType()


@pytest.mark.parametrize("seed", range(4))
def test_ranges_tell_what_the_whole_tells(seed):
    rng = random.Random(seed)
    for _ in range(3000):
        data = b"".join(rng.choice(["a", "é", "€", "😀"]).encode() for _ in range(rng.randrange(8)))
        if rng.random() < 0.6 and data:
            at = rng.randrange(len(data))
            data = data[:at] + bytes([rng.choice([0x80, 0xBF, 0xC3, 0xE2, 0xF0, 0xFF, 0xE9, 0x41])]) * rng.randrange(3) + data[at + rng.randrange(2) :]
        size = rng.randrange(1, 6)
        try:
            data.decode()
            bad = False
        except UnicodeDecodeError:
            bad = True
        starts = range(0, len(data), size)
        found = any(drift.bad_utf8(data[max(0, s - 3) : s + size + 3], min(3, s), min(size, len(data) - s)) for s in starts)
        assert found == bad, (data, size)


def test_encodings_of_large_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("k,v\n1,".encode() + "é€".encode() * 5000 + b"\n")
    (tmp_path / "b.csv").write_bytes(b"k,v\n2," + b"x" * 9000 + b"\xe9\n")
    (tmp_path / "c.csv").write_bytes(b"")
    found = {r["path"].rsplit("/", 1)[1]: r["encoding"] for r in drift.encodings(spark, str(tmp_path), range_bytes=1000).collect()}
    assert found == {"a.csv": "UTF-8", "b.csv": "ISO-8859-1"}
    rows = {r["k"]: (r["v"][-1], r["_encoding"]) for r in drift.csv_folder(spark, str(tmp_path), "[ab].csv").collect()}
    assert rows == {"1": ("€", "UTF-8"), "2": ("é", "ISO-8859-1")}


def test_measured_copy_sees_what_lies_there(spark, tmp_path):
    rows = spark.range(100)
    first = copies.measured_copy(rows, str(tmp_path / "out"), "a").first()
    assert (first["rows_read"], first["rows_copied"], first["n_rows"], first["outcome"]) == (100, 100, 100, "BALANCED")
    more = copies.measured_copy(rows, str(tmp_path / "out"), "a", lambda x: x.where("id < 30")).first()
    assert (more["rows_read"], more["rows_copied"], more["n_rows"], more["outcome"]) == (100, 30, 130, "LOST")
    twice = copies.measured_copy(rows, str(tmp_path / "two"), "b", lambda x: x.unionByName(x)).first()
    assert (twice["rows_copied"], twice["outcome"]) == (200, "GAINED") or twice["rows_read"] == 200


def test_no_task_of_a_logged_table_holds_a_cut(spark, data, tmp_path):
    """Four input files stay four tasks of each cut: a file holds a part of its cut's rows, and all live rows come back."""
    spark.read.parquet(f"{data}/orders.parquet").repartition(4).write.parquet(str(tmp_path / "orders.parquet"))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        found = extracts.delta_table_read(spark, str(tmp_path))
        names = {p.rsplit("/files/", 1)[1] for p in found.inputFiles()}
        assert {n.split("/")[0] for n in names} == {f"cut={i}" for i in (0, 2, 3, 5)} and len(names) == 16
        want = spark.read.parquet(f"{data}/orders.parquet").where("o_orderkey % 6 not in (1, 4)").select(*found.columns)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_column_shift_plan_grows_with_columns(spark):
    wide = spark.range(50).select("id", *[F.concat(F.lit(f"{i}:"), "id").alias(f"c{i}") for i in range(68)])
    odd = wide.withColumn("c3", F.when(F.col("id") < 7, F.col("c40")).otherwise(F.col("c3")))
    assert [tuple(r) for r in diff.Diff(wide, odd, ["id"]).column_shift().collect()] == [("c3", "c40", 7)]
