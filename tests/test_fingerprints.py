"""Fingerprints don't depend on row order, partitions or files; they do on data."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.operators import fingerprint
from sieveline.streaming import fingerprints as streaming


def table(spark, data):
    return spark.read.parquet(f"{data}/customer.parquet")


def test_invariance(spark, data, tmp_path):
    df = table(spark, data)
    want = fingerprint.dataset_fingerprint(df).first()
    assert fingerprint.dataset_fingerprint(df.orderBy(F.desc("c_name")).repartition(7)).first() == want
    df.repartition(5).write.parquet(str(tmp_path / "files"))
    assert fingerprint.dataset_fingerprint(spark.read.parquet(str(tmp_path / "files"))).first() == want


def test_changes_show(spark, data):
    df = table(spark, data)
    one = fingerprint.dataset_fingerprint(df).first()["fingerprint"]
    other = df.withColumn("c_name", F.when(F.col("c_custkey") == 1, "x").otherwise(F.col("c_name")))
    assert fingerprint.dataset_fingerprint(other).first()["fingerprint"] != one
    assert fingerprint.dataset_fingerprint(df.limit(0)).first()["n_rows"] == 0


def test_column_set_ignores_names_and_order(spark, data):
    df = table(spark, data)
    renamed = df.select(*[F.col(c).alias(f"x_{c}") for c in reversed(df.columns)])
    assert fingerprint.column_set_fingerprint(df).first() == fingerprint.column_set_fingerprint(renamed).first()


def test_special_values(spark):
    df = spark.sql("select cast('NaN' as double) a, cast('Infinity' as double) b, cast(null as string) c, X'00FF' d, named_struct('x', 1, 'y', null) e, array(1, null) f, date'2024-01-05' g, cast(1e300 as double) h, map('k', 1) i")
    assert fingerprint.dataset_fingerprint(df).first()["n_rows"] == 1
    got = fingerprint.row_digests(df).first()["h"]
    assert len(got) == 64


def test_stream_equals_batch(spark, data, tmp_path):
    df = table(spark, data)
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streaming.start(stream, str(tmp_path / "sums"), str(tmp_path / "state")).awaitTermination(120)
    want = fingerprint.dataset_fingerprint(df).first()
    got = streaming.merged(spark, str(tmp_path / "sums")).first()
    assert (got["n_rows"], got["fingerprint"]) == (want["n_rows"], want["fingerprint"])
