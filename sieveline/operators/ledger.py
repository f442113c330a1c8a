"""Measurements by change: a ledger of each file's sums, from which only changed files are measured again.

A table's fingerprint is made of sums over its rows, so that a file's part in it can be added and taken away. The ledger
keeps these parts per file, with the size and time by which a change is seen. An update lists the folder, takes the parts of
files that changed or vanished from the totals and adds those of files that are new, which alone are opened.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions import canon
from sieveline.operators.workflow import advance
from sieveline.sources.ranges import listing

_SUMS = ["s1", "s2", "s3", "s4"]
_SCHEMA = "file string, n_bytes long, modified timestamp, n_rows long, s1 decimal(38,0), s2 decimal(38,0), s3 decimal(38,0), s4 decimal(38,0)"
_TOTALS = "version long, files_at long, shape string, n_rows long, s1 string, s2 string, s3 string, s4 string, files long, files_read long, files_gone long, state string"


def file_sums(spark: SparkSession, schema: T.StructType, paths: list[str]) -> DataFrame:
    """(file, n_rows, s1..s4) of Parquet files read by one schema; files without rows don't come."""
    rows = spark.read.schema(schema).parquet(*paths)
    h = canon.digest(list(canon.canonical_columns(rows).values()))
    sums = [s.cast("decimal(38,0)").alias(n) for n, s in zip(_SUMS, canon.slice_sums(F.col("h")), strict=True)]
    return rows.select(F.col("_metadata.file_path").alias("file"), h.alias("h")).groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), *sums)


class Ledger:
    """Versions of a folder's measurement, below ``at``; each is written whole before a one-row table makes it the current one.

    An update that was broken off leaves files that no version names, and is simply made again.
    """

    def __init__(self, spark: SparkSession, at: str, schema: T.StructType) -> None:
        self.spark, self.at, self.schema = spark, at.rstrip("/"), schema

    def _totals(self, version: int | None = None) -> dict | None:
        """The newest version's totals, or those of one version."""
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.at}/totals")
        store = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not store.exists(top):
            return None
        named = [s.getPath() for s in store.listStatus(top)]
        done = [int(p.getName().removeprefix("v")) for p in named if store.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        if not done:
            return None
        found = self.spark.read.schema(_TOTALS).json(f"{self.at}/totals/v{max(done) if version is None else version}").first()
        return found.asDict()

    def _commit(self, totals: dict) -> None:
        one = self.spark.createDataFrame([tuple(totals[f.name] for f in T._parse_datatype_string(_TOTALS).fields)], _TOTALS)
        one.coalesce(1).write.mode("overwrite").json(f"{self.at}/totals/v{totals['version']}")

    def entries(self) -> DataFrame:
        """(file, n_bytes, modified, n_rows, s1..s4) of the current version."""
        now = self._totals()
        return self.spark.createDataFrame([], _SCHEMA) if now is None else self.spark.read.schema(_SCHEMA).parquet(f"{self.at}/files/v{now['files_at']}")

    def update(self, folder: str) -> DataFrame:
        """Measures what changed below a folder of Parquet files; one row as :meth:`current` gives it.

        Of another schema than the last time nothing is reused, since the canonical text of rows depends on it.
        """
        before = self._totals()
        shape = self.schema.json()
        kept = before is not None and before["shape"] == shape
        old = self.entries() if kept else self.spark.createDataFrame([], _SCHEMA)
        here = listing(self.spark, folder, "*.parquet")
        same = ["file", "n_bytes", "modified"]
        new = here.join(old.select(*same), same, "left_anti")
        gone = old.join(here.select(*same), same, "left_anti")
        paths = sorted(r["path"] for r in new.select("path").toLocalIterator())
        version = before["version"] + 1 if before else 1
        at = f"{self.at}/files/v{version}"
        stay = old.join(here.select(*same), same, "left_semi")
        if paths:
            zero = lambda n, kind: F.coalesce(n, F.lit(0)).cast(kind).alias(n)
            fresh = new.join(file_sums(self.spark, self.schema, paths), "file", "left").select(*same, zero("n_rows", "long"), *[zero(s, "decimal(38,0)") for s in _SUMS])
            stay = stay.select(*same, "n_rows", *_SUMS).unionByName(fresh)
        stay.write.mode("overwrite").parquet(at)
        written = self.spark.read.schema(_SCHEMA).parquet(at)
        added = written.join(old.select(*same), same, "left_anti").withColumn("sign", F.lit(1))
        signed = added.unionByName(gone.withColumn("sign", F.lit(-1)))
        change = signed.agg(*[F.coalesce(F.sum(F.col(c) * F.col("sign")), F.lit(0)).cast("string").alias(c) for c in ("n_rows", *_SUMS)], F.count_if(F.col("sign") == -1).alias("gone"), F.count_if(F.col("sign") == 1).alias("read")).first()
        base = before if kept else dict.fromkeys(("n_rows", *_SUMS, "files"), 0)
        sums = {c: int(base[c]) + int(change[c]) for c in ("n_rows", *_SUMS)}
        files = int(base["files"]) + change["read"] - change["gone"]
        self._commit({"version": version, "files_at": version, "shape": shape, "n_rows": sums["n_rows"], **{s: str(sums[s]) for s in _SUMS}, "files": files, "files_read": change["read"], "files_gone": change["gone"], "state": "MEASURED"})
        return self.current()

    def current(self) -> DataFrame:
        """(version, n_rows, s1..s4, fingerprint, files, files_read, files_gone, state): the fingerprint is that of the whole table."""
        now = self._totals()
        if now is None:
            raise ValueError(f"nothing has been measured at {self.at}")
        rows = self.spark.read.schema(_TOTALS).json(f"{self.at}/totals/v{now['version']}")
        fingerprint = canon.final_digest(canon.ROW_VERSION, F.col("n_rows"), *[F.col(s) for s in _SUMS])
        return rows.select("version", "n_rows", *_SUMS, fingerprint.alias("fingerprint"), "files", "files_read", "files_gone", "state")

    def mark(self, state: str, version: int) -> None:
        """Moves the measurement one state on (or back); refused where ``version`` isn't the current one any more."""
        now = self._totals()
        if now is None or now["version"] != version:
            raise ValueError(f"version {version} isn't the current measurement")
        state = advance(now["state"], state)
        self._commit(now | {"version": version + 1, "state": state, "files_read": 0, "files_gone": 0})

    def verify(self, folder: str) -> DataFrame:
        """(file, problem) of entries that don't hold: changed, vanished, new, or with other sums though size and time are the same."""
        here = listing(self.spark, folder, "*.parquet")
        paths = sorted(r["path"] for r in here.select("path").toLocalIterator())
        old = self.entries().select("file", F.struct("n_bytes", "modified").alias("was"), F.struct("n_rows", *_SUMS).alias("had"))
        now = here.select("file", F.struct("n_bytes", "modified").alias("is"))
        if paths:
            now = now.join(file_sums(self.spark, self.schema, paths).select("file", F.struct("n_rows", *_SUMS).alias("has")), "file", "left")
        else:
            now = now.withColumn("has", F.lit(None))
        none = F.struct(F.lit(0).cast("long").alias("n_rows"), *[F.lit(0).cast("decimal(38,0)").alias(s) for s in _SUMS])
        both = old.join(now, "file", "full_outer")
        problem = F.when(F.col("was").isNull(), "new").when(F.col("is").isNull(), "vanished").when(F.col("was") != F.col("is"), "changed").when(F.col("had") != F.coalesce("has", none), "other_sums")
        return both.select("file", problem.alias("problem")).where("problem is not null")
