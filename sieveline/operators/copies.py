"""Copies that measure themselves: rows read and rows written are counted by the copy's own pass, and set against the output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sieveline.operators.flow import copy_reconcile
from sieveline.sources.scans import footer_profile


def measured_copy(df: DataFrame, target: str, activity: str, change: Callable[[DataFrame], DataFrame] = lambda x: x) -> DataFrame:
    """Writes ``change(df)`` as Parquet to ``target``; one row (activity, rows_read, rows_copied, n_rows, outcome).

    Metrics observed on the way in and on the way out count in the one pass that copies; ``n_rows`` comes from the footers of
    what lies in the folder afterwards, so that files that were there before, or lost since, show. Spark adds a task's
    metrics once, when it succeeds; a stage that is computed again after a lost executor can count its rows again, which
    ``change`` with a shuffle makes possible: rows_read is then an upper bound, rows_copied and n_rows hold.
    """
    there, here = Observation(f"{activity}-in"), Observation(f"{activity}-out")
    read = df.observe(there, F.count(F.lit(1)).alias("n"))
    change(read).observe(here, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(target)
    spark = df.sparkSession
    stored = footer_profile(spark, target).select("file", "n_rows").distinct().agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    counts = stored.select(F.lit(activity).alias("activity"), F.lit(there.get["n"]).cast("long").alias("rows_read"), F.lit(here.get["n"]).cast("long").alias("rows_copied"), F.col("n_rows").cast("long").alias("n_rows"))
    return counts.join(copy_reconcile(counts), "activity")
