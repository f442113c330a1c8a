"""Fingerprints of a stream: slice sums are additive, so micro-batches merge exactly.

The library has no streaming semantics of its own; this lets a table that is still being written be fingerprinted as it
grows. Each micro-batch's sums are written under its batch id; a batch that is run again overwrites its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sieveline.functions import canon


def batch_sums(df: DataFrame) -> DataFrame:
    """(n_rows, s1..s4) of a batch."""
    h = canon.digest(list(canon.canonical_columns(df).values()))
    sums = [s.alias(f"s{i}") for i, s in enumerate(canon.slice_sums(F.col("h")), 1)]
    return df.select(h.alias("h")).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def start(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Writes the sums of each micro-batch to ``folder``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch_sums(batch).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(spark: SparkSession, folder: str) -> DataFrame:
    """(n_rows, s1..s4, fingerprint) over all batches: equal to the fingerprint of the whole table."""
    parts = spark.read.parquet(folder)
    sums = [F.sum(F.col(f"s{i}").cast("decimal(38,0)")).cast("string").alias(f"s{i}") for i in range(1, 5)]
    out = parts.agg(F.sum("n_rows").alias("n_rows"), *sums)
    return out.withColumn("fingerprint", canon.final_digest(canon.ROW_VERSION, F.col("n_rows"), *[F.col(f"s{i}") for i in range(1, 5)]))
