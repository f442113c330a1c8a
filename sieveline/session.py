"""Session helpers shared by bench, tests and the command line."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: What the library relies on: results must not depend on the machine's zone, and joins must be re-planned at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | None = None, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("sieveline")
    settings = BASE_CONF | {"spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": memory} | conf
    spark = builder.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
