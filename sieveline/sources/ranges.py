"""Parts of files on executors: whoever needs a footer or a range of bytes opens the file there and reads no more."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = str(Path(__file__).resolve().parents[2])


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package, wherever the driver was started."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


def open_file(name: str):
    """A file by its URI or path, for random access; pyarrow knows local files and the usual stores."""
    from pyarrow import fs

    if name.startswith("file:") or "://" not in name:
        return fs.LocalFileSystem().open_input_file("/" + name.removeprefix("file:").lstrip("/"))
    store, at = fs.FileSystem.from_uri(name)
    return store.open_input_file(at)


def listing(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, file, n_bytes, modified) of all files below a path; contents are not read. ``file`` is the name that ``_metadata.file_path`` has."""
    on_workers(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        files = files.option("pathGlobFilter", pattern)
    return files.load(path).select("path", F.col("_metadata.file_path").alias("file"), F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified"))
