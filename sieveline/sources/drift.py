"""Folders whose files differ: in their schemas (Parquet) or in their encodings (CSV). Files alike are read by one scan."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions import canon
from sieveline.sources.ranges import listing, open_file


def schemas(spark: SparkSession, path: str) -> DataFrame:
    """(path, shape) of every Parquet file below a path: its schema as JSON, by its footer alone, read on executors."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        for pdf in batches:
            shapes = [from_arrow_schema(pq.read_schema(open_file(p)), prefer_timestamp_ntz=True).json() for p in pdf["path"]]
            yield pd.DataFrame({"path": pdf["path"], "shape": shapes})

    files = listing(spark, path, "*.parquet").select("path")
    return files.repartition(spark.sparkContext.defaultParallelism).mapInPandas(run, "path string, shape string")


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both without loss; text where there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if {type(a), type(b)} <= {T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    digits = {1: 3, 2: 5, 4: 10, 8: 19}
    if all(isinstance(x, T.DecimalType) or x in _WHOLE for x in (a, b)):
        whole, scale = zip(*((x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (digits[2 ** _WHOLE.index(x)], 0) for x in (a, b)), strict=True)
        if max(whole) + max(scale) <= 38:
            return T.DecimalType(max(whole) + max(scale), max(scale))
    return T.StringType()


def grouped_scan(spark: SparkSession, path: str, as_text: Sequence[str] = ()) -> DataFrame:
    """All Parquet files below a path by column name, however their schemas differ: one scan per schema, not per file.

    Columns get a type that holds every file's values; where there is none, and for those in ``as_text``, their canonical text.
    A column that a file lacks is null there. The driver holds the names of the files, as any scan of them does, and each
    schema once. Order: columns as they first come, schemas with the most files first.
    """
    groups: dict[str, list[str]] = {}
    for row in schemas(spark, path).toLocalIterator():
        groups.setdefault(row["shape"], []).append(row["path"])
    if not groups:
        raise ValueError(f"no Parquet file below {path}")
    ordered = sorted(groups.items(), key=lambda g: (-len(g[1]), g[0]))
    shapes = [T.StructType.fromJson(json.loads(s)) for s, _ in ordered]
    kinds: dict[str, T.DataType] = {}
    for shape in shapes:
        for f in shape.fields:
            kinds[f.name] = wider(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    text = T.StringType()
    kinds |= {c: text for c in as_text if c in kinds}
    out = None
    for shape, (_, files) in zip(shapes, ordered, strict=True):
        have = {f.name: f.dataType for f in shape.fields}
        one = lambda c, to: F.lit(None) if c not in have else canon.text_of(F.col(f"`{c}`"), have[c]) if to == text and have[c] != text else F.col(f"`{c}`")  # noqa: B023, E731
        part = spark.read.schema(shape).option("recursiveFileLookup", True).parquet(*sorted(files)).select(*[one(c, to).cast(to).alias(c) for c, to in kinds.items()])
        out = part if out is None else out.unionByName(part)
    return out


def bad_utf8(data: bytes, before: int, size: int) -> bool:
    """Whether ``size`` bytes of a file aren't UTF-8; ``data`` also has the ``before`` bytes ahead of them and three after (where the file has so many).

    Checking begins with the character that holds the first byte and ends with the whole of the one that holds the last, so that
    each range tells for itself and together they miss nothing.
    """
    start, end = before, before + size
    while start > 0 and start < len(data) and data[start] & 0xC0 == 0x80:
        start -= 1
    for at in range(end - 1, max(start, end - 4) - 1, -1):
        if data[at] & 0xC0 != 0x80:
            lead = data[at]
            end = max(end, at + (4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1))
            break
    try:
        data[start:end].decode("utf-8")
    except UnicodeDecodeError:
        return True
    return False


def encodings(spark: SparkSession, path: str, pattern: str | None = None, range_bytes: int = 64 << 20) -> DataFrame:
    """(path, encoding) of every file below a path: UTF-8 where all its bytes are valid, else ISO-8859-1.

    Files are checked in ranges that tasks read for themselves, so that neither a large file nor a large folder meets in one row.
    Empty files aren't listed.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bad = []
            for name, start, size in zip(pdf["path"], pdf["start"], pdf["n_bytes"], strict=True):
                before, length = min(3, int(start)), min(range_bytes, int(size - start))
                with open_file(name) as f:
                    f.seek(int(start) - before)
                    data = f.read(before + length + 3)
                bad.append(bad_utf8(data, before, length))
            yield pd.DataFrame({"path": pdf["path"], "bad": bad})

    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = listing(spark, path, pattern).select("path", "n_bytes", starts.alias("start"))
    found = ranges.repartition(spark.sparkContext.defaultParallelism * 4, "path", "start").mapInPandas(run, "path string, bad boolean")
    return found.groupBy("path").agg(F.when(F.max("bad"), "ISO-8859-1").otherwise("UTF-8").alias("encoding"))


def csv_folder(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """All RFC 4180 files below a path as text columns by name, each in its own encoding, which ``_encoding`` tells.

    One scan per encoding; columns that some file lacks are null there. Files of one encoding share a header.
    """
    groups: dict[str, list[str]] = {}
    for row in encodings(spark, path, pattern).toLocalIterator():
        groups.setdefault(row["encoding"], []).append(row["path"])
    out = None
    for encoding, files in sorted(groups.items(), reverse=True):
        reader = spark.read.options(header=True, inferSchema=False, quote='"', escape='"', multiLine=True, encoding=encoding)
        part = reader.csv(sorted(files)).withColumn("_encoding", F.lit(encoding))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no file below {path}")
    return out
