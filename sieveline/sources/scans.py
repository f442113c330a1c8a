"""Readers: Parquet folders, drifting files, CSV, transaction logs, footers, databases, and the view over a scan."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions import types as K


def parquet_folder(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder by name across files; partition values stay text. Hidden files are not read."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    finally:
        spark.conf.set(key, before)


def union_by_name(frames: Iterable[DataFrame], as_text: Sequence[str] = ()) -> DataFrame:
    """All frames by column name; the given columns become text first, where files disagree on their type."""
    out = None
    for df in frames:
        df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c in as_text if c in df.columns})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to unite")
    return out


def is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether all files under a path are valid UTF-8, by their bytes (text readers replace bad bytes silently)."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.is_valid_utf8(F.col("content").cast("string")).alias("ok")).where("not ok").isEmpty()


def csv(spark: SparkSession, path: str, encoding: str | None = None) -> tuple[DataFrame, str]:
    """An RFC 4180 file as text columns, and the encoding: UTF-8 where the bytes are valid, else Latin-1."""
    encoding = encoding or ("UTF-8" if is_utf8(spark, path) else "ISO-8859-1")
    reader = spark.read.options(header=True, inferSchema=False, quote='"', escape='"', multiLine=True, encoding=encoding)
    return reader.csv(path), encoding


#: Readers to try by where a path lies and how it ends.
_BY_SUFFIX = {".parquet": ["parquet"], ".csv": ["csv"], ".json": ["json"], ".jsonl": ["json"], ".orc": ["orc"]}


def formats_for(path: str, spark: SparkSession | None = None) -> list[str]:
    """Formats in the order in which they are worth trying; with a session, a file of an unknown ending is looked into."""
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    if suffix in _BY_SUFFIX:
        return _BY_SUFFIX[suffix]
    if spark is not None and suffix and is_parquet(spark, path):
        return ["parquet"]
    return ["delta", "parquet"] if "/Tables/" in f"/{path}/" else ["parquet", "delta", "csv", "json"]


def read_any(spark: SparkSession, path: str) -> tuple[DataFrame | None, str | None, dict[str, str]]:
    """The first reader that can open a path, its name, and why the ones before it could not."""
    errors: dict[str, str] = {}
    for name in formats_for(path, spark):
        try:
            df = delta_table(spark, path) if name == "delta" else csv(spark, path)[0] if name == "csv" else spark.read.format(name).load(path)
            return df, name, errors
        except Exception as e:  # noqa: BLE001  any reader's reason is kept for the report
            errors[name] = str(e).splitlines()[0][:200]
    return None, None, errors


def delta_actions(spark: SparkSession, table: str) -> DataFrame:
    """All actions of a table's log with their version: JSON commits after the newest checkpoint, and the checkpoint.

    (version, path, op, rows, size, dv, dv_rows, schema, ts, operation); op is add, remove, meta or commit.
    """
    log = f"{table.rstrip('/')}/_delta_log"
    schema = "add struct<path:string,size:long,modificationTime:long,stats:string,deletionVector:struct<storageType:string,cardinality:long>>, remove struct<path:string>, metaData struct<schemaString:string>, commitInfo struct<timestamp:long,operation:string>"
    kept = ["add", "remove", "metaData", "commitInfo"]

    def flat(df: DataFrame, version: Column) -> DataFrame:
        df = df.withColumn("version", version)
        op = F.when(F.col("add").isNotNull(), "add").when(F.col("remove").isNotNull(), "remove").when(F.col("metaData").isNotNull(), "meta").when(F.col("commitInfo").isNotNull(), "commit")
        rows = F.get_json_object("add.stats", "$.numRecords").cast("long")
        return df.select(
            "version", F.coalesce("add.path", "remove.path").alias("path"), op.alias("op"), rows.alias("rows"), F.col("add.size").alias("size"),
            F.col("add.deletionVector").isNotNull().alias("dv"), F.col("add.deletionVector.cardinality").alias("dv_rows"), F.col("metaData.schemaString").alias("schema"),
            F.coalesce("commitInfo.timestamp", "add.modificationTime").alias("ts"), F.col("commitInfo.operation").alias("operation"),
        ).where("op is not null")

    number = lambda: F.regexp_extract("_metadata.file_name", r"^(\d+)", 1).cast("long")
    commits = flat(spark.read.schema(schema).option("pathGlobFilter", "*.json").json(log), number())
    points = spark.read.option("pathGlobFilter", "*.checkpoint*.parquet").option("mergeSchema", True)
    try:
        point = points.parquet(log)
    except Exception:  # noqa: BLE001  a table without a checkpoint has only JSON commits
        return commits
    newest = point.select(number().alias("v")).agg(F.max("v")).first()[0]
    if newest is None:
        return commits
    have = set(point.columns)
    typed = T._parse_datatype_string(schema)
    for name in kept:
        if name not in have:
            point = point.withColumn(name, F.lit(None).cast(typed[name].dataType))
        else:  # only the fields that are used, and nulls for those that this writer left out
            fields = {f.name for f in point.schema[name].dataType.fields}
            parts = [(F.col(f"{name}.{f.name}") if f.name in fields and not isinstance(f.dataType, T.StructType) else F.when(F.col(f"{name}.{f.name}").isNotNull(), F.struct(F.lit("u").alias("storageType"), F.col(f"{name}.{f.name}.cardinality").cast("long").alias("cardinality"))) if f.name in fields else F.lit(None)).cast(f.dataType).alias(f.name) for f in typed[name].dataType.fields]
            point = point.withColumn(name, F.when(F.col(name).isNotNull(), F.struct(*parts)))
    base = flat(point.withColumn("__v", number()).where(F.col("__v") == newest), F.col("__v"))
    return base.unionByName(commits.where(F.col("version") > newest))


# Fixed value: the base-85 digits in which a deletion vector's file is named.
BASE_85 = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ.-:+=^!/*?&<>()[]{}@%$#"


def deletion_vector_file(stored: Column) -> Column:
    """The file of a deletion vector that is stored by a random prefix and 20 base-85 digits, relative to its table; NULL for other text.

    The digits are four big-endian 32-bit numbers of five digits each, together a UUID.
    """
    digits = F.substring(stored, -20, 20)
    value = lambda i: F.call_function("locate", F.substr(digits, i, F.lit(1)), F.lit(BASE_85)) - 1
    words = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda w: F.aggregate(F.sequence(F.lit(1), F.lit(5)), F.lit(0).cast("long"), lambda n, i: n * 85 + value(w * 5 + i)))
    text = F.lower(F.array_join(F.transform(words, lambda n: F.lpad(F.hex(n), 8, "0")), ""))
    name = F.concat(F.lit("deletion_vector_"), F.regexp_replace(text, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(".bin"))
    folder = F.substr(stored, F.lit(1), F.length(stored) - 20)
    return F.when(F.length(stored) >= 20, F.when(F.length(folder) > 0, F.concat(folder, F.lit("/"), name)).otherwise(name))


def delta_live_files(actions: DataFrame) -> DataFrame:
    """(path, rows, size, dv, dv_rows) of the live files: each path's last action, if it is an add."""
    files = actions.where("op in ('add', 'remove')")
    # within a commit that removes and adds a path again, the add counts
    last = files.groupBy("path").agg(F.max_by(F.struct("op", "rows", "size", "dv", "dv_rows"), F.struct("version", F.when(F.col("op") == "add", 1).otherwise(0).alias("o"))).alias("x"))
    return last.where("x.op = 'add'").select("path", "x.rows", "x.size", "x.dv", "x.dv_rows")


def delta_commits(actions: DataFrame) -> DataFrame:
    """(version, ts, operation): each commit's time, from its own record or else its newest file."""
    return actions.groupBy("version").agg(F.coalesce(F.max(F.when(F.col("op") == "commit", F.col("ts"))), F.max("ts")).alias("ts"), F.max("operation").alias("operation"))


def delta_table(spark: SparkSession, table: str) -> DataFrame:
    """A table by its log: live files only. Deletion vectors need the Delta reader; without it this fails, not miscounts."""
    try:
        return spark.read.format("delta").load(table)
    except Exception:  # noqa: BLE001  no Delta reader in this session
        live = delta_live_files(delta_actions(spark, table))
    if not live.where("dv").isEmpty():
        raise ValueError(f"{table} has deletion vectors, which need the Delta reader")
    paths = [f"{table.rstrip('/')}/{r['path']}" for r in live.select("path").collect()]  # names of files, as any reader lists them
    return spark.read.option("basePath", table).option("mergeSchema", True).parquet(*paths)


def footer_profile(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """(file, column_name, kind, n_rows, nulls, low, high, has_stats) from Parquet footers alone.

    Spark lists the files; each is opened on an executor and its last bytes are read, whatever its size. A store that
    pyarrow can't open needs ``whole_files``: then Spark hands out all bytes, and files are limited to 2 GB.
    """
    def run(batches: Iterator) -> Iterator:
        import io

        import pandas as pd
        import pyarrow.parquet as pq
        from pyarrow import fs

        def opened(name: str, content: bytes | None):
            if content is not None:
                return io.BytesIO(content)
            if name.startswith("file:"):
                return fs.LocalFileSystem().open_input_file("/" + name.removeprefix("file:").lstrip("/"))
            store, at = fs.FileSystem.from_uri(name)
            return store.open_input_file(at)

        as_text = lambda v: None if v is None else str(v)
        for pdf in batches:
            rows = []
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                meta = pq.ParquetFile(opened(name, content)).metadata
                for i in range(meta.num_columns):
                    stats = [meta.row_group(g).column(i).statistics for g in range(meta.num_row_groups)]
                    column = meta.schema.column(i)
                    flat = column.path == column.name and column.max_repetition_level == 0
                    ok = flat and all(s is not None and s.has_null_count for s in stats)
                    low = [s.min for s in stats if ok and s.has_min_max]
                    high = [s.max for s in stats if ok and s.has_min_max]
                    kind = column.physical_type if column.logical_type.type == "NONE" else str(column.logical_type)
                    rows.append((name, column.path.split(".")[0], kind, meta.num_rows, sum(s.null_count for s in stats) if ok else None, as_text(min(low, default=None)), as_text(max(high, default=None)), ok))
            yield pd.DataFrame(rows, columns=["file", "column_name", "kind", "n_rows", "nulls", "low", "high", "has_stats"]).astype({"nulls": "Int64"})

    content = "content" if whole_files else F.lit(None).cast("binary").alias("content")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", content)
    return files.mapInPandas(run, "file string, column_name string, kind string, n_rows long, nulls long, low string, high string, has_stats boolean")


def footer_aggregate(footers: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """(column_name, n_rows, nulls, exact, kinds): over all files; not exact where a file lacks statistics or the column.

    ``kinds``: the types that files give the column, more than one where they drift. ``deleted``: (path, dv_rows), the rows that
    deletion vectors take from a file; they are subtracted from n_rows, and as their values aren't known nulls are not exact.
    """
    files = footers.select("file", "n_rows").distinct()
    gone = F.lit(0).cast("long").alias("gone")
    if deleted is not None:
        files = files.withColumn("name", F.element_at(F.split("file", "/"), -1)).join(deleted.select(F.element_at(F.split("path", "/"), -1).alias("name"), "dv_rows"), "name", "left")
        gone = F.coalesce(F.sum("dv_rows"), F.lit(0)).alias("gone")
    total = files.agg(F.sum("n_rows").alias("total"), gone)
    per = footers.groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("nulls").alias("nulls"), F.min("has_stats").alias("ok"), F.array_sort(F.collect_set("kind")).alias("kinds"))
    nulls = F.coalesce("nulls", F.lit(0)) + F.col("total") - F.col("n_rows")
    exact = F.col("ok") & (F.col("total") == F.col("n_rows")) & (F.col("gone") == 0)
    return per.join(F.broadcast(total)).select("column_name", (F.col("total") - F.col("gone")).alias("n_rows"), nulls.alias("nulls"), exact.alias("exact"), "kinds")  # one row


def matching_files(spark: SparkSession, path: str, pattern: str = ".*", since: str | None = None) -> DataFrame:
    """(path, name, n_bytes, modified): the files of a folder whose name matches, changed since a time; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if since:
        files = files.option("modifiedAfter", since)
    name = F.element_at(F.split("path", "/"), -1)
    return files.load(path).select("path", name.alias("name"), F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified")).where(F.col("name").rlike(pattern))


def changed_files(listing: DataFrame, seen: DataFrame) -> DataFrame:
    """Of (path, n_bytes, modified) the files that an earlier listing lacks or has with another size or time."""
    return listing.join(seen.select("path", "n_bytes", "modified"), ["path", "n_bytes", "modified"], "left_anti")


def transcripts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, ts, request_id, model, the four token counts, context_tokens) of logged model calls, JSON lines.

    A request that stands on several lines of a file counts once, as its first; lines that are no JSON, have no request
    or name no real model are left out. ``path`` may be a list, as of :func:`changed_files`.
    """
    usage = "input_tokens: bigint, cache_creation_input_tokens: bigint, cache_read_input_tokens: bigint, output_tokens: bigint"
    schema = f"type string, timestamp timestamp, requestId string, message struct<model: string, usage: struct<{usage}>>"
    lines = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).json(path).withColumn("file", F.col("_metadata.file_path"))
    lines = lines.where("type = 'assistant' and requestId is not null and message.model is not null and message.model not like '<%'")
    once = lines.groupBy("file", "requestId").agg(F.min_by(F.struct("timestamp", "message"), "timestamp").alias("x"))
    count = lambda c: F.coalesce(F.col(f"x.message.usage.{c}"), F.lit(0))
    tokens = {"input_tokens": count("input_tokens"), "cache_write_tokens": count("cache_creation_input_tokens"), "cache_read_tokens": count("cache_read_input_tokens"), "output_tokens": count("output_tokens")}
    out = once.select("file", F.col("x.timestamp").alias("ts"), F.col("requestId").alias("request_id"), F.col("x.message.model").alias("model"), *[e.alias(n) for n, e in tokens.items()])
    return out.withColumn("context_tokens", F.col("input_tokens") + F.col("cache_write_tokens") + F.col("cache_read_tokens"))


def is_parquet(spark: SparkSession, path: str) -> bool:
    """Whether a file begins with Parquet's magic bytes; its head is all that is read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        return bytes(b & 0xFF for b in (stream.read() for _ in range(4)) if b >= 0) == b"PAR1"
    finally:
        stream.close()


def table_profile(df: DataFrame, block: int = 40) -> DataFrame:
    """(column_name, n_rows, non_null, low, high, min_length, max_length) by aggregates that a database can take over.

    Blocks of columns; booleans by their number, columns without an order only counted.
    """
    out = None
    fields = df.schema.fields
    for at in range(0, len(fields), block):
        part = fields[at : at + block]
        aggs = [F.count(F.lit(1)).alias("n")]
        rows = []
        for i, f in enumerate(part):
            c, kind = F.col(f"`{f.name}`"), K.category(f.dataType)
            aggs.append(F.count(c).alias(f"nn{i}"))
            ordered = kind not in (K.NESTED, K.BINARY, K.VOID)
            value = c.cast("int") if kind == K.BOOL else c
            aggs += [(F.min(value).cast("string") if ordered else F.lit(None).cast("string")).alias(f"lo{i}"), (F.max(value).cast("string") if ordered else F.lit(None).cast("string")).alias(f"hi{i}")]
            aggs += [(F.min(F.length(c)) if kind == K.TEXT else F.lit(None).cast("int")).alias(f"l{i}"), (F.max(F.length(c)) if kind == K.TEXT else F.lit(None).cast("int")).alias(f"m{i}")]
            rows.append(F.struct(F.lit(f.name).alias("column_name"), F.col("n").alias("n_rows"), F.col(f"nn{i}").alias("non_null"), F.col(f"lo{i}").alias("low"), F.col(f"hi{i}").alias("high"), F.col(f"l{i}").alias("min_length"), F.col(f"m{i}").alias("max_length")))
        long = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("x")).select("x.*")
        out = long if out is None else out.unionByName(long)
    return out


def view(df: DataFrame, *, exclude: Sequence[str] = (), casts: Mapping[str, str] | None = None, date_column: str | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """What is compared: columns without the excluded ones, declared types, rows of an inclusive window. Lazy."""
    gone = {x.lower() for x in exclude}
    df = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in gone])
    for name, kind in (casts or {}).items():
        if name in df.columns:
            df = df.withColumn(name, F.col(f"`{name}`").try_cast(kind))
    if date_column and since:
        df = df.where(F.col(f"`{date_column}`") >= F.lit(since).cast(df.schema[date_column].dataType))
    if date_column and until:
        df = df.where(F.col(f"`{date_column}`") <= F.lit(until).cast(df.schema[date_column].dataType))
    return df


def dedup_except(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per combination of the other columns, with the least value of the given ones."""
    rest = [c for c in df.columns if c not in columns]
    return df.groupBy(*[f"`{c}`" for c in rest]).agg(*[F.min(f"`{c}`").alias(c) for c in columns]).select(*df.columns)


def adhoc(spark: SparkSession, source: DataFrame, target: DataFrame, sql: str, limit: int = 200) -> DataFrame:
    """A query over the views S and F; results of an interactive query end at ``limit`` rows."""
    source.createOrReplaceTempView("S")
    target.createOrReplaceTempView("F")
    return spark.sql(sql).limit(limit)
