"""Exact fingerprints of rows, tables, columns and schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions import canon
from sieveline.functions import types as K
from sieveline.functions.scale import spread

# Fixed value: a character outside ASCII, or a control character other than tab, newline and carriage return.
UNUSUAL = r"[^\x00-\x7F]|[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def row_digests(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """The rows with their digest ``h``."""
    return df.withColumn("h", canon.digest(list(canon.canonical_columns(df, exclude).values())))


def dataset_fingerprint(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row: n_rows, n_distinct, n_duplicates, s1..s4 and fingerprint. Row order, partitions and files don't matter.

    Counting duplicates shuffles a digest of 32 bytes per distinct row; :func:`row_fingerprint` goes without.

    Rows are first counted per digest (partial aggregation merges copies before the shuffle), so duplicates are exact and a
    hot row costs one entry per task. An empty table has a fingerprint of its own.
    """
    h = canon.digest(list(canon.canonical_columns(df, exclude).values()))
    per = spread(df).select(F.unhex(h).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("c"))
    sums = [s.alias(f"s{i}") for i, s in enumerate(canon.slice_sums(F.lower(F.hex("h")), weight=F.col("c")), 1)]
    out = per.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"), *sums)
    out = out.withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))
    return out.withColumn("fingerprint", canon.final_digest(canon.ROW_VERSION, F.col("n_rows"), *[F.col(f"s{i}") for i in range(1, 5)]))


def row_fingerprint(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row: n_rows and the fingerprint of :func:`dataset_fingerprint`, by sums alone, with nothing to shuffle but these."""
    h = canon.digest(list(canon.canonical_columns(df, exclude).values()))
    sums = [s.alias(f"s{i}") for i, s in enumerate(canon.slice_sums(F.col("h")), 1)]
    out = spread(df).select(h.alias("h")).agg(F.count(F.lit(1)).alias("n_rows"), *sums)
    return out.select("n_rows", canon.final_digest(canon.ROW_VERSION, F.col("n_rows"), *[F.col(f"s{i}") for i in range(1, 5)]).alias("fingerprint"))


def duplicate_rows(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """n_rows, n_distinct, n_duplicates, by row digests."""
    return dataset_fingerprint(df, exclude).select("n_rows", "n_distinct", "n_duplicates")


def column_fingerprints(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """(column_name, n_rows, fingerprint) per column, without the name in the digest, so that renaming doesn't change it."""
    columns = canon.canonical_columns(df, exclude)
    digests = spread(df).select(*[F.sha2(c, 256).alias(f"c{i}") for i, c in enumerate(columns.values())])  # once a column, not once a sum
    wide = digests.agg(F.count(F.lit(1)).alias("n_rows"), *[canon.exact_sum(F.col(f"c{i}"), 1).alias(f"c{i}") for i in range(len(columns))])
    long = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"c{i}").alias("s")) for i, n in enumerate(columns)]))
    out = wide.select("n_rows", long.alias("x")).select("x.column_name", "n_rows", "x.s")
    return out.select("column_name", "n_rows", canon.final_digest(canon.COLUMN_VERSION, F.col("n_rows"), F.col("s")).alias("fingerprint"))


def column_set_fingerprint(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """(n_columns, fingerprint): the same for tables that differ by the order or the names of columns only."""
    per = column_fingerprints(df, exclude)
    ordered = F.array_sort(F.collect_list("fingerprint"))
    return per.agg(F.count(F.lit(1)).alias("n_columns"), F.sha2(F.concat_ws("|", ordered), 256).alias("fingerprint"))


def affected(df: DataFrame) -> Column:
    """Whether any text column is null, blank or holds an unusual character."""
    tests = [F.col(f"`{f.name}`") for f in df.schema.fields if K.category(f.dataType) == K.TEXT]
    each = [c.isNull() | (F.trim(c) == "") | c.rlike(UNUSUAL) for c in tests]
    return reduce(lambda a, b: a | b, each) if each else F.lit(False)


def segregation(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """(part, n_rows, fingerprint) for clean and affected rows."""
    h = canon.digest(list(canon.canonical_columns(df, exclude).values()))
    marked = spread(df).select(h.alias("h"), affected(df).alias("bad"))
    sums = [x for part, when in (("clean", ~F.col("bad")), ("affected", F.col("bad"))) for x in [F.count(F.when(when, 1)).alias(f"{part}_n"), *[s.alias(f"{part}_{i}") for i, s in enumerate(canon.slice_sums(F.col("h"), when))]]]
    wide = marked.agg(*sums)
    rows = [F.struct(F.lit(p).alias("part"), F.col(f"{p}_n").alias("n_rows"), canon.final_digest(canon.ROW_VERSION, F.col(f"{p}_n"), *[F.col(f"{p}_{i}") for i in range(4)]).alias("fingerprint")) for p in ("clean", "affected")]
    return wide.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def crc_fingerprint(df: DataFrame) -> DataFrame:
    """(n_rows, crc_sum, schema_digest): CRC-32 of the rows' canonical text in alphabetical column order, summed.

    Columns are separated and NULL has a token, so that shifted values can't cancel out.
    """
    columns = canon.canonical_columns(df)
    text = F.concat_ws(canon.SEPARATOR, *[columns[n] for n in sorted(columns)])
    shape = "|".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(df.schema.fields, key=lambda f: f.name))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.crc32(text.cast("binary")).cast("decimal(20,0)")), F.lit(0)).cast("string").alias("crc_sum"), F.substring(F.sha2(F.lit(shape), 256), 1, 16).alias("schema_digest"))


def sample(df: DataFrame, n: int) -> DataFrame:
    """``n`` rows as canonical text, the first by the digest of that text: a choice that storage and order don't change."""
    rows = df.select(*[e.alias(c) for c, e in canon.canonical_columns(df).items()])
    return rows.orderBy(canon.digest([F.col(f"`{c}`") for c in rows.columns])).limit(n)


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable) of a frame's columns."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def schema_fingerprints(df: DataFrame) -> DataFrame:
    """(strict, types, names): digests of the schema sorted by name; strict has nullability, names has names only."""
    rows = schema_table(df)
    parts = {
        "strict": F.concat_ws("|", "column_name", "data_type", F.col("nullable").cast("string")),
        "types": F.concat_ws("|", "column_name", "data_type"),
        "names": F.col("column_name"),
    }
    return rows.agg(*[F.sha2(F.concat_ws("||", F.transform(F.array_sort(F.collect_list(F.struct(F.col("column_name").alias("n"), e.alias("e")))), lambda x: x["e"])), 256).alias(k) for k, e in parts.items()])
