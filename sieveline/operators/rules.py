"""Integrity and schema rules, the observed contract, and the catalogue of controls."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions import types as K
from sieveline.operators import fingerprint, profile

OK, WARNING, ERROR, INFO = "OK", "ALERT", "ERROR", "INFO"
_BAD_NAME = re.compile(r"[ ,;{}()\n\t=]")

#: Controls: level at which each can be decided and its criterion per group of flows (ingestion, analytics).
CONTROLS = {
    "VG-01": (0, "no_failures", "no_failures"), "VG-02": (0, "no_failures", "no_failures"), "VG-03": (0, "no_failures", "no_failures"),
    "VG-04": (0, "no_failures", "no_failures"), "VG-05": (0, "no_failures", "no_failures"), "VG-06": (0, "no_failures", "no_failures"),
    "VG-09": (2, "equal_or_justified", "equal_or_justified"),
    "CP-01": (1, "equal", "informative"), "CP-02": (0, "equal", "equal"), "CP-03": (2, "equal", "informative"),
    "CP-04": (2, "informative", "informative"), "CP-05": (0, "commit_in_window", "commit_in_window"),
    "ID-01": (1, "no_failures", "no_failures"), "ID-02": (2, "no_regression", "no_regression"), "ID-03": (1, "no_regression", "no_regression"),
    "ID-04": (1, "informative", "informative"), "ID-05": (2, "no_regression", "no_regression"), "ID-06": (1, "informative", "informative"),
}


def integrity(df: DataFrame) -> DataFrame:
    """(code, state, evidence) of ID-01..ID-06: rows, duplicates, empty columns, nulls, candidate keys, constants."""
    dup = fingerprint.duplicate_rows(df)
    nulls, derived = profile.nulls(df), profile.derived(df)
    names = lambda frame, when: frame.agg(F.concat_ws(",", F.array_sort(F.collect_list(F.when(when, F.col("column_name"))))).alias("e"), F.count(F.when(when, 1)).alias("n"))
    row = lambda frame, code, state, evidence: frame.select(F.lit(code).alias("code"), state.alias("state"), evidence.cast("string").alias("evidence"))
    some = lambda good, bad: F.when(F.col("n") == 0, good).otherwise(bad)
    parts = [
        row(dup, "ID-01", F.when(F.col("n_rows") > 0, OK).otherwise(ERROR), F.col("n_rows")),
        row(dup, "ID-02", F.when(F.col("n_duplicates") == 0, OK).otherwise(WARNING), F.col("n_duplicates")),
        row(names(nulls, F.col("non_null") == 0), "ID-03", some(OK, WARNING), F.col("e")),
        row(names(nulls, F.col("nulls") > 0), "ID-04", F.lit(INFO), F.col("e")),
        row(names(derived, F.col("candidate_key")), "ID-05", some(WARNING, OK), F.col("e")),
        row(names(derived, F.col("is_constant")), "ID-06", some(OK, INFO), F.col("e")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_findings(schema: T.StructType) -> list[tuple[str, str, str]]:
    """(code, state, columns) of VG-01..VG-06 for a schema."""
    names = [f.name for f in schema.fields]
    low = [n.lower() for n in names]
    oversized = [f.name for f in schema.fields if isinstance(f.dataType, T.DecimalType) and (f.dataType.precision > 38 or f.dataType.scale > f.dataType.precision)]
    nested = [f.name for f in schema.fields if K.category(f.dataType) == K.NESTED and "interval" not in f.dataType.simpleString()]
    found = [
        ("VG-01", ERROR, sorted({n for n in low if low.count(n) > 1})), ("VG-02", ERROR, sorted(n for n in names if _BAD_NAME.search(n))),
        ("VG-03", ERROR, sorted(f.name for f in schema.fields if K.category(f.dataType) == K.VOID or "interval" in f.dataType.simpleString())),
        ("VG-04", ERROR, sorted(oversized)), ("VG-05", INFO, sorted(nested)), ("VG-06", WARNING, sorted(n for n in names if len(n) > 128)),
    ]
    return [(code, state if cols else OK, ",".join(cols)) for code, state, cols in found]


def schema_rules(df: DataFrame) -> DataFrame:
    """(code, state, evidence) of VG-01..VG-06: names, types, precision, nesting and name lengths."""
    return df.sparkSession.createDataFrame(schema_findings(df.schema), "code string, state string, evidence string")


def overall(rules: DataFrame) -> DataFrame:
    """(n_ok, n_alert, n_error, n_info, state): ERROR over OBSERVATIONS over OK."""
    n = {s: F.count(F.when(F.col("state") == s, 1)) for s in (OK, WARNING, ERROR, INFO)}
    out = rules.agg(*[e.alias(f"n_{s.lower()}") for s, e in n.items()])
    return out.withColumn("state", F.when(F.col("n_error") > 0, ERROR).when(F.col("n_alert") > 0, "OBSERVATIONS").otherwise(OK))


def contract(df: DataFrame) -> DataFrame:
    """The observed contract per column: position, type, nullable, pct_null, n_distinct, max_length, candidate_key, fingerprint.

    "Not nullable" says that no null was seen, not that none may come.
    """
    schema = fingerprint.schema_table(df).drop("nullable")
    out = schema.join(profile.nulls(df).select("column_name", "nulls", "pct_null"), "column_name")
    out = out.join(profile.derived(df).select("column_name", "n_distinct", "candidate_key"), "column_name", "left")
    if profile.columns_of(df, K.TEXT):
        out = out.join(profile.text(df).select("column_name", "max_length"), "column_name", "left")
    else:
        out = out.withColumn("max_length", F.lit(None).cast("int"))
    out = out.join(fingerprint.column_fingerprints(df).select("column_name", "fingerprint"), "column_name", "left")
    return out.select("position", "column_name", "data_type", (F.col("nulls") > 0).alias("nullable"), "pct_null", "n_distinct", "max_length", F.coalesce("candidate_key", F.lit(False)).alias("candidate_key"), "fingerprint")
