"""Why two canonical values differ: one cause per pair, the first that fits."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline.functions.canon import NULL_TOKEN

# Texts that stand for nothing, and two-character readings of UTF-8 taken for Latin-1.
BLANKS = ["", "null", "NULL", "None", "nan", "NaN", "N/A", "n/a", "-"]
MOJIBAKE = [
    ("Ã¡", "á"), ("Ã©", "é"), ("Ã­", "í"), ("Ã³", "ó"), ("Ãº", "ú"), ("Ã±", "ñ"), ("Ã‘", "Ñ"), ("Ã\u0081", "Á"),
    ("Ã‰", "É"), ("Ã\u008d", "Í"), ("Ã“", "Ó"), ("Ãš", "Ú"), ("Ã¼", "ü"), ("Â°", "°"), ("Â", ""),
]

PATTERNS = [
    "null_vs_blank", "null_in_target", "null_in_source", "spaces", "case", "accents", "mojibake", "leading_zeros", "same_number_other_scale",
    "numeric_difference", "time_shift", "time_truncation", "same_day_other_time", "same_instant_other_format", "other",
]


def _accent_table() -> tuple[str, str]:
    """Letters U+00C0..U+017F that are a base letter and marks, and their base letters."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))) for c in range(0xC0, 0x180)]
    simple = [(c, d[0]) for c, d in pairs if len(d) > 1 and all(unicodedata.combining(x) for x in d[1:])]
    return "".join(c for c, _ in simple), "".join(d for _, d in simple)


def without_accents(c: Column) -> Column:
    """Lower case without accents, whether they are part of a letter or marks after it."""
    src, dst = _accent_table()
    return F.regexp_replace(F.translate(F.lower(c), src, dst), "[̀-ͯ]", "")


def repaired(c: Column) -> Column:
    for bad, good in MOJIBAKE:
        c = F.replace(c, F.lit(bad), F.lit(good))
    return c


def as_time(c: Column) -> Column:
    """ISO date or time; other texts that Spark would take (a year alone) are NULL."""
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), c.try_cast("timestamp_ntz"))


def any_time(c: Column) -> Column:
    """The first reading that succeeds: ISO, d/M/y, d/M/y H:m:s, yMd, M/d/y."""
    shaped = lambda pattern, fmt: F.when(c.rlike(pattern), F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz"))
    slash = r"^\d{1,2}/\d{1,2}/\d{4}\z"
    return F.coalesce(as_time(c), shaped(slash, "d/M/yyyy"), shaped(r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}\z", "d/M/yyyy H:mm:ss"), shaped(r"^\d{8}\z", "yyyyMMdd"), shaped(slash, "M/d/yyyy"))


def seconds_between(a: Column, b: Column) -> Column:
    """Whole seconds from a to b, by seconds of the clock."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", a).cast("timestamp_ntz"), F.date_trunc("second", b).cast("timestamp_ntz"))


def pattern(source: Column, target: Column) -> Column:
    """The cause label of two differing canonical values (with the NULL token for NULL)."""
    s, f = (F.nullif(c, F.lit(NULL_TOKEN)) for c in (source, target))
    blank = lambda c: F.coalesce(c, F.lit("")).isin(BLANKS)
    num_s, num_f = s.try_cast("decimal(38,10)"), f.try_cast("decimal(38,10)")
    ts_s, ts_f = as_time(s), as_time(f)
    both_num, both_ts = num_s.isNotNull() & num_f.isNotNull(), ts_s.isNotNull() & ts_f.isNotNull()
    midnight = lambda t: F.date_format(t, "HH:mm:ss.SSSSSS") == "00:00:00.000000"
    same_day = ts_s.cast("date") == ts_f.cast("date")
    strange = s.contains("Ã") | f.contains("Ã") | s.contains("Â") | f.contains("Â")
    stripped = lambda c: F.regexp_replace(c, "^0+", "")
    return (
        F.when((s.isNull() & blank(f)) | (f.isNull() & blank(s)), "null_vs_blank")
        .when(f.isNull(), "null_in_target")
        .when(s.isNull(), "null_in_source")
        .when(F.trim(s) == F.trim(f), "spaces")
        .when(F.lower(F.trim(s)) == F.lower(F.trim(f)), "case")
        .when(without_accents(s) == without_accents(f), "accents")
        .when((repaired(s) == repaired(f)) & strange, "mojibake")
        .when(stripped(s) == stripped(f), "leading_zeros")
        .when(both_num & (num_s == num_f), "same_number_other_scale")
        .when(both_num, "numeric_difference")
        .when(both_ts & (seconds_between(ts_s, ts_f) % 1800 == 0), "time_shift")
        .when(both_ts & ((F.date_trunc("second", ts_s) == F.date_trunc("second", ts_f)) | (same_day & (midnight(ts_s) | midnight(ts_f)))), "time_truncation")
        .when(both_ts & same_day, "same_day_other_time")
        .when(any_time(s) == any_time(f), "same_instant_other_format")
        .otherwise("other")
    )


def thousands(c: Column) -> Column:
    """A whole number's text with dots between thousands."""
    return F.replace(F.format_number(c.cast("long"), 0), F.lit(","), F.lit("."))
