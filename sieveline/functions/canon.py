"""Canonical text of values, row digests and their exact sums.

Values become text in one way per type category, so that the same data gives the same digest whatever the engine, row
order, partitioning or file layout. Digests are SHA-256; a set's fingerprint sums four 60-bit slices of the rows'
digests, which is associative and so needs one partial and one final aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions import types as K

# Canonical text and digests must agree with those of other engines.
#: Stands for NULL in canonical text, and what separates columns; neither occurs in ordinary data.
NULL_TOKEN, SEPARATOR = "\x00NULL\x00", "\x01"
SLICES, SLICE_WIDTH = (1, 16, 31, 46), 15
ROW_VERSION, COLUMN_VERSION = "SHA256-CANON-v1", "SHA256-COL-v2"


def _floating(c: Column) -> Column:
    # by way of text: the shortest decimal that reads back as the same number, in every engine
    number = c.cast("string").try_cast("decimal(38,10)").cast("string")
    special = F.when(F.isnan(c), F.lit("NaN")).when(c == F.lit(float("inf")), F.lit("Infinity")).when(c == F.lit(float("-inf")), F.lit("-Infinity"))
    return special.otherwise(F.coalesce(number, c.cast("string")))


def text_of(c: Column, kind: T.DataType) -> Column:
    """Canonical text of a value, NULL for NULL."""
    what = K.category(kind)
    if what == K.FLOATING:
        return _floating(c)
    if what == K.TIMESTAMP:
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
    if what == K.BINARY:
        return F.hex(c)
    if what == K.VOID:
        return F.lit(None).cast("string")
    if isinstance(kind, T.ArrayType) and K.category(kind.elementType) not in (K.NESTED, K.BINARY):
        inner = F.transform(c, lambda x: F.coalesce(text_of(x, kind.elementType), F.lit("null")))
        return F.when(c.isNotNull(), F.concat(F.lit("["), F.concat_ws(",", inner), F.lit("]")))
    if what == K.NESTED:
        return F.to_json(c, {"ignoreNullFields": "false"}) if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)) else c.cast("string")
    return c.cast("string")


def canonical(c: Column, kind: T.DataType) -> Column:
    """Canonical text with a token for NULL."""
    return F.coalesce(text_of(c, kind), F.lit(NULL_TOKEN))


def canonical_columns(df: DataFrame, exclude: Sequence[str] = ()) -> dict[str, Column]:
    """Canonical text per column in physical order; exclusions by name in any case."""
    out = {x.lower() for x in exclude}
    return {f.name: canonical(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields if f.name.lower() not in out}


def digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of canonical columns with separators."""
    return F.sha2(F.concat_ws(SEPARATOR, *columns), 256)


def exact_sum(h: Column, start: int, weight: Column | None = None, when: Column | None = None) -> Column:
    """The exact sum of a 60-bit slice of hexadecimal digests, as text; 0 without rows.

    The slice is summed as three parts of 20 bits in 64-bit integers, which stay in generated code and can't overflow
    below 2**43 rows, and the three sums are put together once.
    """
    number = F.conv(F.substring(h, start, SLICE_WIDTH), 16, 10).cast("long")
    total = None
    for shift in (40, 20, 0):
        part = F.shiftright(number, shift).bitwiseAND(F.lit((1 << 20) - 1))
        part = part if weight is None else part * weight
        part = F.coalesce(F.sum(part if when is None else F.when(when, part)), F.lit(0).cast("long")).cast("decimal(20,0)") * F.lit(Decimal(1 << shift))
        total = part if total is None else total + part
    return total.cast("decimal(38,0)").cast("string")


def slice_sums(h: Column, when: Column | None = None, weight: Column | None = None) -> list[Column]:
    """Exact sums of the four slices, over the rows that meet ``when``, each ``weight`` times."""
    return [exact_sum(h, s, weight, when) for s in SLICES]


def final_digest(version: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(version), *[p.cast("string") for p in parts]), 256)
