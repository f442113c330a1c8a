"""Exact column profiles: one wide aggregation per block of columns, reshaped into long tables.

Distinct counts and quantiles are the costly part; they stand in operators of their own, so that a profile without
them is a single map-side combined pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions import types as K
from sieveline.functions.scale import dealt, spread

#: Columns per pass: wide aggregations leave generated code beyond about a hundred expressions.
BLOCK = 14

# What counts as a stand-in for a missing value.
SENTINEL_TEXTS = ["", " ", "NULL", "null", "Null", "N/A", "NA", "n/a", "#N/D", "#N/A", "-", "--", ".", "?", "SIN DATO", "SIN INFORMACION", "0", "00000000", "0000-00-00", "99991231", "9999-12-31"]
SENTINEL_DATES = ["0001-01-01", "1900-01-01", "1970-01-01", "9999-12-31", "2099-12-31"]
# The text forensics' patterns. \z is the end of the text; $ would also match before a last newline.
FORENSICS = {
    "integer_text": r"^[+-]?[0-9]+\z",
    "number_text": r"^[+-]?([0-9]+([.,][0-9]+)?|[.,][0-9]+)\z",
    "date_text": r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{4}/[0-9]{2}/[0-9]{2})\z",
    "leading_zero": r"^0[0-9]+\z",
    "non_ascii": r"[^\x00-\x7F]",
    "control": r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]",
    "email": r"^[^@\t\n\f\r ]+@[^@\t\n\f\r ]+\.[A-Za-z]{2,}\z",
}


def columns_of(df: DataFrame, *categories: str, only: Sequence[str] | None = None) -> list[str]:
    return [f.name for f in df.schema.fields if (not categories or K.category(f.dataType) in categories) and (only is None or f.name in only)]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _value(df: DataFrame, name: str) -> Column:
    """A value as it is told apart from others: 0.0 and -0.0 are the same."""
    kind = df.schema[name].dataType
    return F.when(_c(name) == 0, F.lit(0).cast(kind)).otherwise(_c(name)) if K.category(kind) == K.FLOATING else _c(name)


def _sum(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def _long(df: DataFrame, names: Iterable[str], metrics: dict[str, Column | callable], shared: dict[str, Column] | None = None) -> DataFrame:
    """A row per column with the given metrics (functions of a column), by blocks of columns."""
    names, shared, out = list(names), shared or {}, None
    for at in range(0, len(names), BLOCK):
        block = names[at : at + BLOCK]
        wide = df.agg(*[e.alias(k) for k, e in shared.items()], *[m(n).alias(f"c{i}_{k}") for i, n in enumerate(block) for k, m in metrics.items()])
        rows = [F.struct(F.lit(n).alias("column_name"), *[F.col(k).alias(k) for k in shared], *[F.col(f"c{i}_{k}").alias(k) for k in metrics]) for i, n in enumerate(block)]
        part = wide.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("the table has no column of this kind")
    return out


def nulls(df: DataFrame) -> DataFrame:
    """(column_name, n_rows, non_null, nulls, pct_null)."""
    out = _long(df, df.columns, {"non_null": lambda n: F.count(_c(n))}, {"n_rows": F.count(F.lit(1))})
    gone = F.col("n_rows") - F.col("non_null")
    return out.select("column_name", "n_rows", "non_null", gone.alias("nulls"), F.when(F.col("n_rows") > 0, F.round(100.0 * gone / F.col("n_rows"), 4)).alias("pct_null"))


#: Relative standard deviation of sketched distinct counts: a tenth off is ten times as much.
SKETCH = 0.01


def distincts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column_name, n_distinct) of every column but nested, binary and void ones.

    Exact: (column, value) pairs are counted once in long form, which combines map-side and needs no row per distinct
    aggregate. ``approximate`` uses a sketch; verdicts never do.
    """
    names = [f.name for f in df.schema.fields if K.category(f.dataType) not in (K.NESTED, K.BINARY, K.VOID)]
    if approximate:
        return _long(df, names, {"n_distinct": lambda n: F.approx_count_distinct(_c(n), SKETCH)})
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _value(df, n).cast("string").alias("v")) for i, n in enumerate(names)]))
    per = dealt(df).select(pairs.alias("p")).select("p.i", "p.v").where("v is not null").distinct().groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    # columns without any value have no pair
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("k") + 1)
    all_names = df.sparkSession.range(len(names)).select(F.col("id").cast("int").alias("k"))
    return all_names.join(F.broadcast(per), F.col("k") == F.col("i"), "left").select(name.alias("column_name"), F.coalesce("n", F.lit(0)).cast("long").alias("n_distinct"))


def _finite(n: str, kind: str) -> Column:
    c = _c(n)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c) if kind == K.FLOATING else c


def _as_decimal(c: Column, kind: str) -> Column:
    """A number as decimal(38,10) (integers as decimal(38,0)); NULL where it has no room there."""
    return c.cast("string").try_cast("decimal(38,10)") if kind == K.FLOATING else c.cast("decimal(38,0)") if kind == K.INTEGER else c


def number_text(c: Column, kind: str) -> Column:
    """A number's text: with ten decimals where that is exactly the number, else the shortest that reads back as it."""
    if kind != K.FLOATING:
        return c.cast("string")
    fixed = _as_decimal(c, kind)
    return F.when(fixed.cast("double") == c.cast("double"), fixed.cast("string")).otherwise(c.cast("string"))


#: Most floating columns hold amounts: as whole ten-thousandths they are added up exactly without decimals.
SCALE = 10_000.0


#: Where a decimal is cut for its sum; a sum's lower limb then has 24 digits, ten of them after the point.
LIMB = 10**14


def _joined_sum() -> Column:
    """The sum of the parts r40, r20, r0, above and below, as text with ten decimals and any number of digits before; NULL without parts."""
    some = F.col("r0").isNotNull() | F.col("below").isNotNull()
    zero, lower = F.lit(Decimal(0)), F.lit(Decimal(LIMB * 10**10))
    fast = zero
    for shift in (40, 20, 0):
        fast = fast + F.coalesce(F.col(f"r{shift}").cast("decimal(20,0)"), zero) * F.lit(Decimal(1 << shift))
    below = F.coalesce(F.replace(F.col("below").cast("string"), F.lit("."), F.lit("")).cast("decimal(38,0)"), zero)
    low = (fast.cast("decimal(30,0)") * F.lit(Decimal(10**6)) + below).cast("decimal(38,0)")  # in units of 10**-10
    carry = F.floor((low - F.pmod(low, lower)) / lower).cast("decimal(30,0)")
    high = (F.coalesce("above", zero) + carry).cast("decimal(38,0)")
    rest = F.pmod(low, lower).cast("decimal(24,0)")
    # High is rounded down, so that the rest is never negative: a negative number is its counterpart with a sign.
    minus = high < 0
    digits = F.when(minus & (rest > 0), F.concat((-high - 1).cast("string"), F.lpad((lower - rest).cast("string"), 24, "0"))).otherwise(F.concat(F.abs(high).cast("string"), F.lpad(rest.cast("string"), 24, "0")))
    text = F.regexp_replace(F.regexp_replace(digits, "^0+(?=[0-9]{11})", ""), "([0-9]{10})$", ".$1")
    return F.when(some, F.concat(F.when(minus, "-").otherwise(""), text))


def numeric(df: DataFrame) -> DataFrame:
    """(column_name, minimum, maximum, exact_sum, zeros, negatives, nans, infinities, inexact, mean) with numbers as text.

    Bounds are of the values themselves, without NaN and infinities. ``inexact`` counts the floating values that ten decimals
    don't hold exactly (or at all); where there are any, the sum lacks or rounds them, and the mean is that of doubles.
    """
    kinds = {f.name: K.category(f.dataType) for f in df.schema.fields}
    names = columns_of(df, *K.NUMERIC)
    # Once a row: the finite value, and of floating ones its ten-thousandths where that many are exactly the value, else its decimal.
    once: list[Column] = []
    for i, n in enumerate(names):
        value = _finite(n, kinds[n])
        once += [value.alias(f"v{i}"), _c(n).alias(f"c{i}")]
        if kinds[n] == K.FLOATING:
            whole = F.when(F.abs(value) < 1e11, F.rint(value.cast("double") * SCALE).cast("long"))
            few = whole.cast("double") / SCALE == value.cast("double")
            once += [F.when(few, whole).alias(f"r{i}"), F.when(~F.coalesce(few, F.lit(False)), _as_decimal(value, K.FLOATING)).alias(f"d{i}")]
        else:
            once.append(_as_decimal(value, kinds[n]).alias(f"d{i}"))
    at = {n: i for i, n in enumerate(names)}
    col = lambda kind, n: F.col(f"{kind}{at[n]}")
    floating = lambda n, e: e(col("c", n)) if kinds[n] == K.FLOATING else F.lit(False)

    def sums(n: str) -> dict[str, Column]:
        """The sum in parts that can't overflow: ten-thousandths by 20 bits, decimals by what lies above and below ``LIMB``."""
        d, none = col("d", n), F.lit(None)
        if kinds[n] != K.FLOATING:
            return {"plain": F.sum(d).cast("string"), **{f"r{s}": none.cast("long") for s in (40, 20, 0)}, "above": none.cast("decimal(30,0)"), "below": none.cast("decimal(35,10)")}
        bits = {f"r{s}": F.shiftright(col("r", n), s) for s in (40, 20, 0)}  # sums of 20 bits in 64-bit integers are exact below 2**43 rows
        limb = F.lit(Decimal(LIMB))
        above = F.expr(f"d{at[n]} div {LIMB}BD")
        return {"plain": none.cast("string"), **{k: F.sum(b if k == "r40" else b.bitwiseAND(F.lit((1 << 20) - 1))) for k, b in bits.items()}, "above": F.sum(above.cast("decimal(20,0)")), "below": F.sum(d % limb).cast("decimal(35,10)")}

    out = _long(df.select(*once), names, {
        "minimum": lambda n: number_text(F.min(col("v", n)), kinds[n]), "maximum": lambda n: number_text(F.max(col("v", n)), kinds[n]),
        **{k: (lambda n, k=k: sums(n)[k]) for k in ("plain", "r40", "r20", "r0", "above", "below")}, "zeros": lambda n: _sum(col("c", n) == 0), "negatives": lambda n: _sum(col("c", n) < 0),
        "nans": lambda n: _sum(floating(n, F.isnan)), "infinities": lambda n: _sum(floating(n, lambda c: F.abs(c) == F.lit(float("inf")))),
        "inexact": lambda n: _sum(F.coalesce(col("d", n).cast("double") != col("v", n).cast("double"), col("v", n).isNotNull() & col("r", n).isNull())) if kinds[n] == K.FLOATING else F.lit(0).cast("long"),
        "n": lambda n: F.count(col("v", n)), "average": lambda n: F.avg(col("v", n).cast("double")),
    })
    out = out.withColumn("exact_sum", F.coalesce("plain", _joined_sum()))
    exact = F.col("exact_sum").cast("double") / F.col("n")
    mean = F.when(F.col("n") > 0, F.when(F.col("inexact") == 0, F.coalesce(exact, F.col("average"))).otherwise(F.col("average")))
    mean = F.when(F.col("inexact") == 0, F.round(mean, 6)).otherwise(mean)
    return out.select("column_name", "minimum", "maximum", "exact_sum", "zeros", "negatives", "nans", "infinities", "inexact", mean.alias("mean"))


#: Accuracy of the sketches that bracket a quantile: its rank is known to one in as many rows.
BRACKET = 10_000
#: Rows that a bracket may hold; one that holds more, of more than one value, is narrowed by a sketch of its own.
INSIDE = 1_000_000


def _wider(lo: float, hi: float) -> tuple[float, float]:
    """Bounds in doubles give way by what a double may have cut off of them; infinite ones are what they are."""
    return (lo if math.isinf(lo) else lo - abs(lo) * 1e-15), (hi if math.isinf(hi) else hi + abs(hi) * 1e-15)


def quartiles(df: DataFrame, only: Sequence[str] | None = None, at: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column_name, p25, p50, p75): discrete quartiles of numeric columns as text, each a value that occurs; NaN takes no part.

    The value of rank ceil(p * n) is found exactly: sketches give bounds that are sure to hold it, values below them are counted,
    and a bracket of more than ``INSIDE`` rows is narrowed by a sketch of its own values (each narrows it some 2,500 times, unless
    they are equal). What is left is grouped by value and ranked, so that the ranking is bounded; equal values are one row of it.
    """
    names = columns_of(df, *K.NUMERIC, only=only)
    kinds = {f.name: K.category(f.dataType) for f in df.schema.fields}
    value = {n: F.when(~F.isnan(_c(n)), _c(n)) if kinds[n] == K.FLOATING else _c(n) for n in names}
    edges = [x for p in at for x in (max(0.0, p - 2 / BRACKET), min(1.0, p + 2 / BRACKET))]
    kinds_of = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    df = spread(df)
    rows, spark = [], df.sparkSession
    for start in range(0, len(names), BLOCK):
        block = names[start : start + BLOCK]
        sketch = df.agg(*[F.percentile_approx(value[n].cast("double"), edges, BRACKET).alias(f"q{i}") for i, n in enumerate(block)], *[F.count(value[n]).alias(f"n{i}") for i, n in enumerate(block)]).first()
        cuts = {n: [_wider(lo, hi) for lo, hi in zip(sketch[f"q{i}"][::2], sketch[f"q{i}"][1::2], strict=True)] for i, n in enumerate(block) if sketch[f"n{i}"]}
        total = {n: sketch[f"n{i}"] for i, n in enumerate(block)}
        if cuts:
            number = {n: value[n].cast("double") for n in cuts}
            ranks = {(n, k): max(1, math.ceil(Fraction(str(p)) * total[n])) for n in cuts for k, p in enumerate(at)}
            while True:
                counts_of = df.agg(*[F.count(F.when(c, 1)).alias(f"{side}{block.index(n)}_{k}") for n in cuts for k, (lo, hi) in enumerate(cuts[n]) for side, c in (("b", number[n] < lo), ("i", number[n].between(lo, hi)))[: 1 + (total[n] > INSIDE)]]).first()
                below = {(n, k): counts_of[f"b{block.index(n)}_{k}"] for n, k in ranks}
                held = {(n, k): counts_of[f"i{block.index(n)}_{k}"] if total[n] > INSIDE else total[n] for n, k in ranks}
                wide = [(n, k) for n, k in ranks if held[n, k] > INSIDE and cuts[n][k][0] < cuts[n][k][1]]
                if not wide:
                    break
                shares = {x: (ranks[x] - below[x]) / held[x] for x in wide}
                again = df.agg(*[F.percentile_approx(F.when(number[n].between(*cuts[n][k]), number[n]), [max(0.0, shares[n, k] - 2 / BRACKET), min(1.0, shares[n, k] + 2 / BRACKET)], BRACKET).alias(f"q{j}") for j, (n, k) in enumerate(wide)]).first()
                before = {n: list(c) for n, c in cuts.items()}
                for j, (n, k) in enumerate(wide):
                    lo, hi = _wider(*again[f"q{j}"])
                    cuts[n][k] = max(lo, cuts[n][k][0]), min(hi, cuts[n][k][1])
                if before == cuts:
                    break
            needs = {x: ranks[x] - below[x] for x in ranks}
            for same in {kinds_of[n]: None for n in cuts}:  # one scan for all columns of a type
                of = [n for n in cuts if kinds_of[n] == same]
                inside = [F.when(value[n].cast("double").between(lo, hi), F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"), value[n].alias("v"))) for i, n in enumerate(of) for k, (lo, hi) in enumerate(cuts[n])]
                counts = df.select(F.explode(F.array_compact(F.array(*inside))).alias("x")).groupBy("x.i", "x.k", "x.v").agg(F.count(F.lit(1)).alias("c"))
                counts = counts.withColumn("reach", F.sum("c").over(Window.partitionBy("i", "k").orderBy("v")))
                need = F.element_at(F.array(*[F.lit(needs[n, k]) for n in of for k in range(len(at))]), F.col("i") * len(at) + F.col("k") + 1)
                found = counts.where(F.col("reach") >= need).groupBy("i", "k").agg(F.min("v").alias("v"))
                rows.append(found.select(F.element_at(F.array(*map(F.lit, of)), F.col("i") + 1).alias("column_name"), "k", number_text(F.col("v"), kinds[of[0]]).alias("v")))
    empty = spark.createDataFrame([(n,) for n in names], "column_name string")
    places = [f"p{round(100 * p)}" for p in at]
    if not rows:
        return empty.select("column_name", *[F.lit(None).cast("string").alias(p) for p in places])
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    out = out.groupBy("column_name").agg(*[F.max(F.when(F.col("k") == k, F.col("v"))).alias(p) for k, p in enumerate(places)])
    return empty.join(F.broadcast(out), "column_name", "left")  # a row per column


def text(df: DataFrame) -> DataFrame:
    """Lengths, lexicographic bounds and counts of empty, blank, untrimmed, sentinel and all-capital values."""
    return _long(df, columns_of(df, K.TEXT), {
        "min_length": lambda n: F.min(F.length(_c(n))), "max_length": lambda n: F.max(F.length(_c(n))),
        "min_value": lambda n: F.min(_c(n)), "max_value": lambda n: F.max(_c(n)), "empty": lambda n: _sum(F.length(_c(n)) == 0),
        "only_spaces": lambda n: _sum((F.length(_c(n)) > 0) & (F.length(F.trim(_c(n))) == 0)), "edge_spaces": lambda n: _sum(_c(n) != F.trim(_c(n))),
        "sentinels": lambda n: _sum(F.trim(_c(n)).isin(SENTINEL_TEXTS)), "all_capital": lambda n: _sum((_c(n) == F.upper(_c(n))) & (F.length(F.trim(_c(n))) > 0)),
    })


def text_forensics(df: DataFrame) -> DataFrame:
    """How many values of each text column look like integers, numbers, dates, coded numbers, e-mails and so on."""
    return _long(spread(df), columns_of(df, K.TEXT), {k: (lambda n, p=p: _sum(_c(n).rlike(p))) for k, p in FORENSICS.items()})


def dates(df: DataFrame, reference_date: str) -> DataFrame:
    """Bounds, distinct days, days after the reference date, before 1900, and sentinel dates of date and time columns."""
    day = lambda n: _c(n).cast("date")
    return _long(df, columns_of(df, K.DATE, K.TIMESTAMP), {
        "minimum": lambda n: F.date_format(F.min(_c(n)), "yyyy-MM-dd HH:mm:ss"), "maximum": lambda n: F.date_format(F.max(_c(n)), "yyyy-MM-dd HH:mm:ss"),
        "n_days": lambda n: F.countDistinct(day(n)), "future": lambda n: _sum(day(n) > F.lit(reference_date).cast("date")),
        "before_1900": lambda n: _sum(day(n) < F.lit("1900-01-01").cast("date")), "sentinels": lambda n: _sum(F.date_format(day(n), "yyyy-MM-dd").isin(SENTINEL_DATES)),
    })


def booleans(df: DataFrame) -> DataFrame:
    return _long(df, columns_of(df, K.BOOL), {"n_true": lambda n: _sum(_c(n)), "n_false": lambda n: _sum(~_c(n))})


def binaries(df: DataFrame) -> DataFrame:
    return _long(df, columns_of(df, K.BINARY), {"min_bytes": lambda n: F.min(F.octet_length(_c(n))), "max_bytes": lambda n: F.max(F.octet_length(_c(n)))})


def bounds(df: DataFrame) -> DataFrame:
    """(column_name, low, high): canonical bounds of every orderable column, as text."""
    names = [f.name for f in df.schema.fields if K.category(f.dataType) not in (K.NESTED, K.BINARY, K.VOID)]
    return _long(df, names, {"low": lambda n: F.min(_c(n)).cast("string"), "high": lambda n: F.max(_c(n)).cast("string")})


def derived(df: DataFrame) -> DataFrame:
    """(column_name, n_distinct, pct_distinct, is_constant, candidate_key) per column with distinct counts."""
    out = nulls(df).join(distincts(df), "column_name").join(bounds(df), "column_name")
    constant = F.when(F.col("low").isNotNull(), F.col("low") == F.col("high")).otherwise(F.col("n_distinct") == 1)
    key = (F.col("non_null") == F.col("n_rows")) & (F.col("n_rows") > 0) & (F.col("n_distinct") == F.col("n_rows"))
    pct = F.when(F.col("non_null") > 0, F.round(100.0 * F.col("n_distinct") / F.col("non_null"), 4))
    return out.select("column_name", "n_distinct", pct.alias("pct_distinct"), constant.alias("is_constant"), key.alias("candidate_key"))


def semantic_types(df: DataFrame) -> DataFrame:
    """(column_name, effective_nulls, semantic_type) of text columns."""
    out = nulls(df).join(text(df), "column_name").join(text_forensics(df), "column_name")
    some, nn = F.col("non_null") > 0, F.col("non_null")
    kind = (
        F.when(some & (F.col("integer_text") == nn) & (F.col("leading_zero") == 0), "NUMBER_AS_TEXT")
        .when(some & (F.col("leading_zero") > 0.9 * nn), "CODE_WITH_LEADING_ZEROS")
        .when(some & (F.col("date_text") == nn), "DATE_AS_TEXT")
        .when(some & (F.col("email") == nn), "EMAIL")
        .otherwise("TEXT")
    )
    return out.select("column_name", (F.col("nulls") + F.col("empty") + F.col("only_spaces")).alias("effective_nulls"), kind.alias("semantic_type"))


def frequent_values(df: DataFrame, columns: Sequence[str] | None = None, top: int = 5, max_distinct: int = 1000, max_columns: int = 25) -> DataFrame:
    """(column_name, place, value, frequency, pct): the most frequent values of columns with few distinct ones.

    Columns with the fewest distinct values come first, up to ``max_columns``; order by frequency, then value, nulls first.
    All columns are counted in one aggregation over (column, value) pairs.
    """
    names = list(columns) if columns else [f.name for f in df.schema.fields if K.category(f.dataType) not in (K.NESTED, K.BINARY, K.VOID)]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), _value(df, n).cast("string").alias("value")) for n in names]))
    counts = dealt(df).select(pairs.alias("p")).select("p.*").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("frequency"))
    sizes = counts.groupBy("column_name").agg(F.count("value").alias("n_distinct"), F.sum("frequency").alias("n_rows")).where(F.col("n_distinct").between(0, max_distinct))
    sizes = sizes.orderBy("n_distinct", "column_name").limit(max_columns)
    few = counts.join(F.broadcast(sizes), "column_name")  # a row per column, max_columns at most
    order = Window.partitionBy("column_name").orderBy(F.desc("frequency"), F.col("value").asc_nulls_first())
    ranked = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    return ranked.select("column_name", "place", "value", "frequency", F.round(100.0 * F.col("frequency") / F.col("n_rows"), 4).alias("pct"))
