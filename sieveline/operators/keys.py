"""Keys between two sides: uniqueness, coverage and discovery."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations
from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions import types as K
from sieveline.operators.profile import distincts

#: Words of a column's name that make it likely to be a key, in English and Spanish.
KEY_WORDS = ("id", "key", "code", "cod", "codigo", "number", "num", "numero", "no", "document", "documento", "uuid")

#: Exact tests of combinations that the sketches don't refute, in all.
TESTS = 20
NOT_KEYS = (K.FLOATING, K.DECIMAL, K.TIMESTAMP, K.NESTED, K.BINARY, K.VOID)


def likely_key(name: str, words: Sequence[str] = KEY_WORDS) -> bool:
    """Whether a column's name has one of the words, or one that ends in key, between underscores."""
    return any(part in words or part.endswith("key") for part in name.lower().split("_"))


def common_columns(source: DataFrame, target: DataFrame) -> list[str]:
    """Columns on both sides, in the source's order."""
    there = set(target.columns)
    return [c for c in source.columns if c in there]


def uniqueness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(n_rows, n_whole, n_distinct): all rows, those without a NULL in the columns, and their distinct tuples.

    Tuples are counted by one aggregation that combines map-side; a hot key is one row per task.
    """
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(f"`{c}`").isNotNull()
    per = df.groupBy(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)], whole.alias("whole")).agg(F.count(F.lit(1)).alias("c"))
    zero = lambda e: F.coalesce(e, F.lit(0)).cast("long")
    return per.agg(zero(F.sum("c")).alias("n_rows"), zero(F.sum(F.when(F.col("whole"), F.col("c")))).alias("n_whole"), F.count(F.when(F.col("whole"), 1)).alias("n_distinct"))


def is_unique(df: DataFrame, columns: Sequence[str]) -> bool:
    r = uniqueness(df, columns).first()
    return r["n_rows"] == r["n_whole"] == r["n_distinct"]


def coverage(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(n_pairs, n_keys): row pairs that join on the columns, and distinct keys on both sides.

    Both sides are counted per key before they meet, so a repeated key never multiplies rows.
    """
    cols = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)]
    names = [f"k{i}" for i in range(len(columns))]
    s = source.groupBy(*cols).agg(F.count(F.lit(1)).alias("cs")).dropna(subset=names)
    f = target.groupBy(*cols).agg(F.count(F.lit(1)).alias("cf")).dropna(subset=names)
    both = s.join(f, names)
    return both.agg(F.coalesce(F.sum(F.col("cs") * F.col("cf")), F.lit(0)).cast("long").alias("n_pairs"), F.count(F.lit(1)).alias("n_keys"))


def repeated_keys(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys (non-null or not) that occur more than once on either side, distinct."""
    def again(df: DataFrame) -> DataFrame:
        return df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")

    return again(source).union(again(target)).distinct()


#: Sketches of one pass, their relative deviation, and the share of distinct tuples below which a unique combination never falls.
SKETCHES, DEVIATION, SURELY_REPEATS = 60, 0.03, 0.8


def _plausible(df: DataFrame, combinations_: list[tuple[str, ...]], n: int) -> list[tuple[str, ...]]:
    """Combinations that may be unique: sketches of their tuples' digests, one pass that shuffles nothing but sketches, refute the others."""
    out = []
    for at in range(0, len(combinations_), SKETCHES):
        part = combinations_[at : at + SKETCHES]
        row = df.agg(*[F.approx_count_distinct(F.xxhash64(*[F.col(f"`{c}`") for c in x]), DEVIATION).alias(f"d{i}") for i, x in enumerate(part)]).first()
        out += [x for i, x in enumerate(part) if row[f"d{i}"] >= SURELY_REPEATS * n]
    return out


@dataclass
class Key:
    """A key, where it comes from, and what was noticed on the way."""

    columns: list[str] | None
    origin: str
    notes: list[str] = field(default_factory=list)


def discover(source: DataFrame, target: DataFrame, declared: Sequence[str] | None = None, max_columns: int = 3, words: Sequence[str] = KEY_WORDS) -> Key:
    """The key that pairs most rows: the declared one if it is unique on both sides, one column, two or three, or a column
    that is almost unique (95 % on both sides) and pairs more.

    A bounded number of passes: one profile per side, at most 6 coverage joins of one column, per size one pass of sketches
    over the combinations of the 10 most selective columns, an exact test of the first ``TESTS`` that the sketches don't refute,
    and 6 more joins for almost unique columns. ``words`` are those that make a column's name likely to be a key.
    """
    notes: list[str] = []
    columns = common_columns(source, target)
    if declared:
        missing = [c for c in declared if c not in columns]
        if missing:
            notes.append(f"declared key lacks {missing} on a side")
        elif is_unique(source, declared) and is_unique(target, declared):
            return Key(list(declared), "declared", notes)
        else:
            notes.append("declared key has nulls or repeats on a side")
    kinds = [{f.name: K.category(f.dataType) for f in side.schema.fields} for side in (source, target)]

    def profile(side: DataFrame) -> tuple[int, dict[str, tuple[int, int]]]:
        usable = [c for c in columns if all(k[c] not in (K.NESTED, K.BINARY, K.VOID) for k in kinds)]
        row = side.agg(F.count(F.lit(1)).alias("n"), *[F.count(f"`{c}`").alias(f"a{i}") for i, c in enumerate(usable)]).first()
        found = {r["column_name"]: r["n_distinct"] for r in distincts(side.select(*[f"`{c}`" for c in usable])).collect()} if usable else {}
        return row["n"], {c: (row[f"a{i}"], found[c]) for i, c in enumerate(usable)}

    (n_s, of_s), (n_f, of_f) = profile(source), profile(target)
    if not columns or not n_s or not n_f:
        return Key(None, "no_key", [*notes, "a side is empty"])
    usable = [c for c in columns if c in of_s and all(k[c] not in NOT_KEYS for k in kinds) and of_s[c][0] == n_s and of_f[c][0] == n_f]
    named = {c: likely_key(c, words) for c in usable}
    most = min(n_s, n_f)
    single = sorted((c for c in usable if of_s[c][1] == n_s and of_f[c][1] == n_f), key=lambda c: not named[c])[:6]
    best: tuple[int, float, int, list[str] | None] = (0, -1.0, 0, None)
    for c in single:
        found = (coverage(source, target, [c]).first()["n_pairs"], float(named[c]), -1, [c])
        best = found if best[3] is None or found[:2] > best[:2] else best
    if best[3] and best[0] == most:
        return Key(best[3], "one_column", notes)
    selective = sorted(usable, key=lambda c: (-min(of_s[c][1] / n_s, of_f[c][1] / n_f), not named[c]))[:10]
    tested = 0
    for size in range(2, max_columns + 1):
        some = [x for x in combinations(selective, size) if prod(min(of_s[c][1], of_f[c][1]) for c in x) >= max(n_s, n_f)]
        for found in _plausible(source, some, n_s):
            if tested >= TESTS or (best[3] and best[0] == most):
                break
            tested += 1
            if is_unique(source, found) and is_unique(target, found):
                held = (coverage(source, target, found).first()["n_pairs"], sum(named[c] for c in found) / size, -size, list(found))
                best = held if best[3] is None or held[:3] > best[:3] else best
        if best[3] and best[0] == most:
            break
    almost = [c for c in usable if of_s[c][1] >= 0.95 * n_s and of_f[c][1] >= 0.95 * n_f and [c] != best[3]]
    near = (0, None)
    for c in sorted(almost, key=lambda c: not named[c])[:6]:
        n = coverage(source, target, [c]).first()["n_keys"]
        near = (n, c) if n > near[0] else near
    if best[3] and best[0] >= near[0]:
        return Key(best[3], "one_column" if len(best[3]) == 1 else f"composite_{len(best[3])}", [*notes, f"the key pairs {best[0]} of {most} rows"])
    if near[1]:
        return Key([near[1]], "almost_unique", [*notes, f"{near[1]} pairs {near[0]} keys; rows of repeated keys are set aside"])
    return Key(None, "no_key", [*notes, f"no combination of up to {max_columns} columns is unique on both sides"])
