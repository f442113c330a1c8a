"""Differences between two sides: rows by key, cells by cause, multisets without a key.

Both sides meet in one aggregation by key, of counts and of 128-bit digests of the rows' canonical text alone: fixed-width values,
which are hashed and not sorted, and of which copies combine before the shuffle, so that a repeated key multiplies nothing. Which
keys are on one side, on both, changed or repeated is read from that frame; cells are fetched by key, for the rows that a result
shows. ``keep()`` computes the frame once for several results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions import canon
from sieveline.functions.patterns import as_time, pattern, seconds_between
from sieveline.operators.keys import common_columns

#: From so many columns on, a row's canonical text makes one generated method of more bytes than the JVM compiles (8,000): it would be
#: interpreted. Below this limit Spark cuts the work into methods that are compiled; the session keeps the setting.
WIDE, JIT_LIMIT = 40, 8000
#: Where a key's hash stands in a sieve: one of 2**19 rows, so that 25 MB are broadcast at most, and a bit in each of four words. Of other
#: keys' rows one in 1,700 passes at five million keys, a third at fifty million (computed).
_PLACE, _BITS = f"_hash & {2**19 - 1}", [f"cast(shiftrightunsigned(_hash, {19 + 6 * i}) & 63 as int)" for i in range(4)]


class Diff:
    """Lazy results of comparing ``source`` and ``target`` by ``key``; each is a DataFrame.

    A row with a NULL in its key is no other row's counterpart: such rows are set aside and counted by :meth:`null_keys`.
    """

    def __init__(self, source: DataFrame, target: DataFrame, key: Sequence[str], date_column: str | None = None) -> None:
        self.key, self.date_column = list(key), date_column
        self.columns = [c for c in common_columns(source, target) if c not in self.key]
        if len(self.columns) > WIDE:
            source.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_LIMIT)
        self.given = source, target
        self.source, self.target = (self._canonical(x) for x in self.given)
        self.frame = self._keyed()

    def _canonical(self, df: DataFrame) -> DataFrame:
        """Key and cells in canonical text, as k0.. and c0.."""
        kinds = {f.name: f.dataType for f in df.schema.fields}
        names = [*((c, f"k{i}") for i, c in enumerate(self.key)), *((c, f"c{i}") for i, c in enumerate(self.columns))]
        return df.select(*[canon.canonical(F.col(f"`{c}`"), kinds[c]).alias(to) for c, to in names])

    def _keyed(self) -> DataFrame:
        """(k0.., ns, nf, changed): a row per key with each side's count, and whether two rows that pair differ."""
        cells = [f"c{i}" for i in range(len(self.columns))]
        digests = [F.xxhash64(F.lit(1), *cells).alias("h"), F.xxhash64(F.lit(2), *reversed(cells), F.lit(3)).alias("g")]
        sides = [side.select(*self._keys(), F.lit(ns).alias("ns"), F.lit(nf).alias("nf"), *digests) for side, ns, nf in ((self.source, 1, 0), (self.target, 0, 1))]
        # Of two rows that pair, equal digests cancel out.
        both = sides[0].unionByName(sides[1]).where(self._whole()).groupBy(*self._keys()).agg(F.sum("ns").alias("ns"), F.sum("nf").alias("nf"), F.bit_xor("h").alias("h"), F.bit_xor("g").alias("g"))
        return both.select(*self._keys(), "ns", "nf", F.expr("ns = 1 and nf = 1 and (h <> 0 or g <> 0)").alias("changed"))

    def _whole(self) -> Column:
        """Whether no part of the key is NULL, in canonical text."""
        whole = F.lit(True)
        for k in self._keys():
            whole = whole & (F.col(k) != canon.NULL_TOKEN)
        return whole

    def null_keys(self) -> DataFrame:
        """(side, n_rows) of the rows whose key has a NULL, which nothing else here counts."""
        sides = [df.where(~self._whole()).agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("n_rows")) for side, df in (("source", self.source), ("target", self.target))]
        return sides[0].unionByName(sides[1])

    def _keys(self) -> list[str]:
        return [f"k{i}" for i in range(len(self.key))]

    def keep(self) -> Diff:
        """Compute the frame once for all results that follow; ``drop()`` frees it."""
        self.frame = self.frame.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def drop(self) -> None:
        self.frame.unpersist()

    def _at(self, condition: str) -> DataFrame:
        return self.frame.where(condition).select(*self._keys())

    def _named(self, prefix: str = "") -> list[Column]:
        return [F.col(f"c{i}").alias(f"{prefix}{c}") for i, c in enumerate(self.columns)]

    def _key(self) -> list[Column]:
        return [F.col(f"k{i}").alias(c) for i, c in enumerate(self.key)]

    def _rows(self, side: DataFrame, condition: str) -> DataFrame:
        return side.join(self._at(condition), self._keys(), "left_semi").select(*self._key(), *self._named())

    def _sieve(self, condition: str) -> DataFrame:
        """For the hash of each key where the condition holds a row by some of its bits, where others set one bit in each word."""
        keys = self._at(condition).select(F.xxhash64(*self._keys()).alias("_hash"))
        return keys.groupBy(F.expr(_PLACE).alias("_place")).agg(*[F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias(f"_word{i}") for i, bit in enumerate(_BITS)])

    def _sieved(self, given: DataFrame, sieve: DataFrame) -> DataFrame:
        """Canonical rows of the sieve's keys and, by chance, of few others, found without a shuffle: what an exact join then has to shuffle."""
        kinds = {f.name: f.dataType for f in given.schema.fields}
        hashed = given.withColumn("_hash", F.xxhash64(*[canon.canonical(F.col(f"`{c}`"), kinds[c]) for c in self.key]))
        hit = " and ".join([f"{_PLACE} = _place", *[f"getbit(_word{i}, {bit}) = 1" for i, bit in enumerate(_BITS)]])
        return self._canonical(hashed.join(F.broadcast(sieve), F.expr(hit), "left_semi"))

    def _pairs(self, condition: str, few: bool = False) -> DataFrame:
        """The key, s_<column> and f_<column> of keys that occur once on both sides; where they may be ``few``, other rows aren't shuffled."""
        sides = self.source, self.target
        if few:
            sieve = self._sieve(condition)
            sides = [self._sieved(x, sieve) for x in self.given]
        s = sides[0].join(self._at(condition), self._keys(), "left_semi").select(*self._keys(), *self._named("s_"))
        f = sides[1].select(*self._keys(), *self._named("f_"))
        return s.join(f, self._keys()).select(*self._key(), *[f"`s_{c}`" for c in self.columns], *[f"`f_{c}`" for c in self.columns])

    @property
    def joined(self) -> DataFrame:
        """The key, s_<column> and f_<column> of the keys that occur once on both sides."""
        return self._pairs("ns = 1 and nf = 1")

    def only_source(self) -> DataFrame:
        return self._rows(self.source, "ns = 1 and nf = 0")

    def only_target(self) -> DataFrame:
        return self._rows(self.target, "ns = 0 and nf = 1")

    def changed(self) -> DataFrame:
        """As :attr:`joined`, of the rows that differ."""
        return self._pairs("changed", few=True)

    @property
    def repeated(self) -> DataFrame:
        """Keys that occur more than once on a side."""
        return self.frame.where("ns > 1 or nf > 1").select(*self._key())

    def repeated_rows(self, side: str) -> DataFrame:
        return self._rows(self.source if side == "source" else self.target, "ns > 1 or nf > 1")

    def summary(self) -> DataFrame:
        """(only_source, only_target, common, changed, repeated_keys, repeated_source, repeated_target) in one row, by one pass."""
        count = lambda condition, what="1": F.coalesce(F.sum(F.when(F.expr(condition), F.expr(what))), F.lit(0)).cast("long")
        again = "ns > 1 or nf > 1"
        return self.frame.agg(
            count("ns = 1 and nf = 0").alias("only_source"), count("ns = 0 and nf = 1").alias("only_target"), count("ns = 1 and nf = 1").alias("common"), count("changed").alias("changed"),
            count(again).alias("repeated_keys"), count(again, "ns").alias("repeated_source"), count(again, "nf").alias("repeated_target"),
        )

    def classes(self) -> DataFrame:
        """(what, n_keys, n_source, n_target): keys and rows by repeated, only_source, only_target, changed, equal."""
        what = F.when(F.expr("ns > 1 or nf > 1"), "repeated").when(F.col("nf") == 0, "only_source").when(F.col("ns") == 0, "only_target").when(F.col("changed"), "changed").otherwise("equal")
        return self.frame.groupBy(what.alias("what")).agg(F.count(F.lit(1)).alias("n_keys"), F.sum("ns").alias("n_source"), F.sum("nf").alias("n_target"))

    def columns_summary(self) -> DataFrame:
        """(column_name, n_different): one sweep over the rows that differ."""
        sums = [F.count(F.when(F.col(f"s_{c}") != F.col(f"f_{c}"), 1)).alias(f"n{i}") for i, c in enumerate(self.columns)]
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_different")) for i, c in enumerate(self.columns)])
        return self.changed().agg(*sums).select(F.explode(rows).alias("x")).select("x.*")

    def cells(self) -> DataFrame:
        """(key..., column_name, source, target) of the cells that differ."""
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s_{c}").alias("source"), F.col(f"f_{c}").alias("target")) for c in self.columns])
        return self.changed().select(*[f"`{k}`" for k in self.key], F.explode(F.filter(cells, lambda x: x["source"] != x["target"])).alias("x")).select(*[f"`{k}`" for k in self.key], "x.*")

    def patterns(self) -> DataFrame:
        """(column_name, pattern, n)."""
        return self.cells().withColumn("pattern", pattern(F.col("source"), F.col("target"))).groupBy("column_name", "pattern").agg(F.count(F.lit(1)).alias("n"))

    def examples(self, column: str, n: int = 5) -> DataFrame:
        """The first ``n`` differing cells of a column, by key."""
        return self.cells().where(F.col("column_name") == column).orderBy(*self.key).limit(n)

    def numeric_ranges(self) -> DataFrame:
        """(column_name, min_abs, max_abs) of numeric differences."""
        cells = self.cells().withColumn("pattern", pattern(F.col("source"), F.col("target"))).where("pattern = 'numeric_difference'")
        gap = F.abs(F.col("source").try_cast("decimal(38,10)") - F.col("target").try_cast("decimal(38,10)"))
        return cells.groupBy("column_name").agg(F.min(gap).cast("decimal(38,10)").cast("string").alias("min_abs"), F.max(gap).cast("decimal(38,10)").cast("string").alias("max_abs"))

    def hour_offsets(self, top: int = 3) -> DataFrame:
        """(column_name, hours, n): the most frequent shifts of times, three per column."""
        from pyspark.sql import Window

        cells = self.cells().withColumn("pattern", pattern(F.col("source"), F.col("target"))).where("pattern = 'time_shift'")
        hours = seconds_between(as_time(F.col("source")), as_time(F.col("target"))) / 3600.0
        counts = cells.groupBy("column_name", hours.alias("hours")).agg(F.count(F.lit(1)).alias("n"))
        order = Window.partitionBy("column_name").orderBy(F.desc("n"), "hours")
        return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).drop("place")

    def column_shift(self, top: int = 3) -> DataFrame:
        """(column_name, source_column, n): target values that equal another source column of the same row."""
        from pyspark.sql import Window

        # Row by row: each differing cell is looked for among the row's source cells; the plan grows with the columns, not their pairs.
        cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"s_{c}").alias("s"), F.col(f"f_{c}").alias("f")) for i, c in enumerate(self.columns)])
        odd = F.filter("cells", lambda x: (x["s"] != x["f"]) & (x["f"] != F.lit(canon.NULL_TOKEN)) & (x["f"] != ""))
        same = lambda d: F.transform(F.filter("cells", lambda x: (x["s"] == d["f"]) & (x["i"] != d["i"])), lambda x: F.struct(d["i"].alias("to"), x["i"].alias("of")))
        names = F.array(*map(F.lit, self.columns))
        found = self.changed().select(cells.alias("cells")).select(F.explode(F.flatten(F.transform(odd, same))).alias("x")).groupBy("x.to", "x.of").agg(F.count(F.lit(1)).alias("n"))
        out = found.select(F.get(names, F.col("to")).alias("column_name"), F.get(names, F.col("of")).alias("source_column"), "n")
        order = Window.partitionBy("column_name").orderBy(F.desc("n"), "source_column")
        return out.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).drop("place")

    def by_month(self) -> DataFrame:
        """(month, only_source, only_target, changed) by the date column's month."""
        if not self.date_column:
            raise ValueError("no date column")
        month = lambda c: F.substring(F.nullif(F.col(c), F.lit(canon.NULL_TOKEN)), 1, 7).alias("month")
        parts = [(self.only_source(), self.date_column, "only_source"), (self.only_target(), self.date_column, "only_target"), (self.changed(), f"s_{self.date_column}", "changed")]
        rows = None
        for df, c, what in parts:
            part = df.select(month(c), F.lit(what).alias("what"))
            rows = part if rows is None else rows.unionByName(part)
        return rows.groupBy("month").agg(*[F.count(F.when(F.col("what") == w, 1)).alias(w) for _, _, w in parts])


def multiset(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of each side that the other lacks, with multiplicity, over the common columns."""
    columns = [f"`{c}`" for c in common_columns(source, target)]
    s, f = source.select(*columns), target.select(*columns)
    return s.exceptAll(f), f.exceptAll(s)


def distribution(source: DataFrame, target: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, n_source, n_target, delta): frequencies of a column's values per side where they differ.

    One aggregation over the tagged union of both sides, in place of a null-safe full outer join.
    """
    both = source.select(F.col(f"`{column}`").cast("string").alias("value"), F.lit(1).alias("s"), F.lit(0).alias("f")).unionByName(target.select(F.col(f"`{column}`").cast("string").alias("value"), F.lit(0).alias("s"), F.lit(1).alias("f")))
    out = both.groupBy("value").agg(F.sum("s").alias("n_source"), F.sum("f").alias("n_target"))
    out = out.withColumn("delta", F.col("n_target") - F.col("n_source")).where("delta <> 0")
    return out.orderBy(F.desc(F.abs("delta")), F.col("value").asc_nulls_first()).limit(top) if top else out
