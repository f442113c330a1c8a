"""Quality rules: base rules on each text, then robust multivariate outliers per language and source.

Base statistics come from whole texts. Their transformed vector (see :data:`STATISTICS`) is held against a minimum
covariance determinant estimate of its group (language, source): location and scatter of the share of rows (support)
whose scatter has the least determinant. It is sought from several starts (:data:`STARTS`): the plain mean and
covariance, the medians and median deviations, and correlations of squashed values and of directions from the median,
which outliers can't stretch. Concentration steps (from an estimate to the mean and scatter of the rows nearest to it) make
each start's determinant fall; after two of them the start with the least one goes on until it falls no more.

Each step is one aggregation over all rows: squared distances are counted in fixed logarithmic bins, a bin carries
its rows' sums, and a group's bins up to the support, the last one in part, give the next estimate. So no group is ever
gathered in one task. Groups too small for an estimate of their own use that of their language, then that of all rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import WORDS, Scratch, prepare, windows_hash

MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8

_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"
_LINE_WORD = re.compile(r"[^ \t-\r]")

#: The transformed statistics and, for each, the spread below which a difference never counts as unusual.
STATISTICS = {"log_words": 0.5, "word_length": 0.5, "symbol_rate": 0.1, "dup_line_rate": 0.05, "repeat_rate": 0.05}
#: Words of a neutral text that are added to each text's counts, so that short texts' rates are not taken as extreme.
PRIOR_WORDS, PRIOR_WORD_LENGTH = 50.0, 5.0


@dataclass(frozen=True)
class MCD:
    """Parameters of the outlier rule."""

    #: Share of a group's rows that the estimate rests on: what exceeds it may be outliers, however far and close together.
    support: float = 0.75
    #: Concentration steps of every start; then of the best one, until its log determinant falls by less than ``settled``.
    trial: int = 2
    settled: float = 1e-3
    most_steps: int = 20
    #: Groups with fewer rows use a wider group's estimate.
    least_rows: int = 200
    #: Squared distance beyond which a row is rejected: passed once in 7 million rows of a normal distribution.
    cutoff: float = 40.0
    #: Bins for squared distances: this many per factor of two, from 2**-LOW to 2**HIGH.
    per_octave: int = 16


LOW, HIGH = 10, 30


def repeat_words(hashes: np.ndarray, n: int = REPEAT_WINDOW) -> int:
    """Words inside n-word windows that are found twice or more."""
    if len(hashes) <= n:
        return 0
    windows = windows_hash(hashes, n)
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(windows) + 1, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, np.int32)
    at = np.flatnonzero(twice)
    edge[at] += 1
    np.subtract.at(edge, at + n, 1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def text_statistics(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes are split at 0x20 and 0x09-0x0D, and nowhere else
    if not words:
        return 0, 0, sum(map(text.count, _SYMBOLS)), 0, 0
    chars = len(text) - sum(map(text.count, _SPACES))
    lines = [x for x in text.split("\n") if _LINE_WORD.search(x)] if "\n" in text else ()
    repeated = repeat_words(WORDS.of(words)) if len(words) > REPEAT_WINDOW else 0
    return len(words), chars, sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), repeated


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_statistics(df: DataFrame, *, text_col: str = "text", keys: list[str] | None = None) -> DataFrame:
    """Key columns, n_lines, the base statistics and base_failed, a row for each row of ``df``. Null text: no words."""
    prepare(df.sparkSession)
    keys = keys or ["doc_id", "lang", "source"]
    schema = ", ".join([*[f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys], "n_lines long", *[f"{c} long" for c in BASE]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(1 + t.count("\n"), *text_statistics(t)) for t in (x.as_py() or "" for x in batch.column(len(keys)))]
            found = np.array(rows, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *[pa.array(found[:, i]) for i in range(6)]], [*keys, "n_lines", *BASE])

    out = df.select(*keys, text_col).mapInArrow(run, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def vector() -> list[Column]:
    """The transformed statistics; symbol counts enter by their logarithm, as they have no upper bound."""
    weight = F.col("n_words") + F.lit(PRIOR_WORDS)
    return [
        F.log1p(F.col("n_words").cast("double")).alias("x0"),
        ((F.col("word_chars") + PRIOR_WORDS * PRIOR_WORD_LENGTH) / weight).alias("x1"),
        F.log1p(F.col("n_symbols") / weight).alias("x2"),
        (F.col("n_dup_lines") / (F.col("n_lines") + 10.0)).alias("x3"),
        (F.col("n_repeat_words") / weight).alias("x4"),
    ]


#: Groups up to this number are broadcast (a row of 21 numbers each); more are joined by a shuffle.
BROADCAST_GROUPS = 50_000

_P = len(STATISTICS)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_LEVELS = ["g2", "g1", "g0"]
_X = [f"x{i}" for i in range(_P)]


def _sent(model: DataFrame) -> DataFrame:
    """The model, broadcast where it is small: then rows of a hot source stay where they are."""
    return F.broadcast(model) if model.count() <= BROADCAST_GROUPS else model


def _sums() -> list[Column]:
    x = [F.col(f"x{i}") for i in range(_P)]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(_P)], *[F.sum(x[i] * x[j]).alias(f"q{i}{j}") for i, j in _PAIRS]]


def chi2_share(x: float, p: int) -> float:
    """P(chi-squared with p degrees of freedom <= x), by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half = p / 2, x / 2
    term = total = 1 / a
    for n in range(1, 10_000):
        term *= half / (a + n)
        total += term
        if term < total * 1e-15:
            break
    return min(1.0, total * math.exp(a * math.log(half) - half - math.lgamma(a)))


def consistency(support: float, p: int = _P) -> float:
    """What the scatter of the central ``support`` of a normal distribution has to be multiplied by."""
    if support >= 1:
        return 1.0
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_share(mid, p) < support else (low, mid)
    return support / chi2_share(low, p + 2)


def _row(level: int, g: str, start: int, rows: int, location: np.ndarray, scatter: np.ndarray) -> list:
    """A model's row: location, log determinant and upper triangle of the inverse; every spread has its floor."""
    scatter = scatter + np.diag(np.square(list(STATISTICS.values())))
    inverse = np.linalg.inv(scatter)
    return [level, g, start, rows, float(np.linalg.slogdet(scatter)[1]), *map(float, location), *[float(inverse[i, j]) for i, j in _PAIRS]]


_M, _W = [f"m{i}" for i in range(_P)], [f"w{i}{j}" for i, j in _PAIRS]
_MODEL = ", ".join(["level int", "g string", "start int", "rows long", "logdet double", *[f"{c} double" for c in _M + _W]])
_COLUMNS = [f.split()[0] for f in _MODEL.split(", ")]
#: Where the search starts: plain estimate; medians and deviations; the latter with correlations of squashed values, of directions.
STARTS = ("plain", "median", "squashed", "directions")
#: Histograms of the statistics: bins per floor of the spread up to the last even one, and per doubling beyond it.
PER_FLOOR, LAST_EVEN, PER_DOUBLING = 20, 20_000, 1_000


def _per_level(rows: DataFrame, columns: list) -> DataFrame:
    """(level, g, columns): every row under each of its three groups."""
    groups = F.array(*[F.struct(F.lit(k).alias("level"), F.col(g).alias("g")) for k, g in enumerate(_LEVELS)])
    return rows.select(F.explode(groups).alias("of"), *columns).select("of.level", "of.g", *[c for c in columns])


def _middles(rows: DataFrame) -> DataFrame:
    """(level, g, c0.., d0..): medians and median deviations per group, to within a bin: a twentieth of the floor, or of very large values a thousandth of a doubling."""
    width = [f / PER_FLOOR for f in STATISTICS.values()]
    beyond = lambda y: LAST_EVEN + F.floor(F.log2(y / LAST_EVEN) * PER_DOUBLING)
    bins = F.array(*[F.when(F.col(x) / w < LAST_EVEN, F.floor(F.col(x) / w)).otherwise(beyond(F.col(x) / w)).cast("int") for x, w in zip(_X, width, strict=True)])
    counts = rows.select(*_LEVELS, F.posexplode(bins).alias("stat", "bin")).groupBy(*_LEVELS, "stat", "bin").agg(F.count(F.lit(1)).alias("n"))
    counts = _per_level(counts, ["stat", "bin", "n"]).groupBy("level", "g", "stat", "bin").agg(F.sum("n").alias("n"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for i, w in enumerate(width):
            part = pdf[pdf["stat"] == i].sort_values("bin")
            middle, n = part["bin"].to_numpy() + 0.5, part["n"].to_numpy()
            at = np.where(middle < LAST_EVEN, middle, LAST_EVEN * 2.0 ** (np.maximum(middle - LAST_EVEN, 0) / PER_DOUBLING)) * w
            median = at[np.searchsorted(np.cumsum(n), n.sum() / 2)]
            away = np.abs(at - median)
            order = np.argsort(away, kind="stable")
            found.append((median, away[order][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)]))
        spread = [max(1.4826 * d, f) for (_, d), f in zip(found, STATISTICS.values(), strict=True)]
        return pd.DataFrame([[int(pdf["level"].iloc[0]), pdf["g"].iloc[0], *[m for m, _ in found], *spread]], columns=["level", "g", *_C, *_D])

    return counts.groupBy("level", "g").applyInPandas(one, ", ".join(["level int", "g string", *[f"{c} double" for c in _C + _D]]))


_C, _D = [f"c{i}" for i in range(_P)], [f"d{i}" for i in range(_P)]


def _starts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """A model for every group and start."""
    middles = scratch.table(_middles(rows), "middles", thin=True)
    z = [((F.col(x) - F.col(c)) / F.col(d)) for x, c, d in zip(_X, _C, _D, strict=True)]
    norm2 = F.greatest(sum(((v * v) for v in z[1:]), z[0] * z[0]), F.lit(1e-12))
    odd = [F.sum(F.tanh(z[i]) * F.tanh(z[j])).alias(f"t{i}{j}") for i, j in _PAIRS] + [F.sum(z[i] * z[j] / norm2).alias(f"u{i}{j}") for i, j in _PAIRS]
    sums = _per_level(rows, _X).join(_sent(middles), ["level", "g"]).groupBy("level", "g", *_C, *_D).agg(*_sums(), *odd)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in pdf.to_dict("records"):
            n, middle, spread = r["n"], np.array([r[c] for c in _C]), np.array([r[d] for d in _D])
            mean = np.array([r[f"s{i}"] for i in range(_P)]) / n

            def matrix(name: str, r: dict = r) -> np.ndarray:
                m = np.zeros((_P, _P))
                for i, j in _PAIRS:
                    m[i, j] = m[j, i] = r[f"{name}{i}{j}"] / r["n"]
                return m

            def with_spread(m: np.ndarray, spread: np.ndarray = spread) -> np.ndarray:
                size = np.sqrt(np.maximum(np.diag(m), 1e-9))
                return m / np.outer(size, size) * np.outer(spread, spread)

            found = [(mean, matrix("q") - np.outer(mean, mean)), (middle, np.diag(spread**2)), (middle, with_spread(matrix("t"))), (middle, with_spread(matrix("u")))]
            out += [_row(int(r["level"]), r["g"], k, int(n), m, c) for k, (m, c) in enumerate(found)]
        return pd.DataFrame(out, columns=_COLUMNS)

    return scratch.table(sums.groupBy("level", "g").applyInPandas(one, _MODEL), "starts", thin=True)


def _concentrated(rows: DataFrame, model: DataFrame, mcd: MCD) -> DataFrame:
    """One concentration step of every (level, g, start): the estimate of the rows nearest to the model."""
    models = model.groupBy("level", "g").agg(F.collect_list(F.struct("start", *_M, *_W)).alias("models"))
    each = _per_level(rows, _X).join(_sent(models), ["level", "g"]).select("level", "g", *_X, F.explode("models").alias("model")).select("level", "g", *_X, "model.*")
    d2 = _distance(F.col)
    at = F.when(d2 <= 2.0**-LOW, 0).otherwise(F.least(F.lit((LOW + HIGH) * mcd.per_octave), F.ceil((F.log2(d2) + LOW) * mcd.per_octave))).cast("int")
    sums = each.withColumn("bin", at).groupBy("level", "g", "start", "bin").agg(*_sums())
    factor, support = consistency(mcd.support), mcd.support

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        n = pdf["n"].to_numpy(float)
        wanted = support * n.sum()
        share = np.clip((wanted - (np.cumsum(n) - n)) / n, 0, 1)  # whole bins, the last one in part
        mean = np.array([(share * pdf[f"s{i}"].to_numpy()).sum() for i in range(_P)]) / wanted
        scatter = np.zeros((_P, _P))
        for i, j in _PAIRS:
            scatter[i, j] = scatter[j, i] = (share * pdf[f"q{i}{j}"].to_numpy()).sum() / wanted - mean[i] * mean[j]
        first = pdf.iloc[0]
        return pd.DataFrame([_row(int(first["level"]), first["g"], int(first["start"]), int(n.sum()), mean, scatter * factor)], columns=_COLUMNS)

    return sums.groupBy("level", "g", "start").applyInPandas(one, _MODEL)


def robust_model(stats: DataFrame, mcd: MCD, scratch: Scratch) -> DataFrame:
    """A model per group at three levels, (language, source), language, all rows, from (g2, g1, g0, x0..)."""
    model = _starts(stats, scratch)
    for step in range(mcd.trial):
        model = scratch.table(_concentrated(stats, model, mcd), f"trial{step}", thin=True)
    best = F.row_number().over(Window.partitionBy("level", "g").orderBy("logdet", "start"))
    model = scratch.table(model.withColumn("place", best).where("place = 1").select(*_COLUMNS), "step0", thin=True)
    for step in range(1, mcd.most_steps + 1):
        new = _concentrated(stats, model, mcd)
        old = model.select("level", "g", F.col("logdet").alias("before"))
        both = scratch.table(new.join(old, ["level", "g"]).withColumn("fell", F.col("before") - F.col("logdet")), f"step{step}-both", thin=True)
        lower = both.where("fell > 0").select(*_COLUMNS)
        model = scratch.table(lower.unionByName(model.join(lower.select("level", "g"), ["level", "g"], "left_anti")), f"step{step}", thin=True)
        if both.where(F.col("fell") >= mcd.settled).isEmpty():
            break
    return model


def _distance(col) -> Column:
    """Squared Mahalanobis distance of x0.. to the model's location."""
    diff = [col(f"x{i}") - col(f"m{i}") for i in range(_P)]
    out = F.lit(0.0)
    for i, j in _PAIRS:
        out = out + (1.0 if i == j else 2.0) * col(f"w{i}{j}") * diff[i] * diff[j]
    return F.greatest(out, F.lit(0.0))


def quality(df: DataFrame, mcd: MCD = MCD(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance2, kept; a row per row.

    Null, empty and blank texts have no words and fail. Null languages and sources are groups of their own. The
    estimate rests on the rows that pass the base rules; repeated rows count as often as they occur. Ties in distance
    share a bin and so enter together. An empty table gives an empty result. Other columns of ``df`` are not read.
    """
    verdicts = _verdicts(df, mcd, id_col, text_col)
    return verdicts.select(F.col("__id").alias(id_col), *BASE, "base_failed", "distance2", "kept")


def _keys(df: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """What tells rows apart as far as a verdict goes: id, language, source, and a hash of the text."""
    held = [F.col(f"`{c}`").cast("string") if c in df.columns else F.lit(None).cast("string") for c in ("lang", "source")]
    return [F.col(f"`{id_col}`").alias("__id"), held[0].alias("__lang"), held[1].alias("__source"), F.xxhash64(F.col(f"`{text_col}`")).alias("__hash")]


def _verdicts(df: DataFrame, mcd: MCD, id_col: str, text_col: str) -> DataFrame:
    scratch = Scratch(df.sparkSession, "quality")
    slim = df.select(*_keys(df, id_col, text_col), F.col(f"`{text_col}`").alias("text"))
    base = base_statistics(slim, keys=["__id", "__lang", "__source", "__hash"])
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null")) for c in ("__lang", "__source"))
    groups = {"g2": F.concat(lang, F.lit("\x1f"), source), "g1": lang, "g0": F.lit("all")}
    out = rows = scratch.table(base.select("*", *vector()).withColumns(groups), "statistics")
    model = robust_model(rows.where(~F.col("base_failed")).select(*_LEVELS, *_X), mcd, scratch)
    names = [*_M, *_W]
    for k, g in enumerate(_LEVELS):
        own = model.where(F.col("level") == k)
        if k < 2:
            own = own.where(F.col("rows") >= mcd.least_rows)
        out = out.join(_sent(own.select(F.col("g").alias(g), F.struct(*names).alias(f"model{k}"))), g, "left")
    best = F.coalesce(*[F.col(f"model{k}") for k in range(3)])
    out = out.withColumn("model", best).select("*", *[F.col(f"model.{c}").alias(c) for c in names])
    out = out.withColumn("distance2", F.when(~F.col("base_failed"), F.round(_distance(F.col), 6)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= mcd.cutoff))


def filtered(df: DataFrame, mcd: MCD = MCD(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns.

    Each row has a verdict of its own, also among rows that share an id, and rows with a null id; rows that agree in id,
    text, language and source agree in it.
    """
    kept = _verdicts(df, mcd, id_col, text_col).where("kept").select("__id", "__lang", "__source", "__hash")
    same = [mine.eqNullSafe(kept[name]) for mine, name in zip([df[f"`{id_col}`"], *[df[f"`{c}`"].cast("string") if c in df.columns else F.lit(None).cast("string") for c in ("lang", "source")], F.xxhash64(df[f"`{text_col}`"])], kept.columns, strict=True)]
    return df.join(kept, same[0] & same[1] & same[2] & same[3], "left_semi")
