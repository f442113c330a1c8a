"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy and applied where the texts lie.

A word's embedding is the sum of two rows of a hashed table: the whole word's and that of its first characters, so that inflected forms
of a word learn from each other. Filters of several widths slide over all words of a text, whatever its length; each keeps its
largest response, and a logistic layer makes a score of these. Filters are linear before their maximum, so applying a model needs
one sum of precomputed responses per word and filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import prepare, text_or_empty

#: What is stripped from both ends of a word.
EDGES = ".,;:!?\"'()[]{}<>|*#%&$-_…»«„“”‘’¡¿"
#: Zero words after each text: every filter then has a place in any text, also in an empty one.
PAD = 3
#: The score from which a text counts as toxic; the calibration moves the best cut to it.
CUT = 0.7
#: Steps of a logit's unit, and of a parameter's: sums of whole steps are the same in any order.
STEPS, FINE = 1 << 10, 1 << 32
#: Up to so many labelled ids are broadcast to the texts; more are joined by a shuffle.
BROADCAST = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Shape of the fit. All labelled rows are trained on, in parts of about ``rows`` rows and ``words`` words whose models meet in ``rounds``."""

    rows: int = 4000
    words: int = 2_000_000
    rounds: int = 6
    buckets: int = 1 << 16
    dim: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    prefix: int = 5
    steps: int = 600
    batch: int = 64
    dropout: float = 0.5
    seed: int = 7


@dataclass
class Model:
    settings: Settings
    table: np.ndarray
    taps: list[np.ndarray]  # per width: (width, dim, filters)
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str | None, float] = field(default_factory=dict)

    def responses(self, keys: np.ndarray) -> np.ndarray:
        """Per word the responses of all taps of all filters; ``keys`` are pairs of buckets."""
        x = self.table[keys[:, 0]] + self.table[keys[:, 1]]
        return np.hstack([x @ t[i] for t in self.taps for i in range(len(t))]).astype(np.float32)

    def pooled(self, responses: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Largest responses of all filters per text; ``ids`` are rows of ``responses``, texts end (with their padding) at ``ends``."""
        s, step = self.settings, 1 << 15
        out = np.full((len(ends), s.filters * len(s.widths)), -np.inf, np.float32)
        starts = np.concatenate([[0], ends[:-1]])
        for a in range(0, len(ids), step):
            b = min(a + step, len(ids))
            first, last = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
            cuts = np.maximum(starts[first:last], a) - a
            part = responses[ids[a : b + PAD]]
            at = 0
            for w, width in enumerate(s.widths):
                whole = part[: b - a, at : at + s.filters].copy()
                for i in range(1, width):
                    piece = part[i : i + b - a, at + i * s.filters : at + (i + 1) * s.filters]
                    whole[: len(piece)] += piece
                at += width * s.filters
                # Windows that begin in the last zero words would reach the next text; they count as zero words.
                ahead = ends[first:last] - a
                for back in range(1, PAD):
                    late = ahead - back
                    whole[late[(late >= 0) & (late < b - a)]] = 0.0
                span = slice(w * s.filters, (w + 1) * s.filters)
                out[first:last, span] = np.maximum(out[first:last, span], np.maximum.reduceat(whole, cuts, axis=0))
        return np.maximum(out + self.bias, 0.0)

    def logits(self, responses: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whole steps of 1 / ``STEPS``, so that counts by step tell all that a calibration needs."""
        return np.rint((self.pooled(responses, ids, ends).astype(np.float64) @ self.weights + self.offset) * STEPS) / STEPS

    def score(self, logits: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * (logits - self.shift) + math.log(CUT / (1 - CUT)), -500, 500)))


def buckets(word: bytes, settings: Settings) -> tuple[int, int]:
    """The two rows of a word in the embedding table; row 0 is kept for zero words."""
    text = word.decode("utf-8", "replace").lower().strip(EDGES)
    if not text:
        return 0, 0
    n = settings.buckets - 1
    return 1 + xxhash.xxh3_64_intdigest(text.encode(), 1) % n, 1 + xxhash.xxh3_64_intdigest(text[: settings.prefix].encode(), 2) % n


class Keys(dict):
    """Numbers of words, and their bucket pairs by number; forgets all when full."""

    def __init__(self, settings: Settings, limit: int = 200_000) -> None:
        super().__init__()
        self.settings, self.limit = settings, limit
        self.pairs: list[tuple[int, int]] = [(0, 0)]

    def __missing__(self, word: bytes) -> int:
        at = len(self.pairs)
        self.pairs.append(buckets(word, self.settings))
        self[word] = at
        return at

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words and zero words, ends of the texts)."""
        if len(self) > self.limit:
            self.clear()
            del self.pairs[1:]
        parts, ends, at = [], [], 0
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").split()
            parts.append(np.fromiter(map(self.__getitem__, words), np.int32, count=len(words)))
            parts.append(np.zeros(PAD, np.int32))
            at += len(words) + PAD
            ends.append(at)
        return np.concatenate(parts) if parts else np.empty(0, np.int32), np.array(ends, np.int64)


def fresh(settings: Settings) -> np.ndarray:
    """The state of a training before its first step: parameters in rows of ``dim``, the embedding table first, then Adagrad's sums beside them."""
    s, rng = settings, np.random.default_rng(settings.seed)
    n_filters = s.filters * len(s.widths)
    table = rng.normal(0, 0.02, (s.buckets, s.dim))
    table[0] = 0.0
    taps = [rng.normal(0, 1 / math.sqrt(s.dim * w), (w, s.dim, s.filters)) for w in s.widths]
    dense = np.concatenate([*[t.ravel() for t in taps], np.full(n_filters, 0.02), rng.normal(0, 0.3, n_filters), np.zeros(1)])
    dense = np.pad(dense, (0, -len(dense) % s.dim)).reshape(-1, s.dim)
    values = np.vstack([table, dense])
    return np.hstack([values, np.zeros_like(values)])


def _views(values: np.ndarray, settings: Settings) -> list[np.ndarray]:
    """The table, the taps of each width, bias, weights and offset in a state's contiguous half; writing to them writes there."""
    s, n_filters = settings, settings.filters * len(settings.widths)
    out, at, flat = [values[: s.buckets]], 0, values[s.buckets :].reshape(-1)
    for shape in (*[(w, s.dim, s.filters) for w in s.widths], (n_filters,), (n_filters,), (1,)):
        size = math.prod(shape)
        out.append(flat[at : at + size].reshape(shape))
        at += size
    return out


def model_of(state: np.ndarray, settings: Settings) -> Model:
    table, *taps, bias, weights, offset = _views(np.ascontiguousarray(state[:, : settings.dim]), settings)
    return Model(settings, table.astype(np.float32), [t.astype(np.float32) for t in taps], bias.astype(np.float32), weights.copy(), float(offset[0]))


def _strongest(keys: np.ndarray, sizes: np.ndarray, table: np.ndarray, taps: list[np.ndarray], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(largest response, its place) per text and filter; a text of any length is gone through in stretches."""
    s, step = settings, 1 << 15
    pooled = np.full((len(sizes), s.filters * len(s.widths)), -np.inf)
    places = np.zeros(pooled.shape, np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    spans = [(d, a, min(a + step, b + n - PAD + 1)) for d, (b, n) in enumerate(zip(begin.tolist(), sizes.tolist(), strict=True)) for a in range(b, b + n - PAD + 1, step)]
    at = 0
    while at < len(spans):
        first, stop = spans[at][1], at + 1
        while stop < len(spans) and spans[stop][2] - first <= step:
            stop += 1
        near = keys[first : spans[stop - 1][2] + PAD - 1]
        x = table[near[:, 0]] + table[near[:, 1]]
        for w, width in enumerate(s.widths):
            whole = x @ taps[w][0]
            for i in range(1, width):
                whole[:-i] += (x @ taps[w][i])[i:]
            span = slice(w * s.filters, (w + 1) * s.filters)
            for d, a, b in spans[at:stop]:
                part = whole[a - first : b - first]
                best = part.argmax(axis=0)
                top = part[best, np.arange(s.filters)]
                more = top > pooled[d, span]
                pooled[d, span] = np.where(more, top, pooled[d, span])
                places[d, span] = np.where(more, a + best, places[d, span])
        at = stop
    return pooled, places


def train_round(state: np.ndarray, texts: list[np.ndarray], labels: np.ndarray, settings: Settings, number: int = 0, part: int = 0) -> np.ndarray:
    """The state after one of ``rounds`` rounds over texts told as bucket pairs of their words; over all rounds each text is met at least once."""
    s, rng = settings, np.random.default_rng([settings.seed, part, number])
    n_filters, half = s.filters * len(s.widths), s.batch // 2
    value, seen = np.ascontiguousarray(state[:, : s.dim]), np.ascontiguousarray(state[:, s.dim :])
    (table, *taps, bias, weights, offset), sums = _views(value, s), _views(seen, s)
    groups = [g for g in (np.flatnonzero(labels == v) for v in (0, 1)) if len(g)]
    steps = -(-max(s.steps, *[-(-len(g) // half) for g in groups]) // s.rounds)

    def update(i: int, p: np.ndarray, grad: np.ndarray, rate: float, rows: np.ndarray | None = None) -> None:
        """Adagrad."""
        if rows is None:
            sums[i] += grad**2
            p -= rate * grad / (np.sqrt(sums[i]) + 1e-6)
        else:
            sums[i][rows] += grad**2
            p[rows] -= rate * grad / (np.sqrt(sums[i][rows]) + 1e-6)

    @lru_cache(maxsize=4)
    def order(g: int, turn: int) -> np.ndarray:
        return np.random.default_rng([s.seed, part, g, turn, 1]).permutation(groups[g])

    def draw(g: int, a: int) -> list[int]:
        """Texts of a label from place ``a`` on, in an order of its own each time that all have been met."""
        return [int(order(g, k // len(groups[g]))[k % len(groups[g])]) for k in range(a, a + half)]

    padding = np.zeros((PAD, 2), np.int64)
    for step in range(number * steps, (number + 1) * steps):
        rate = 0.1 * (1 - step / (s.rounds * steps)) + 0.005
        chosen = [i for g in range(len(groups)) for i in draw(g, step * half)]
        y = labels[chosen].astype(float)
        # Each time other words are left out, so that a text isn't told by one of its words alone.
        docs = [np.vstack([texts[i][rng.random(len(texts[i])) >= s.dropout], padding]) for i in chosen]
        keys = np.vstack(docs)
        pooled, places = _strongest(keys, np.array([len(d) for d in docs]), table, taps, s)
        active = pooled + bias > 0
        hidden = np.where(active, pooled + bias, 0.0)
        z = hidden @ weights + offset[0]
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(docs)
        back = np.where(active, error[:, None] * weights, 0.0)
        rows_all, grad_all = [], []
        for w, width in enumerate(s.widths):
            span = slice(w * s.filters, (w + 1) * s.filters)
            g, at = back[:, span], places[:, span]
            grad_taps = np.empty_like(taps[w])
            for i in range(width):
                grad_taps[i] = np.einsum("df,dfe->ef", g, table[keys[at + i, 0]] + table[keys[at + i, 1]])
                grad_x = g[:, :, None] * taps[w][i].T[None]
                for side in (0, 1):
                    rows_all.append(keys[at + i, side].ravel())
                    grad_all.append(grad_x.reshape(-1, s.dim))
            update(1 + w, taps[w], grad_taps + 1e-5 * taps[w], rate / 4)
        rows, inverse = np.unique(np.concatenate(rows_all), return_inverse=True)
        grad = np.zeros((len(rows), s.dim))
        np.add.at(grad, inverse, np.concatenate(grad_all))
        keep = (rows > 0) & (np.abs(grad).max(axis=1) > 0)
        update(0, table, grad[keep], rate, rows[keep])
        update(-3, bias, back.sum(axis=0), rate / 4)
        update(-2, weights, hidden.T @ error + 1e-4 * weights, rate)
        update(-1, offset, np.array([error.sum()]), rate)
    return np.hstack([value, seen])


def train(texts: list[np.ndarray], labels: np.ndarray, settings: Settings) -> Model:
    """A model of texts that one part holds."""
    state = fresh(settings)
    for number in range(settings.rounds):
        state = train_round(state, texts, labels, settings, number)
    return model_of(state, settings)


def best_cut(values: np.ndarray, labels: np.ndarray, times: np.ndarray | None = None) -> float:
    """The threshold with the best F1, in the middle of the gap it lies in; ``times`` tells how often a value and label occur."""
    order = np.argsort(-values, kind="stable")
    v, y, n = values[order], labels[order], np.ones(len(values), np.int64) if times is None else times[order]
    hits = np.cumsum(y * n)
    f1 = 2 * hits / (np.cumsum(n) + hits[-1])
    f1[:-1][v[:-1] == v[1:]] = -1
    at = int(f1.argmax())
    return (v[at] + v[at + 1]) / 2 if at + 1 < len(v) else v[at] - 1e-6


def calibrate(model: Model, logits: np.ndarray, labels: np.ndarray, langs: list[str | None], times: np.ndarray | None = None) -> None:
    """The best cut over all languages becomes the score 0.7; each language with 20 texts of either label gets its own threshold."""
    if labels.min() == labels.max():
        return
    n = np.ones(len(labels), np.int64) if times is None else times
    model.shift = best_cut(logits, labels, n)
    for _ in range(50):  # the slope by Newton's method on the logistic loss, with a prior that keeps it finite
        z = np.clip(model.slope * (logits - model.shift), -50, 50)
        p = 1 / (1 + np.exp(-z))
        d = logits - model.shift
        model.slope = float(np.clip(model.slope - ((n * (p - labels) * d).sum() + 0.1 * model.slope) / ((n * p * (1 - p) * d * d).sum() + 0.1), 0.05, 50))
    scores = model.score(logits)
    by: dict[str, list[int]] = {}
    for i, lang in enumerate(langs):
        if lang is not None:
            by.setdefault(lang, []).append(i)
    for lang, mine in sorted(by.items()):
        if min(n[mine][labels[mine] == v].sum() for v in (0, 1)) >= 20:
            model.thresholds[lang] = float(best_cut(scores[mine], labels[mine], n[mine]))


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | float:
    """The model of all labelled rows, or the share of toxic rows (1/2 without any) where a label is missing.

    Rows are dealt to parts by hash; in each round every part trains on from the common state, and the parts' changes are averaged by
    Spark, each row of the table over the parts that changed it. Rows of a label too rare for all parts go to several. A fifth of the
    rows set the thresholds, from counts by language, label and logit, and train nothing; where these have fewer than 20 of a label,
    all rows do both. Only rows whose crc32(doc_id) mod 3 is not 1 are read.
    """
    s, spark = settings, documents.sparkSession
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    found = dict(known.groupBy("label").count().collect())
    counts = [found.get(v, 0) for v in (0, 1)]
    if not all(counts):
        return (counts[1] + 1) / (sum(counts) + 2)
    kind = np.dtype("<u2" if s.buckets <= 1 << 16 else "<u4")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Keys(s)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                ids, ends = keys.of(rows.column("text").to_pylist())
                pairs, starts = np.array(keys.pairs, kind), np.concatenate([[0], ends[:-1]])
                told = [pairs[ids[a : b - PAD]].tobytes() for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_pydict({n: rows.column(n) for n in ("doc_id", "lang", "label")} | {"words": pa.array(told, pa.binary())})

    # A doc_id that several texts have counts once, by its least text.
    texts = documents.select("doc_id", text_or_empty().alias("text"), F.col("lang").cast("string").alias("lang")).join(F.broadcast(known) if sum(counts) <= BROADCAST else known, "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("lang").alias("lang"), F.first("label").alias("label"))
    words = texts.mapInArrow(read, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, lang string, label int, words binary")
    fifth = F.pmod(F.xxhash64(F.lit("aside"), "doc_id"), F.lit(5)) == 0
    words = words.withColumn("aside", fifth).persist(StorageLevel.DISK_ONLY)
    dealt = None
    try:
        sizes = {(r["label"], r["aside"]): (r["n"], r["size"]) for r in words.groupBy("label", "aside").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("words")).alias("size")).collect()}
        some = min(sizes.get((v, True), (0, 0))[0] for v in (0, 1)) >= 20 and all((v, False) in sizes for v in (0, 1))
        met = [[sizes.get((v, a), (0, 0)) for a in (False, True)[: 1 if some else 2]] for v in (0, 1)]
        rows = [sum(n for n, _ in of) for of in met]
        if not all(rows):
            return (counts[1] + 1) / (sum(counts) + 2)
        parts = max(-(-sum(rows) // s.rows), -(-sum(size for of in met for _, size in of) // (2 * kind.itemsize * s.words)))
        often = [min(parts, -(-parts * s.batch // 2 // n)) for n in rows]
        place = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(parts))
        copies = F.explode(F.sequence(F.lit(0), F.when(F.col("label") == 1, often[1] - 1).otherwise(often[0] - 1))).alias("copy")
        dealt = words.where(~F.col("aside")) if some else words
        dealt = dealt.select(F.xxhash64("doc_id").alias("place"), "label", "words", place.alias("first"), copies).select(F.pmod(F.col("first") + F.col("copy"), F.lit(parts)).cast("int").alias("part"), "place", "label", "words")
        dealt = dealt.repartition(parts, "part").persist(StorageLevel.DISK_ONLY)
        state = fresh(s)
        for number in range(s.rounds):
            state = _round(dealt, state, s, number, kind)
        model = model_of(state, s)
        _thresholds(words.where("aside") if some else words, model, kind)
        return model
    finally:
        words.unpersist()
        if dealt is not None:
            dealt.unpersist()


def _pairs(words: bytes, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(words, kind).reshape(-1, 2)


def _round(dealt: DataFrame, state: np.ndarray, settings: Settings, number: int, kind: np.dtype) -> np.ndarray:
    """The state after a round in all parts: changes in whole steps, summed exactly, so that their order moves nothing."""
    shared, names = dealt.sparkSession.sparkContext.broadcast(state), [f"v{i}" for i in range(state.shape[1])]

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by([("place", "ascending"), ("words", "ascending")]) if group.num_rows else group
        labels = group.column("label").to_numpy()
        texts = [_pairs(w, kind) for w in group.column("words").to_pylist()]
        change = np.rint((train_round(shared.value, texts, labels, settings, number, group.column("part")[0].as_py()) - shared.value) * FINE).astype(np.int64)
        rows = np.flatnonzero((change != 0).any(axis=1))
        return pa.table({"row": pa.array(rows.astype(np.int32))} | {n: pa.array(change[rows, i]) for i, n in enumerate(names)})

    changes = dealt.groupBy("part").applyInArrow(learn, "row int, " + ", ".join(f"{n} long" for n in names))
    found = changes.groupBy("row").agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names]).toArrow()
    out = state.copy()
    rows, n = found.column("row").to_numpy(), found.column("n").to_numpy()
    out[rows] += np.column_stack([found.column(c).to_numpy() for c in names]) / n[:, None] / FINE
    shared.unpersist()
    return out


def _thresholds(words: DataFrame, model: Model, kind: np.dtype) -> None:
    """Calibrates by all given rows, of which the driver sees counts by language, label and step of the logit."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        padding = np.zeros((PAD, 2), np.int64)
        for batch in batches:
            steps = []
            for w in batch.column("words"):
                pairs = np.vstack([_pairs(w.as_py(), kind), padding])
                ids, inverse = np.unique(pairs, axis=0, return_inverse=True)
                steps.append(round(float(shared.value.logits(shared.value.responses(ids), inverse.ravel(), np.array([len(pairs)]))[0]) * STEPS))
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "label": batch.column("label"), "step": pa.array(steps, pa.int64())})

    found = words.mapInArrow(tell, "lang string, label int, step long").groupBy("lang", "label", "step").count().orderBy("lang", "label", "step").toArrow().to_pydict()
    shared.unpersist()
    calibrate(model, np.array(found["step"]) / STEPS, np.array(found["label"]), found["lang"], np.array(found["count"]))


def held_out():
    """Rows that train nothing: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def toxicity(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A toxicity score of every document of columns doc_id, text, lang, learnt from ``labels`` (doc_id, toxic 0/1).

    Returns doc_id, held_out, score, predicted (1 if score >= 0.7), threshold, flagged. The score comes from the text alone. ``threshold`` is
    that of the document's language, from the calibration rows (0.7 for languages with few of them), and ``flagged`` whether the
    score reaches it.

    One pass over whole texts, without a shuffle; the model goes to the tasks (4 MB by default). Null and empty texts get the
    score of no words. A null doc_id is scored and never held out; of several labels of an id the larger counts, null labels are
    none. Without labelled rows of both kinds every score is the (smoothed) share of toxic ones. Repeated rows are scored each.
    """
    spark = prepare(documents.sparkSession)
    model = fit(documents, labels, settings)
    shared = spark.sparkContext.broadcast(model)
    given = documents.select("doc_id", text_or_empty().alias("text"), F.col("lang").cast("string").alias("lang"), held_out().alias("held_out"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        keys = Keys(settings)
        responses = np.empty((0, 0), np.float32)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs = batch.column("lang").to_pylist()
            scores = np.full(len(texts), model) if isinstance(model, float) else np.empty(len(texts))
            start = 0
            while start < len(texts) and not isinstance(model, float):
                stop, size = start + 1, len(texts[start])
                while stop < len(texts) and size + len(texts[stop]) < 1 << 21:
                    size += len(texts[stop])
                    stop += 1
                ids, ends = keys.of(texts[start:stop])
                if len(responses) > len(keys.pairs):
                    responses = responses[:0]
                if len(responses) < len(keys.pairs):
                    more = model.responses(np.array(keys.pairs[len(responses) :], np.int64))
                    responses = np.vstack([responses, more]) if len(responses) else more
                scores[start:stop] = model.score(model.logits(responses, ids, ends))
                start = stop
            thresholds = np.array([CUT if isinstance(model, float) else model.thresholds.get(v, CUT) for v in langs])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(scores, pa.float64()), "predicted": pa.array((scores >= CUT).astype(np.int32)),
                "threshold": pa.array(thresholds, pa.float64()), "flagged": pa.array(scores >= thresholds, pa.bool_()),
            })

    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int, threshold double, flagged boolean")
