"""Exact inner-product search by branch and bound in ball trees, one tree per shard.

Space is cut into cells by the top of a ball tree, fitted to a bounded sample of the vectors (``SAMPLE_ROWS``, and
``SAMPLE_VALUES`` numbers at most), each bounded by several balls; every row goes to a ball and its cell, and a cell with more than ``SHARD_ROWS`` rows is dealt to
several shards. Each shard's ball tree is built once and written. A node is a ball (centre, radius) over its rows; no
row in it scores more than q.centre + |q| * radius. Nodes are taken in order of that bound, and a node whose bound is
below a query's k-th score so far is passed over for this query.

A first round searches a shard of each query's own cell. The k-th score found there is shared with all other cells: those
alone of which a ball's bound reaches it are visited, best bound first. A second round takes the rest of the own cell and the
``NEXT`` best ones, which mostly raises the k-th score, and a third one what that score leaves of the others; each search starts from
the score so far. Queries travel in blocks of bounded size, so that a task holds one shard's tree and one block, and a shard
returns k rows a query at most.

Scores are exact integers. Where every partial sum stays below 2**52, 64-bit floats hold them; else floats only bound the
scores, and what the bounds leave is computed in whole numbers of any size.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import Scratch, integral

LEAF = 128
#: Rows of a shard, queries of a block, and queries that go down a tree together.
SHARD_ROWS, BLOCK, TOGETHER = 16_384, 16_384, 512
#: Cells of the top tree, rows and numbers of the sample that it is fitted to, and sampled rows a cell needs.
CELLS, SAMPLE_ROWS, SAMPLE_VALUES, CELL_SAMPLE = 1_024, 16_384, 8_000_000, 8
#: Balls that bound a cell's rows, and sampled rows a ball needs: a cell that holds parts of several clusters is not one wide ball.
BALLS, BALL_SAMPLE = 8, 4
#: Cells besides its own that a query visits before its k-th score is shared again.
NEXT = 8
#: Components are kept as whole numbers times 2**-UNIT, so that no finite one overflows.
UNIT = 16
#: Scores of this size and beyond don't fit a long's range here; their exact value travels beside the clamped one.
CLAMP = 2**63 - 1
_EPS = 2.0**-50


def quantised(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) * 2**-UNIT, exactly, for a power of two as the scale; a double of 2**53 or more is whole already."""
    with np.errstate(over="ignore"):
        small = np.abs(x) < 2.0**60
    return np.where(small, np.floor(np.where(small, x, 0.0) * scale) * 2.0**-UNIT, x * (scale * 2.0**-UNIT))


def whole(v: np.ndarray) -> list[int]:
    """The integers that :func:`quantised` stands for."""
    return [int(x * 2.0**UNIT) if abs(x) < 2.0**100 else int(x) << UNIT for x in v.tolist()]


def _exponent(v: np.ndarray) -> int:
    """The least e with all |v| < 2**e."""
    return int(np.frexp(np.abs(v).max())[1]) if v.size else 0


def wide_key(z: int) -> bytes:
    """Bytes that sort like the integers."""
    size = (abs(z).bit_length() + 7) // 8
    plain = size.to_bytes(4, "big") + abs(z).to_bytes(size, "big")
    return b"\x81" + plain if z >= 0 else b"\x80" + bytes(255 - x for x in plain)


def wide_value(key: bytes) -> int:
    plain = key[1:] if key[0] == 0x81 else bytes(255 - x for x in key[1:])
    return int.from_bytes(plain[4:], "big") * (1 if key[0] == 0x81 else -1)


def sortable(score: int) -> tuple[int, bytes]:
    """(minus the score within a long, the exact value's key where that was cut): the best score sorts first."""
    if abs(score) < CLAMP:
        return -score, b""
    return (-CLAMP if score > 0 else CLAMP), wide_key(-score)


def _scaled(x: int, exponent: int) -> float:
    """x * 2**-exponent, rounded down a little."""
    cut = max(0, x.bit_length() - 60)
    try:
        y = math.ldexp(float(x >> cut), cut - exponent)
    except OverflowError:
        return math.inf if x > 0 else -math.inf
    return y - abs(y) * 2.0**-48 - 1e-300


class BallTree:
    """Nodes in arrays; the rows of a leaf lie together, by id. Vectors are held times 2**-shift, so that all are below 1."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.shift = _exponent(vectors)
        vectors = np.ldexp(vectors, -self.shift)
        self.centre, self.radius, self.span, self.kids = [], [], [], []
        rows: list[np.ndarray] = []
        self._at = 0
        self._build(vectors, order, rows)
        kept = np.concatenate(rows) if rows else order
        self.vectors, self.ids = np.ascontiguousarray(vectors[kept]), ids[kept]
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)
        self.reach = np.sqrt((self.centre**2).sum(axis=1)) + self.radius

    def _build(self, vectors: np.ndarray, order: np.ndarray, rows: list[np.ndarray]) -> None:
        waiting = [(order, -1, 0)]
        while waiting:
            part, parent, side = waiting.pop()
            me = len(self.kids)
            if parent >= 0:
                self.kids[parent][side] = me
            points = vectors[part]
            centre = points.mean(axis=0)
            away = points - centre
            self.centre.append(centre)
            # the least bit more than the largest distance, so that rounding never makes a bound too low
            self.radius.append(float(np.sqrt(np.einsum("ij,ij->i", away, away).max())) * (1 + 1e-9) + 1e-12 * points.shape[1])
            if len(part) <= LEAF or self.radius[-1] < 1e-6:
                self.kids.append([-1, -1])
                self.span.append((self._at, self._at + len(part)))
                self._at += len(part)
                rows.append(part)
                continue
            self.kids.append([-1, -1])
            self.span.append((-1, -1))
            left = halves(points, away, len(part) // 2)
            waiting += [(part[left], me, 0), (part[~left], me, 1)]

    def search(self, queries: np.ndarray, own: np.ndarray, floor: list[int | None], k: int) -> Iterator[tuple[int, int, int]]:
        """(place of the query, id, score) of each query's k best, ties to smaller ids.

        ``floor``: scores that the k-th best is known to reach; rows below it may be left out.
        """
        if not len(self.ids):
            return
        tops = np.frexp(np.abs(queries).max(axis=1, initial=0))[1]
        exact = tops + self.shift + 2 * UNIT + queries.shape[1].bit_length() <= 52
        if exact.any():
            at = np.flatnonzero(exact)
            known = np.array([-np.inf if floor[i] is None else float(max(min(floor[i], 2**62), -(2**62))) for i in at])
            best, ids = self._floats(np.ldexp(queries[at], self.shift + 2 * UNIT), own[at], known, k)
            for i, j in zip(*np.nonzero(~np.isneginf(best)), strict=True):
                yield int(at[i]), int(ids[i, j]), int(best[i, j])
        for i in np.flatnonzero(~exact):
            for score, one in self._integers(queries[i], int(own[i]), floor[i], k):
                yield int(i), one, score

    def _floats(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """A block of queries together; scores are whole and exact."""
        n, size = queries.shape
        best = np.full((n, k), -np.inf)
        ids = np.full((n, k), np.iinfo(np.int64).max)
        least = floor.copy()
        norms = np.sqrt((queries**2).sum(axis=1))
        bounds = lambda node, who: queries[who] @ self.centre[node] + norms[who] * (self.radius[node] + size * _EPS * self.reach[node]) + 1e-6
        everyone = np.arange(n)
        first = bounds(0, everyone)
        heap = [(-float(first.max()), 0, 0, everyone, first)]
        tick = 0
        while heap:
            _, _, node, who, bound = heapq.heappop(heap)
            live = bound >= least[who]
            who, bound = who[live], bound[live]
            if not len(who):
                continue
            if self.kids[node][0] < 0:
                a, b = self.span[node]
                scores = queries[who] @ self.vectors[a:b].T
                scores[self.ids[a:b][None, :] == own[who][:, None]] = -np.inf
                self._merge(best, ids, least, who, scores, self.ids[a:b], k)
                continue
            for kid in self.kids[node]:
                bound = bounds(kid, who)
                live = bound >= least[who]
                if live.any():
                    tick += 1
                    heapq.heappush(heap, (-float(bound[live].max()), tick, kid, who[live], bound[live]))
        return best, ids

    @staticmethod
    def _merge(best: np.ndarray, ids: np.ndarray, least: np.ndarray, who: np.ndarray, scores: np.ndarray, names: np.ndarray, k: int) -> None:
        hit = scores.max(axis=1) >= least[who]
        if not hit.any():
            return
        who, scores = who[hit], scores[hit]
        top = np.argsort(-scores, axis=1, kind="stable")[:, :k]  # ties: smaller ids come first
        all_scores = np.hstack([best[who], np.take_along_axis(scores, top, 1)])
        all_ids = np.hstack([ids[who], names[top]])
        all_ids[np.isneginf(all_scores)] = np.iinfo(np.int64).max
        pick = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        best[who] = np.take_along_axis(all_scores, pick, 1)
        ids[who] = np.take_along_axis(all_ids, pick, 1)
        least[who] = np.maximum(least[who], best[who][:, k - 1])

    def _integers(self, query: np.ndarray, own: int, floor: int | None, k: int) -> list[tuple[int, int]]:
        """One query; floats bound the scores, and rows that the bounds leave are scored in whole numbers."""
        shift, exact = _exponent(query), whole(query)
        q, size, to = np.ldexp(query, -shift), len(query), shift + self.shift + 2 * UNIT
        norm = float(np.sqrt((q**2).sum()))
        slack = lambda reach: size * _EPS * norm * reach + 1e-290
        bound = lambda node: float(q @ self.centre[node]) + norm * self.radius[node] + slack(self.reach[node])
        least = -math.inf if floor is None else _scaled(floor, to)
        found: list[tuple[int, int]] = []
        heap = [(-bound(0), 0)]
        while heap and -heap[0][0] >= least:
            node = heapq.heappop(heap)[1]
            if self.kids[node][0] >= 0:
                for kid in self.kids[node]:
                    heapq.heappush(heap, (-bound(kid), kid))
                continue
            a, b = self.span[node]
            rows = self.vectors[a:b]
            most = rows @ q + slack(np.sqrt((rows**2).sum(axis=1)))
            for i in np.flatnonzero(most >= least) + a:
                if (one := int(self.ids[i])) != own and most[i - a] >= least:
                    score = sum(x * y for x, y in zip(exact, whole(np.ldexp(self.vectors[i], self.shift)), strict=True))
                    found = heapq.nsmallest(k, [*found, (-score, one)])
                    if len(found) == k:
                        least = max(least, _scaled(-found[-1][0], to))
        return [(-s, one) for s, one in found]


def halves(points: np.ndarray, away: np.ndarray, count: int) -> np.ndarray:
    """A mask of the ``count`` points that lie nearest to one end of the direction between two points far apart."""
    one = points[np.argmax(np.einsum("ij,ij->i", away, away))]
    other = points[np.argmax(((points - one) ** 2).sum(axis=1))]
    left = np.zeros(len(points), bool)
    left[np.argsort(points @ (other - one), kind="stable")[:count]] = True
    return left


class Cells:
    """The top of a ball tree over a sample: hyperplanes down to balls, numbered in the tree's order, and a centre for each.

    The ball with the largest sum of squared distances is split next, halfway between two points far apart, so that balls
    follow clusters whatever their sizes. ``cell`` puts balls that lie together in the tree into cells of like numbers of rows.
    """

    def __init__(self, sample: np.ndarray, cells: int, balls: int) -> None:
        normal, cut, kids, points = [None], [0.0], [None], [sample]  # by node; leaves have no kids
        open_nodes = [(-np.inf, 0)]
        leaves = 1
        while open_nodes and leaves < balls:
            me = heapq.heappop(open_nodes)[1]
            mine = points[me]
            if len(mine) < 2 * BALL_SAMPLE:
                continue
            away = mine - mine.mean(axis=0)
            with np.errstate(over="ignore", invalid="ignore"):
                one = mine[np.argmax(np.einsum("ij,ij->i", away, away))]
                other = mine[np.argmax(((mine - one) ** 2).sum(axis=1))]
                along, half = mine @ (other - one), float(((one + other) / 2) @ (other - one))
                left = along < half
            if not 0 < left.sum() < len(left):
                continue
            normal[me], cut[me], kids[me], points[me] = other - one, half, (len(kids), len(kids) + 1), None
            leaves += 1
            for part in (mine[left], mine[~left]):
                with np.errstate(over="ignore", invalid="ignore"):
                    spread = float(np.nan_to_num(((part - part.mean(axis=0)) ** 2).sum(), nan=np.inf))
                heapq.heappush(open_nodes, (-spread, len(kids)))
                normal.append(None), cut.append(0.0), kids.append(None), points.append(part)
        inner = [i for i, k in enumerate(kids) if k is not None]
        name, centres, sizes = {i: n for n, i in enumerate(inner)}, [], []
        waiting = [0]
        while waiting:
            me = waiting.pop()
            if kids[me] is not None:
                waiting += kids[me][::-1]
                continue
            name[me] = -1 - len(centres)
            centres.append(points[me].mean(axis=0) if len(points[me]) else np.zeros(sample.shape[1]))
            sizes.append(max(1, len(points[me])))
        self.centres, self.cut = np.array(centres), np.array([cut[i] for i in inner])
        self.kids = np.array([[name[k] for k in kids[i]] for i in inner], np.int64).reshape(-1, 2)
        self.normal = np.array([normal[i] for i in inner]).reshape(-1, sample.shape[1])
        middle = np.cumsum(sizes) - np.array(sizes) / 2
        self.cell = np.unique((middle * cells / sum(sizes)).astype(np.int64), return_inverse=True)[1].astype(np.int32)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Each vector's ball."""
        at = np.zeros(len(vectors), np.int64) if len(self.kids) else np.full(len(vectors), -1, np.int64)
        while (open_rows := np.flatnonzero(at >= 0)).size:
            node = at[open_rows]
            with np.errstate(over="ignore", invalid="ignore"):
                along = np.einsum("ij,ij->i", vectors[open_rows], self.normal[node])
            at[open_rows] = self.kids[node, (~(along < self.cut[node])).astype(int)]
        return -1 - at


_HITS = "query_id long, vec_id long, s long, wide binary"


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All components, and each row's number of them."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(float), sizes


def search(df: DataFrame, is_query, *, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products, ties to smaller ids.

    ``is_query`` is a condition on the rows of ``df``; ``scale`` is a power of two. Rows whose id is null, or whose vector is null or
    holds null or non-finite components, take no part. An inner product needs vectors of one length: a query meets the rows
    of its own length, and rows of no components score 0 with each other. A query's own rows (all rows with its id) are no
    candidates; a repeated query is searched once, with the least of its vectors (the shortest, then by components), and
    candidates that repeat count as often as they occur. Ranks follow the exact scores; a score beyond a long's range is
    returned as 2**63 - 1 or its negative. Extra columns are not read.
    """
    if scale & (scale - 1) or not 0 < scale <= 2**UNIT:
        raise ValueError("scale has to be a power of two, at most 65536")
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "topk")
    x = F.col("v")
    fine = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = integral(df, id_col).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    widths = rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "width").first()
    if widths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width, total = widths  # the most frequent length: its rows get cells, others are dealt to shards by their ids
    wanted = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // max(width, 1)))
    sample = rows.where(F.size("v") == width).where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(max(1, total // wanted))) == 0).limit(wanted).select("v")
    sample = [r["v"] for r in sample.collect()] or [[0.0] * width]
    wanted = max(1, min(CELLS, -(-total // SHARD_ROWS), len(sample) // CELL_SAMPLE))
    cells = Cells(quantised(np.array(sample, float).reshape(len(sample), width), scale), wanted, 1 if wanted == 1 else wanted * BALLS)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = 0
        for batch in batches:
            values, sizes = _vectors(batch.column(1))
            values = quantised(values, scale)
            ball, cell, away, own = np.full(len(sizes), -1, np.int32), np.full(len(sizes), -1, np.int32), np.full(len(sizes), np.inf), sizes == width
            if own.any() and width:
                mine = values[np.repeat(own, sizes)].reshape(-1, width)
                ball[own] = cells.of(mine)
                cell[own] = cells.cell[ball[own]]
                with np.errstate(over="ignore", invalid="ignore"):
                    away[own] = np.sqrt(((mine - cells.centres[ball[own]]) ** 2).sum(axis=1))
            v = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), v, batch.column(2), pa.array(sizes.astype(np.int32)), pa.array(cell), pa.array(ball), pa.array(np.nan_to_num(away, nan=np.inf)), pa.array(np.arange(read, read + len(sizes)))], ["id", "v", "asks", "width", "cell", "ball", "away", "place"])
            read += len(sizes)

    rows = scratch.table(rows.mapInArrow(assign, "id long, v array<double>, asks boolean, width int, cell int, ball int, away double, place long"), "rows")
    where = ["width", "cell", "sub"]
    balls = scratch.table(rows.groupBy("width", "cell", "ball").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")), "balls")
    radius = {r["ball"]: r["radius"] for r in balls.where("ball >= 0").select("ball", "radius").collect()}  # at most CELLS * BALLS rows
    shards = scratch.table(balls.groupBy("width", "cell").agg(F.ceil(F.sum("n") / SHARD_ROWS).cast("int").alias("subs")), "shards")
    # rows that share an id don't share a shard: places read deal them, and ids deal queries
    dealt = lambda *of: F.pmod(F.xxhash64(*of), F.col("subs")).cast("int")
    rows = rows.join(shards, ["width", "cell"]).withColumn("sub", dealt("id", "place"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = BallTree(np.array(pdf["v"].to_list(), float).reshape(len(pdf), -1), pdf["id"].to_numpy(np.int64))
        return pd.DataFrame({**{c: pdf[c].iloc[:1] for c in where}, "tree": [pickle.dumps(tree, protocol=5)]})

    trees = scratch.table(rows.select("id", "v", *where).groupBy(*where).applyInPandas(build, "width int, cell int, sub int, tree binary"), "trees")
    asked = rows.where("asks").groupBy("id").agg(F.min(F.struct("width", "v", "cell")).alias("q")).select("id", "q.v", "q.width", "q.cell")
    queries = scratch.table(asked.join(shards, ["width", "cell"]).select("id", "v", "width", "cell", dealt("id").alias("sub"), "subs"), "queries")

    def look(_key, asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(held):
            tree = pickle.loads(held["tree"].iloc[0])  # noqa: S301  written by build() above
            for at in range(0, len(asking), TOGETHER):
                part = asking.iloc[at : at + TOGETHER]
                ids = part["id"].to_numpy(np.int64)
                floors = [None if w is None else -wide_value(w) if w else -int(s) for s, w in zip(part["s"], part["wide"], strict=True)]
                out += [(int(ids[i]), one, *sortable(score)) for i, one, score in tree.search(np.array(part["v"].to_list(), float).reshape(len(part), -1), ids, floors, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "s", "wide"]).astype({"query_id": "int64", "vec_id": "int64", "s": "int64"})

    def round_of(asking: DataFrame, name: str) -> DataFrame:
        """Hits of (id, v, shard, s, wide), in blocks of queries; a shard's tree goes to each of its blocks."""
        sizes = asking.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        sizes = scratch.table(sizes, f"{name}-blocks")
        by = [*where, "block"]
        parts = asking.join(sizes, where).withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")).cast("int")).select("id", "v", "s", "wide", *by)
        held = trees.join(sizes, where).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("tree", *by)
        return scratch.table(parts.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(look, _HITS), name)

    def worst(hits: DataFrame) -> DataFrame:
        """(id, s, wide): the k-th of the hits so far, for queries that have as many."""
        place = F.row_number().over(Window.partitionBy("query_id").orderBy("s", "wide", "vec_id"))
        return hits.withColumn("rank", place).where(F.col("rank") == k).select(F.col("query_id").alias("id"), "s", "wide")

    none = [F.lit(0).cast("long").alias("s"), F.lit(None).cast("binary").alias("wide")]  # no floor is known
    first = round_of(queries.select("id", "v", *where, *none), "first")
    known = queries.join(worst(first), "id", "left").select("id", "v", "width", "cell", F.coalesce("s", F.lit(0)).alias("s"), "wide")
    centres, reach = cells.centres, np.array([radius.get(c, -np.inf) for c in range(len(cells.centres))])
    starts = np.flatnonzero(np.diff(cells.cell, prepend=-1))

    def aim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, aims): the cells of which a ball reaches a query's k-th score, highest bound first; its own one leads them."""
        kind = pa.list_(pa.struct([("cell", pa.int32()), ("bound", pa.float64())]))
        for batch in batches:
            values, sizes = _vectors(batch.column("v"))
            s, wide, home = batch.column("s").to_pylist(), batch.column("wide").to_pylist(), batch.column("cell").to_numpy()
            aims = [[{"cell": c, "bound": math.inf}] for c in home.tolist()]
            own = np.flatnonzero(home >= 0)
            if len(own):
                q = values[np.repeat(home >= 0, sizes)].reshape(len(own), -1)
                norm = np.sqrt((q**2).sum(axis=1))
                with np.errstate(all="ignore"):
                    slack = q.shape[1] * _EPS * (np.sqrt((centres**2).sum(axis=1)) + reach)
                    bound = q @ centres.T + norm[:, None] * (reach * (1 + 1e-9) + slack)[None, :] + 1e-12
                    bound[np.isnan(bound)] = np.inf
                    bound[:, np.isneginf(reach)] = -np.inf  # balls that no row went to
                    bound = np.maximum.reduceat(bound, starts, axis=1)
                    floor = np.array([-np.inf if wide[i] is None or s[i] >= CLAMP else math.ldexp(-float(s[i]), -2 * UNIT) for i in own])
                    floor -= np.where(np.isfinite(floor), np.abs(floor) * 1e-12, 0)
                    visits = (bound >= floor[:, None]) & ~np.isneginf(bound)
                visits[np.arange(len(own)), home[own]] = False
                for i, row, high in zip(own.tolist(), visits, bound, strict=True):
                    at = np.flatnonzero(row)
                    at = at[np.argsort(-high[at], kind="stable")]
                    aims[i] += [{"cell": c, "bound": x} for c, x in zip(at.tolist(), high[at].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(aims, kind)], ["id", "aims"])

    # Orders are told once and written, without vectors: bounds computed anew could differ in their last bit, and a cell be left out.
    aims = scratch.table(known.select("id", "v", "cell", "s", "wide").mapInArrow(aim, "id long, aims array<struct<cell: int, bound: double>>"), "aims")
    asked = queries.select("id", "v", "width", F.col("cell").alias("home"), F.col("sub").alias("home_sub"))

    def sent(chosen: DataFrame, hits: DataFrame) -> DataFrame:
        """Queries with the shards of the cells (id, cell, bound) that the k-th score of the hits leaves, its first shard left out."""
        floor = -F.col("s").cast("double") * F.lit(2.0 ** (-2 * UNIT))
        floor = F.when(F.col("wide").isNull() | (F.col("s") >= F.lit(CLAMP)), F.lit(-math.inf)).otherwise(floor - F.abs(floor) * 1e-12)
        chosen = chosen.join(worst(hits), "id", "left").where(F.col("bound") >= floor).select("id", "cell", F.coalesce("s", F.lit(0)).alias("s"), "wide")
        out = chosen.join(asked, "id").join(shards, ["width", "cell"]).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
        return out.where("cell <> home or sub <> home_sub").select("id", "v", *where, "s", "wide")

    # the query's own cell and the NEXT best ones, then what their k-th score leaves of the others
    second = round_of(scratch.table(sent(aims.select("id", F.inline(F.slice("aims", 1, NEXT + 1))), first), "sent2"), "second")
    hits = first.unionByName(second)
    others = aims.where(F.size("aims") > NEXT + 1).select("id", F.inline(F.slice("aims", F.lit(NEXT + 2), F.size("aims"))))
    third = round_of(scratch.table(sent(others, hits), "sent3"), "third")
    hits = hits.unionByName(third)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("s", "wide", "vec_id"))
    ranked = hits.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", (-F.col("s")).alias("score"))
