"""Near-duplicate documents by an LSH forest, every link confirmed on the full shingle sets.

A document's set holds its distinct n-word shingles. Equal sets form a class, which is linked through its smallest id;
what follows works on one representative per class. Each representative has ``trees`` signatures of ``depth`` minimum
hashes. In every tree the representatives are sorted by signature, so that those with the longest common prefix stand
next to each other; each is held against its ``near`` successors, and so a crowded region is searched at the depth that
tells its members apart and a thin one at whatever depth it has. One bit of every minimum hash makes a sketch that
drops pairs which are far from similar. Remaining pairs are confirmed on whole texts.

The first pass takes candidates that join what is not yet joined within a task, so that a large group of copies gives
links in proportion to its size. It notes the runs (rows that share the first ``shared`` hashes of a tree) in which it left
a pair out, which exceed the window, or which lie across a border of two tasks.

The second pass compares those of these runs whole that still hold several components, so that no two rows of a run go
unseen, however many it has. Rows outside a run's largest component meet all its rows in blocks of bounded size; a run
of one component and some others costs in proportion to its size. Pairs that pass the sketch are counted on the full
sets by products of 0/1 matrices, and only links that join components leave a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import BASE, WORDS, Scratch, integral, mix, prepare, windows_hash
from sieveline.llm.components import _root, components


@dataclass(frozen=True)
class Forest:
    """Parameters: a pair of similarity 0.8 shares a prefix of four hashes in one of 24 trees but for 3 in 10**6.

    What stands between the two in a tree shares that prefix too: among n documents that are similar by 0.1, n / 10**4
    do; by 0.05, n / 10**5.
    """

    trees: int = 24
    depth: int = 8
    near: int = 32
    seed: int = 7
    #: Hashes of a tree that a pair has to share, at most four.
    shared: int = 4


#: Ids up to this number are broadcast (8 bytes each) to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Rows and shingles of a block of a crowded run, and the columns of one matrix product.
BLOCK_ROWS, BLOCK_SHINGLES, COLUMNS = 2_000, 400_000, 1_024


def _multipliers(forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(forest.seed)
    n = forest.trees * forest.depth
    return rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case: runs of bytes other than 0x20 and 0x09-0x0D."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], n: int) -> set:
    """Distinct n-word shingles; of fewer words, the whole sequence; of none, nothing."""
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(n)], strict=False))


def _set_hashes(words: list[bytes], n: int) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    h = WORDS.of(words)
    if len(h) < n:  # told apart from shingles of n words by their own salt
        with np.errstate(over="ignore"):
            whole = np.uint64(len(h))
            for x in h:
                whole = whole * np.uint64(BASE) + x
        return mix(np.array([whole ^ np.uint64(0x5EED)]))
    return np.unique(windows_hash(h, n))


def signature(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    """16 bits of each minimum hash, big-endian and tree by tree, then two further bits of each as the sketch."""
    least = np.full(len(a), np.uint64(2**64 - 1))
    width = max(1, 200_000 // len(a))
    with np.errstate(over="ignore"):
        for i in range(0, len(found), width):
            block = found[None, i : i + width] * a[:, None]
            block += b[:, None]
            np.minimum(least, block.min(axis=1), out=least)
    least = mix(least)
    return (least >> np.uint64(48)).astype(">u2").tobytes() + np.packbits(np.stack([least & np.uint64(1), least >> np.uint64(1) & np.uint64(1)], axis=1).astype(np.uint8)).tobytes()


def signatures(df: DataFrame, n_words: int, forest: Forest, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, k1 and k2 (128 bits that stand for the set), sig (null without words), a row per row."""
    prepare(df.sparkSession)
    a, b = _multipliers(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = _set_hashes(words_of(text.as_py() or ""), n_words)
                key = xxhash.xxh3_128_digest(found.tobytes())
                k1, k2 = np.frombuffer(key, "<i8").tolist()
                rows.append((len(found), k1, k2, signature(found, a, b) if len(found) else None))
            cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]], ["id", "n_shingles", "k1", "k2", "sig"])

    return df.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(run, "id long, n_shingles long, k1 long, k2 long, sig binary")


def _neighbours(ordered: DataFrame, forest: Forest, threshold: float) -> DataFrame:
    """Candidate pairs (a < b) among rows (tree, key, sketch, n, rep) in sorted partitions, with no prefix.

    Only pairs that join what a task has not joined. Rows with a prefix note runs of the tree a = b that hold pairs left
    out, or that the window or the task doesn't cover.
    """
    most, near = _most(forest, threshold), forest.near

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        runs: set[tuple[int, int]] = set()
        tail: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            prefix = np.frombuffer(b"".join([x[: 2 * forest.shared].ljust(8, b"\0") for x in batch.column("key").to_pylist()]), "<i8")
            now = (batch.column("tree").to_numpy(), _sketches(batch.column("sketch"), forest), batch.column("n").to_numpy(), batch.column("rep").to_numpy(), prefix)
            open_runs = [0] if tail is None else []
            old = 0
            if tail is not None:
                old = len(tail[0])
                now = tuple(np.concatenate([t, x]) for t, x in zip(tail, now, strict=True))
            tree, sketch, n, rep, prefix = now
            open_runs += np.flatnonzero((tree[: -near - 1] == tree[near + 1 :]) & (prefix[: -near - 1] == prefix[near + 1 :])).tolist()
            pairs = []
            for k in range(1, min(near, len(tree) - 1) + 1):
                first = max(0, old - k)  # pairs that end before this batch have been seen
                x, y = slice(first, len(tree) - k), slice(first + k, None)
                fit = (tree[x] == tree[y]) & (rep[x] != rep[y]) & (np.minimum(n[x], n[y]) >= threshold * np.maximum(n[x], n[y]) - 1e-9)
                at = np.flatnonzero(fit) + first
                at = at[_apart(sketch[at], sketch[at + k]) <= most]
                if len(at):
                    pairs.append(np.stack([at, at + k]))
            if pairs:
                found = np.concatenate(pairs, axis=1)
                take = np.zeros(found.shape[1], bool)
                for i, (c, d) in enumerate(zip(*rep[found].tolist(), strict=True)):
                    c, d = _root(parent, c), _root(parent, d)
                    if c != d:
                        parent[max(c, d)], take[i] = min(c, d), True
                left = found[:, ~take]
                open_runs += left[0, prefix[left[0]] == prefix[left[1]]].tolist()
                found = np.unique(np.sort(rep[found[:, take]], axis=0), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1]), pa.nulls(found.shape[1], pa.binary())], ["a", "b", "prefix"])
            new = {(int(tree[i]), int(prefix[i])) for i in open_runs} - runs
            runs |= new
            yield _noted(new)
            tail = tuple(x[-near - 1 :] for x in now)
        if tail is not None:
            yield _noted({(int(tail[0][-1]), int(tail[4][-1]))} - runs)

    def _noted(runs: set[tuple[int, int]]) -> pa.RecordBatch:
        trees = pa.array([t for t, _ in runs], pa.int64())
        return pa.RecordBatch.from_arrays([trees, trees, pa.array([x.to_bytes(8, "little", signed=True)[: 2 * forest.shared] for _, x in runs], pa.binary())], ["a", "b", "prefix"])

    return ordered.mapInArrow(run, "a long, b long, prefix binary").distinct()


def _most(forest: Forest, threshold: float) -> int:
    """Places of two sketches that may differ."""
    hashes = forest.trees * forest.depth
    # two bits agree with probability s + (1 - s) / 4 at similarity s; 4.5 standard deviations are allowed
    expect = threshold + (1 - threshold) / 4
    return int(hashes - hashes * expect + 4.5 * (hashes * expect * (1 - expect)) ** 0.5) + 1


def _sketches(column: pa.Array, forest: Forest) -> np.ndarray:
    words = -(-2 * forest.trees * forest.depth // 64)
    return np.frombuffer(b"".join([x.ljust(8 * words, b"\0") for x in column.to_pylist()]), np.uint64).reshape(-1, words)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places in which sketches differ."""
    apart = x ^ y
    return np.bitwise_count((apart | apart >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(axis=-1)


def _common(sets: list[np.ndarray], one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many hashes the sets ``one`` (rows) and ``other`` (columns) have in common."""
    hashes, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    number = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[place]  # a hash that one set holds is nobody's in common
    row, number = row[number >= 0], number[number >= 0]
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    out = np.zeros((len(one), len(other)), np.float32)
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        at = slice(*np.searchsorted(number, [start, start + COLUMNS]))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[row[at], number[at] - start] = 1
        out += held[one] @ held[other].T
    return out


def _crowded(reps: DataFrame, runs: DataFrame, slim: DataFrame, forest: Forest, n_words: int, threshold: float, id_col: str, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) that link different components within whole ``runs`` (tree, prefix), from reps (rep, n, sig, comp).

    Enough of them to connect what is linked in a block, not all.
    """
    width, most, percent = 2 * forest.depth, _most(forest, threshold), round(100 * threshold)
    tree, run = F.col("tree"), ["tree", "prefix"]
    rows = reps.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))))
    rows = rows.select(tree, F.substring("sig", tree * width + 1, F.lit(2 * forest.shared)).alias("prefix"), F.substring("sig", F.lit(forest.trees * width + 1), F.lit(4096)).alias("sketch"), "n", "rep", "comp")
    wanted = F.broadcast(runs) if runs.count() <= BROADCAST_IDS else runs
    rows = scratch.table(rows.join(wanted, run, "left_semi"), "crowd")
    # a run's rows by component, so that a hot run is added up before it meets in one row
    sizes = rows.groupBy(*run, "comp").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    total = [F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"), F.max(F.struct("rows", "shingles", "comp")).alias("main"), F.count(F.lit(1)).alias("comps")]
    sizes = sizes.groupBy(*run).agg(*total).where("comps > 1")
    blocks = lambda rows, shingles: F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")
    sizes = sizes.select(*run, F.col("main.comp").alias("main"), blocks(F.col("rows"), F.col("shingles")).alias("all"), blocks(F.col("rows") - F.col("main.rows"), F.col("shingles") - F.col("main.shingles")).alias("few"))
    rows = rows.join(scratch.table(sizes, "crowds", thin=True), run)
    every = lambda n: F.sequence(F.lit(0), n - 1)
    dealt = lambda n, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), n).cast("int")
    keep = ["sketch", "n", "rep", "comp", "outside"]
    rows = rows.withColumn("outside", F.col("comp") != F.col("main"))
    asks = rows.where("outside").select(*run, dealt(F.col("few"), 1).alias("i"), F.explode(every(F.col("all"))).alias("j"), F.lit(True).alias("asks"), *keep)
    held = rows.select(*run, F.explode(every(F.col("few"))).alias("i"), dealt(F.col("all"), 2).alias("j"), F.lit(False).alias("asks"), *keep)
    rows = scratch.table(asks.unionByName(held), "blocks")
    scratch.drop("crowd", "crowds")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_set_hashes(words_of(x.as_py() or ""), n_words).tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["rep", "held"])

    texts = _texts(slim, rows.select(F.col("rep").alias("a"), F.col("rep").alias("b")), id_col, scratch, "texts2")
    rows = rows.join(texts.select("id", "text").mapInArrow(hashed, "rep long, held binary"), "rep")

    def linked(found: pa.Table) -> pa.Table:
        found = found.combine_chunks()
        asks, outside = (found[c].to_numpy(zero_copy_only=False) for c in ("asks", "outside"))
        n, rep, comp = (found[c].to_numpy() for c in ("n", "rep", "comp"))
        sketch = _sketches(found["sketch"], forest)
        one, other = np.flatnonzero(asks), np.flatnonzero(~asks)
        fit = np.zeros((len(one), len(other)), bool)
        for k, x in enumerate(one):
            may = (comp[other] != comp[x]) & (np.minimum(n[other], n[x]) >= threshold * np.maximum(n[other], n[x]) - 1e-9)
            at = np.flatnonzero(may & (~outside[other] | (rep[other] > rep[x])))  # two that ask meet twice
            fit[k, at[_apart(sketch[other[at]], sketch[x]) <= most]] = True
        left, right = fit.any(axis=1), fit.any(axis=0)
        one, other, fit = one[left], other[right], fit[left][:, right]
        out: list[tuple[int, int]] = []
        if len(one):
            used, at = np.unique(np.concatenate([one, other]), return_inverse=True)
            sets = found["held"].take(pa.array(used)).to_pylist()
            common = _common([np.frombuffer(x, np.uint64) for x in sets], at[: len(one)], at[len(one) :])
            parent: dict[int, int] = {}
            for x, ys, same in zip(one, fit, common, strict=True):
                same = same.astype(np.int64)
                for y in other[np.flatnonzero(ys & (100 * same >= percent * (n[x] + n[other] - same)))]:
                    c, d = _root(parent, int(comp[x])), _root(parent, int(comp[y]))
                    if c != d:
                        parent[max(c, d)] = min(c, d)
                        out.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return rows.groupBy(*run, "i", "j").applyInArrow(linked, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, n_words: int, threshold: float) -> DataFrame:
    """(a, b, linked): similarity of the full shingle sets against the threshold, in whole numbers."""
    percent = round(100 * threshold)
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[object, set] = (None, set())
        for batch in batches:
            linked = []
            for b, ta, tb in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if held[0] != b:
                    held = (b, shingles(words_of(tb.as_py() or ""), n_words))
                one, other = shingles(words_of(ta.as_py() or ""), n_words), held[1]
                common = len(one & other)
                linked.append(bool(common) and 100 * common >= percent * (len(one) + len(other) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, linked boolean")


def near_duplicates(df: DataFrame, *, n_words: int = 5, threshold: float = 0.8, forest: Forest = Forest(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (the smallest id that links reach), kept (the id is its component's), per row.

    Texts without words (null, empty, blank) have no shingles and are linked with nothing. Rows that share an id are one
    node; ids are integers, of any width, and others raise; a row without an id takes no part, has no component and is kept. Ties don't arise: every link counts. Other
    columns of ``df`` are not read.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "near")
    slim = integral(df, id_col).select(F.col(id_col), F.col(text_col).alias("text"))
    docs = scratch.table(signatures(slim, n_words, forest, id_col, "text"), "signatures")
    member = docs.where("id is not null and n_shingles > 0")
    classes = member.groupBy("k1", "k2").agg(F.min("id").alias("rep"))
    # a class's members have equal signatures, so its smallest id's row stands for it
    reps = member.join(classes.select("k1", "k2", F.col("rep").alias("id")), ["k1", "k2", "id"], "left_semi").dropDuplicates(["id", "k1", "k2"])
    width = 2 * forest.depth
    reps = scratch.table(reps.select(F.col("id").alias("rep"), F.col("n_shingles").alias("n"), "sig"), "reps")
    tree = F.col("tree")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # the rows of all trees, in order
    rows = reps.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))))
    rows = rows.select(tree, F.substring("sig", tree * width + 1, F.lit(width)).alias("key"), F.substring("sig", F.lit(forest.trees * width + 1), F.lit(4096)).alias("sketch"), "n", "rep")
    rows = rows.repartitionByRange(parts, "tree", "key", "sketch", "rep").sortWithinPartitions("tree", "key", "sketch", "rep")
    found = scratch.table(_neighbours(rows, forest, threshold), "candidates")
    runs = found.where("prefix is not null").select(F.col("a").cast("int").alias("tree"), "prefix")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """Those of the pairs that the whole texts confirm."""
        checked = scratch.table(_confirmed(pairs, _texts(slim, pairs, id_col, scratch, f"texts{name}"), n_words, threshold).where("linked").select("a", "b"), f"links{name}")
        scratch.drop(f"texts{name}", f"texts{name}-ids")
        return checked

    links = linked(found.where("prefix is null").select("a", "b"), "1")
    comps = scratch.table(components(links, scratch, "stars"), "comps1", thin=True)
    whole = reps.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left").select("rep", "n", "sig", F.coalesce("component", "rep").alias("comp"))
    more = scratch.table(_crowded(whole, runs, slim, forest, n_words, threshold, id_col, scratch), "crowded")
    scratch.drop("blocks", "texts2", "texts2-ids", "candidates", "reps")
    more = linked(more, "3")
    if not more.isEmpty():
        comps = scratch.table(components(links.unionByName(more), scratch, "stars2"), "comps2", thin=True)
    of_class = classes.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("of_class"))
    out = docs.join(of_class, ["k1", "k2"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("of_class")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))


def _texts(slim: DataFrame, pairs: DataFrame, id_col: str, scratch: Scratch, name: str) -> DataFrame:
    """(id, text) of the documents that stand in pairs."""
    ids = scratch.table(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), f"{name}-ids", thin=True)
    n = ids.count()
    wanted = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    found = slim.select(F.col(id_col).cast("long").alias("id"), "text").join(wanted, "id", "left_semi")
    return scratch.table(found, name)


def filtered(df: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One row of each group of near-duplicates stays, with all its columns: the first by id; rows without an id stay.

    Rows that repeat an id are told apart by nothing and stay together. Options as for :func:`near_duplicates`.
    """
    keep = near_duplicates(df, id_col=id_col, **options).where("kept").select(F.col(id_col).alias("__kept")).distinct()
    return df.join(keep, df[f"`{id_col}`"].eqNullSafe(keep["__kept"]), "left_semi")
