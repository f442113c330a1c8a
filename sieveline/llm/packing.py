"""Packing of token documents into sequences of fixed length.

Documents become ids (tokenizers library) and a closing id. A document longer than a sequence is cut into full
sequences and a remainder; every id lies in exactly one piece. Pieces are packed within bounded windows of each
input partition, so a task never holds more than one window, and a recomputed task packs alike.

Two methods fill the sequences:

* ``best_fit_decreasing``: pieces by falling length, each into the open sequence with the least room that suffices,
  found by a segment tree over the rooms 0..capacity (its node holds whether any sequence has such a room).
* ``minimum_bin_slack``: each sequence takes the multiset of remaining lengths whose sum comes closest to capacity.
  Reachable sums are a bitset in one integer; the bitset after each length is kept, and walking back through them
  gives how many pieces of each length were taken.

Sequences of a window that are less than half full are opened again with the next window's pieces.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from sieveline.llm import bpe
from sieveline.llm.common import prepare

#: Pieces of a window, and the ids in it after which it is packed.
WINDOW_PIECES, WINDOW_IDS = 4096, 2_000_000


class CapacityTree:
    """A segment tree over the rooms 0..capacity: the smallest room of at least ``need`` that some open bin has."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: dict[int, list[int]] = defaultdict(list)

    def add(self, room: int, which: int) -> None:
        self.bins[room].append(which)
        i = room + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) with the least room that suffices."""
        count, i = self.count, need + self.size
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.size
        while i:
            count[i] -= 1
            i >>= 1
        return room, self.bins[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes into ``lengths``; ties by index."""
    tree, bins = CapacityTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        got = tree.take(lengths[i])
        if got is None:
            got = (capacity, len(bins))
            bins.append([])
        room, where = got
        bins[where].append(i)
        if room > lengths[i]:
            tree.add(room - lengths[i], where)
    return bins


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many pieces of each length give the largest sum up to ``capacity``; longer pieces are preferred."""
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted(counts):
        left, unit = min(counts[length], capacity // length), 1
        while left:  # bounded multiplicity by doubling: 1, 2, 4, ... and the rest
            take = min(unit, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            unit *= 2
        if reach >> capacity & 1:
            break
    goal, taken = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> goal & 1:
            taken[length] += take
            goal -= length * take
    return dict(taken)


def minimum_bin_slack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes into ``lengths``. Each bin starts from the longest piece left and fills the rest best."""
    by_length: dict[int, list[int]] = defaultdict(list)
    for i in reversed(range(len(lengths))):
        by_length[lengths[i]].append(i)
    bins, order = [], sorted(by_length)
    while order:
        longest = order[-1]
        taken = closest_fill({x: len(by_length[x]) - (x == longest) for x in order if x <= capacity - longest and len(by_length[x]) > (x == longest)}, capacity - longest) if longest < capacity else {}
        taken[longest] = taken.get(longest, 0) + 1
        bins.append([by_length[x].pop() for x, n in taken.items() for _ in range(n)])
        if any(not by_length[x] for x in taken):
            order = [x for x in order if by_length[x]]
    return bins


METHODS: dict[str, Callable[[list[int], int], list[list[int]]]] = {"minimum_bin_slack": minimum_bin_slack, "best_fit_decreasing": best_fit_decreasing}


def pack_stream(docs: Iterator[tuple[object, bytes]], method: str, capacity: int, first_id: int) -> Iterator[list[tuple[int, list[tuple[object, int, int, int, bytes]]]]]:
    """Windows of packed sequences: (sequence_id, [(doc, start, length, doc_tokens, ids)]) from (doc, ids) in order."""
    fill, pieces, held, next_id = METHODS[method], [], 0, first_id

    def close(last: bool) -> list:
        nonlocal pieces, held, next_id
        out, again = [], []
        for members in fill([p[2] for p in pieces], capacity):
            inside = [pieces[i] for i in members]
            if not last and 2 * sum(p[2] for p in inside) < capacity:
                again += inside
                continue
            out.append((next_id, inside))
            next_id += 1
        pieces, held = again, sum(p[2] for p in again)
        return out

    for doc, ids in docs:
        n = len(ids) // 4
        full = n - n % capacity
        done = []
        for start in range(0, full, capacity):
            done.append((next_id, [(doc, start, capacity, n, ids[4 * start : 4 * (start + capacity)])]))
            next_id += 1
        if done:
            yield done
        if full < n:
            pieces.append((doc, full, n - full, n, ids[4 * full :]))
            held += n - full
        if len(pieces) >= WINDOW_PIECES or held >= WINDOW_IDS:
            yield close(False)
    yield close(True)


def _documents(batches: Iterator[pa.RecordBatch], path: str, pattern: str | None, closing: bytes) -> Iterator[tuple[object, bytes]]:
    codes = bpe.encoder(path, pattern)
    for batch in batches:
        texts = (text.as_py() or "" for text in batch.column(1))
        for doc, ids in zip(batch.column(0).to_pylist(), codes.encode_many(texts), strict=True):
            yield doc, ids + closing


def _first_sequence() -> int:
    """Sequences of different partitions never share an id: the partition is in the upper half."""
    return TaskContext.get().partitionId() << 32


def pack_pieces(df: DataFrame, path: str, pattern: str | None = None, *, capacity: int = 1024, closing_id: int = 0, method: str = "minimum_bin_slack", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text is an empty one: a document of just the closing id. A null id stays null; rows that repeat are
    documents of their own. Sequences belong to one input partition; their ids are unique, not gapless. Other
    columns, whatever their names, are not read.
    """
    prepare(df.sparkSession)
    kind, id_type = df.schema[id_col].dataType.simpleString(), to_arrow_type(df.schema[id_col].dataType)
    closing = np.array([closing_id], "<u4").tobytes()
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        types = [id_type, *[pa.int64()] * 6]

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for window in pack_stream(_documents(batches, path, pattern, closing), method, capacity, _first_sequence()):
            for sequence, inside in window:
                offset = 0
                for doc, start, length, total, ids in inside:
                    rows.append((doc, start, length, zlib.crc32(ids), total, sequence, offset))
                    offset += length
            if len(rows) >= 4096:
                yield batch_of()
                rows.clear()
        if rows:
            yield batch_of()

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack_matrix(df: DataFrame, path: str, pattern: str | None = None, *, capacity: int = 1024, closing_id: int = 0, method: str = "best_fit_decreasing", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sequence, ready to be written as a binary id matrix.

    sequence_id; n_tokens (the rest up to ``capacity`` is padding, the closing id); input_ids: ``capacity`` ids as
    little-endian unsigned 32-bit words; cu_seqlens: 0 and the cumulative lengths of its segments; position_ids:
    ``capacity`` little-endian unsigned 16-bit positions that restart at 0 with each segment and in the padding;
    doc_ids and starts: where each segment comes from. Cases as for :func:`pack_pieces`.
    """
    prepare(df.sparkSession)
    if capacity > 65536:
        raise ValueError("positions are written as 16-bit words")
    kind, id_type = df.schema[id_col].dataType.simpleString(), to_arrow_type(df.schema[id_col].dataType)
    closing = np.array([closing_id], "<u4").tobytes()
    names = ["sequence_id", "n_tokens", "input_ids", "cu_seqlens", "position_ids", "doc_ids", "starts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ramp = np.arange(capacity, dtype="<u2").tobytes()
        types = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(id_type), pa.list_(pa.int64())]
        rows: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for window in pack_stream(_documents(batches, path, pattern, closing), method, capacity, _first_sequence()):
            for sequence, inside in window:
                ends = [0]
                for piece in inside:
                    ends.append(ends[-1] + piece[2])
                spare = capacity - ends[-1]
                ids = b"".join([p[4] for p in inside]) + closing * spare
                places = b"".join([ramp[: 2 * p[2]] for p in inside]) + ramp[: 2 * spare]
                rows.append((sequence, ends[-1], ids, ends, places, [p[0] for p in inside], [p[1] for p in inside]))
                if len(rows) >= 512:
                    yield batch_of()
                    rows.clear()
        if rows:
            yield batch_of()

    return df.select(id_col, text_col).mapInArrow(run, f"sequence_id long, n_tokens int, input_ids binary, cu_seqlens array<int>, position_ids binary, doc_ids array<{kind}>, starts array<long>")


def write_matrix(packed: DataFrame, path: str) -> DataFrame:
    """Write the sequences of :func:`pack_matrix` as binary files below ``path`` and return their index, a row per file set.

    Each task writes ``<file>.ids`` (a row of ``capacity`` little-endian unsigned 32-bit ids per sequence), ``<file>.pos``
    (as many unsigned 16-bit positions) and ``<file>.cu`` (per sequence the number of its cumulative lengths, then these, as
    unsigned 32-bit words). The index (file, n_sequences, n_tokens, capacity, ids_crc32) is written last, to
    ``path/index``, by the tasks that wrote the files: what a lost or repeated task has left is not in it. ``path`` is a folder
    that driver and executors share. No sequences: an empty index.
    """
    spark, path = packed.sparkSession, path.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(path)
        file, files, total, tokens, capacity, crc = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", None, 0, 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if files is None:
                store.create_dir(at, recursive=True)
                files = [store.open_output_stream(f"{at}/{file}.{end}") for end in ("ids", "pos", "cu")]
            for n, ids, ends, places in zip(*[batch.column(c).to_pylist() for c in ("n_tokens", "input_ids", "cu_seqlens", "position_ids")], strict=True):
                for out, data in zip(files, (ids, places, np.array([len(ends), *ends], "<u4").tobytes()), strict=True):
                    out.write(data)
                total, tokens, capacity, crc = total + 1, tokens + n, len(ids) // 4, zlib.crc32(ids, crc)
        if files is not None:
            for out in files:
                out.close()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (file, total, tokens, capacity, crc)], ["file", "n_sequences", "n_tokens", "capacity", "ids_crc32"])

    index = packed.select("n_tokens", "input_ids", "cu_seqlens", "position_ids").mapInArrow(run, "file string, n_sequences long, n_tokens long, capacity long, ids_crc32 long")
    index.write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def read_matrix(path: str, file: str, capacity: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """One file set of :func:`write_matrix`: ids, positions, and each sequence's cumulative lengths."""
    store, at = fs.FileSystem.from_uri(path.rstrip("/"))
    ids, places, ends = (np.frombuffer(store.open_input_stream(f"{at}/{file}.{end}").read(), kind) for end, kind in (("ids", "<u4"), ("pos", "<u2"), ("cu", "<u4")))
    out, i = [], 0
    while i < len(ends):
        out.append(ends[i + 1 : i + 1 + ends[i]])
        i += 1 + int(ends[i])
    return ids.reshape(-1, capacity), places.reshape(-1, capacity), out
