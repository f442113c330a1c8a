"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A byte-level vocabulary writes each byte as one printable character. Rank files hold raw bytes; they become a
tokenizers model by that byte-to-character table, with one merge for every way of cutting a token into two tokens,
in order of the token's rank. Decoding reverses the table, so a token that holds part of a character decodes to
exactly its bytes, and a run of such tokens to the whole character.

Texts are encoded segment by segment. A cut goes before each blank that stands between two characters which are no
white space: the split pattern never spans such a place and never looks across it, so the ids are those of the
whole text. Segments recur, so each worker keeps the ids of those it has seen, up to a bound.

Null and empty texts have no tokens. Special tokens' strings within a text are ordinary text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Regex, Tokenizer, models, pre_tokenizers  # noqa: E402

from sieveline.llm.common import prepare  # noqa: E402


def byte_table() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next free one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tokenizer_from_ranks(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """A tokenizers model that encodes as the rank file's own library does."""
    to_char = byte_table()
    spell = {token: "".join([to_char[b] for b in token]) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        cuts = [(token[:i], token[i:]) for i in range(1, len(token))]
        halves = [(a, b) for a, b in cuts if a in ranks and b in ranks]
        merges += [(spell[a], spell[b]) for a, b in sorted(halves, key=lambda p: (ranks[p[0]], ranks[p[1]]))]
    out = Tokenizer(models.BPE({spell[t]: r for t, r in ranks.items()}, merges))
    split = pre_tokenizers.Split(Regex(pattern), "isolated")
    out.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return out


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str | None = None) -> Tokenizer:
    """A tokenizer from a rank file (with its split pattern) or from a tokenizers file."""
    if pattern is not None:
        return tokenizer_from_ranks(read_ranks(path), pattern)
    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    out.encode_special_tokens = True
    return out


@functools.lru_cache(maxsize=4)
def token_bytes(path: str, pattern: str | None = None) -> list[bytes]:
    """The bytes of each id, by the reversed byte table; ids outside the vocabulary have none."""
    of_char = {c: b for b, c in enumerate(byte_table())}
    vocab = load(path, pattern).get_vocab(with_added_tokens=False)
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes([of_char[c] for c in token]) if all(c in of_char for c in token) else token.encode()
    return out


@functools.lru_cache(maxsize=4)
def _flat_bytes(path: str, pattern: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes one after another, where each begins, and how many it has."""
    tokens = token_bytes(path, pattern)
    sizes = np.fromiter(map(len, tokens), np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes


_CUT = re.compile(r"(?<=\S)(?= \S)")
#: A blank beside other white space, so that not every blank is such a place.
_BESIDE = re.compile(r" \s|[^\S ] ").search


def split(texts: list[str]) -> tuple[list[tuple[str, str]], list[str], list[int]]:
    """Each text's beginning and end, what stands between them as segments after a blank each, and how many of these it has."""
    heads, tails, counts = [], [], []
    for text in texts:
        if not text or text[0] == " " or text[-1] == " " or _BESIDE(text):
            first, *rest = _CUT.split(text) if text else [""]
            rest = [s[1:] for s in rest]
            if rest and rest[-1][-1].isspace():  # white space at the text's end isn't cut off
                last = rest.pop()
                heads.append((first, f" {last}"))
            else:
                heads.append((first, ""))
        else:
            first, *rest = text.split(" ")
            heads.append((first, ""))
        tails += rest
        counts.append(len(rest))
    return heads, tails, counts


def looked_up(held: dict, segments: list[str], fresh: Callable[[list[str]], dict]) -> list:
    """What ``held`` has for the segments, after adding what ``fresh`` finds for new ones; long ones are not kept."""
    found = list(map(held.get, segments))
    at = [i for i, x in enumerate(found) if x is None]
    if not at:
        return found
    known = fresh(list({segments[i] for i in at}))
    for i in at:
        found[i] = known[segments[i]]
    if len(held) + len(known) > Segments.LIMIT:
        held.clear()
    held.update((s, x) for s, x in known.items() if len(s) <= Segments.LONGEST)
    return found


class Segments(dict):
    """The ids, as little-endian 32-bit words, of ' ' + segment, and the encoding of texts from them."""

    #: Segments kept per worker, the longest that is kept, and the code points of text that are looked up at once.
    LIMIT, LONGEST, AT_ONCE = 800_000, 48, 1_000_000

    def __init__(self, path: str, pattern: str | None) -> None:
        super().__init__()
        self.tokenizer = load(path, pattern)
        self.sizes = np.fromiter(map(len, token_bytes(path, pattern)), np.int64)

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _look_up(self, segments: list[str]) -> list[bytes]:
        """The ids of ' ' + segment for segments without white space at their ends: new ones in a single run."""
        return looked_up(self, segments, self.fresh)

    def fresh(self, new: list[str]) -> dict[str, bytes]:
        """The ids of ' ' + segment for each, in a single run."""
        ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(new)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, new)), np.int64, len(new)) + 1)
        cuts = (4 * np.searchsorted(np.cumsum(self.sizes[ids]), ends, "right")).tolist()
        raw = ids.tobytes()
        known = dict(zip(new, [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)], strict=True))
        return known

    def encode(self, text: str) -> bytes:
        return next(self.encode_many([text]))

    def encode_many(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of whole texts as little-endian unsigned 32-bit words, in order."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= self.AT_ONCE:
                yield from self._encode(held)
                held, size = [], 0
        yield from self._encode(held)

    def _encode(self, texts: list[str]) -> list[bytes]:
        heads, tails, counts = split(texts)
        found, at, out = self._look_up(tails), 0, []
        for (first, last), n in zip(heads, counts, strict=True):
            inner = b"".join(found[at : at + n])
            at += n
            out.append((self.ids(first) if first else b"") + inner + (self.ids(last) if last else b""))
        return out


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str | None = None) -> Segments:
    """One per Python worker and vocabulary."""
    return Segments(path, pattern)


class TokenCounts(dict):
    """Numbers of ids of ' ' + segment by several vocabularies, packed in one integer, and those of texts from them."""

    #: Bits of a vocabulary's number: more than a text of 2 GB has tokens.
    BITS = 31

    def __init__(self, kinds: tuple[tuple[str, str | None], ...]) -> None:
        super().__init__()
        self.encoders = [encoder(path, pattern) for path, pattern in kinds]

    def _packed(self, ids: list[bytes]) -> int:
        return sum(len(x) // 4 << self.BITS * k for k, x in enumerate(ids))

    def of(self, texts: Iterable[str]) -> list[list[int]]:
        """For each vocabulary the texts' numbers of ids, the same as of :meth:`Segments.encode_many`."""
        totals, held, size = [], [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= Segments.AT_ONCE:
                totals += self._count(held)
                held, size = [], 0
        totals += self._count(held)
        return [[x >> self.BITS * k & (1 << self.BITS) - 1 for x in totals] for k in range(len(self.encoders))]

    def _fresh(self, new: list[str]) -> dict[str, int]:
        each = [codes.fresh(new) for codes in self.encoders]
        return {s: self._packed([x[s] for x in each]) for s in new}

    def _count(self, texts: list[str]) -> list[int]:
        heads, tails, counts = split(texts)
        found = looked_up(self, tails, self._fresh)
        at, out = 0, []
        for ends, n in zip(heads, counts, strict=True):
            out.append(sum(found[at : at + n]) + sum(self._packed([codes.ids(x) for codes in self.encoders]) for x in ends if x))
            at += n
        return out


@functools.lru_cache(maxsize=4)
def counter(kinds: tuple[tuple[str, str | None], ...]) -> TokenCounts:
    """One per Python worker and set of vocabularies."""
    return TokenCounts(kinds)


def decode_bytes(ids: bytes, path: str, pattern: str | None = None) -> bytes:
    """The bytes that ids (little-endian 32-bit words) stand for."""
    flat, starts, sizes = _flat_bytes(path, pattern)
    which = np.frombuffer(ids, "<u4")
    lengths = sizes[which]
    ends = np.cumsum(lengths)
    if not len(which):
        return b""
    return flat[np.arange(ends[-1]) + np.repeat(starts[which] - ends + lengths, lengths)].tobytes()


def char_offsets(text: str, ids: bytes, path: str, pattern: str | None = None) -> tuple[list[int], list[int]]:
    """Start and end of each token in code points; a token with part of a character covers the whole character."""
    sizes = np.fromiter(map(len, map(token_bytes(path, pattern).__getitem__, np.frombuffer(ids, "<u4").tolist())), np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    chars = np.cumsum((raw & 0xC0) != 0x80)  # characters begun up to and with each byte
    return (chars[ends - sizes] - 1).tolist(), chars[ends - 1].tolist()


def _strings(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def encode(df: DataFrame, path: str, pattern: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """Rows of (id, ids array<int>), and with ``offsets`` also char_start and char_end arrays.

    Null text: empty arrays. A null id stays null. Repeated rows give repeated results. Other columns, whatever
    their names, are not read.
    """
    prepare(df.sparkSession)
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, ids array<int>" + ", char_start array<int>, char_end array<int>" * offsets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(path, pattern)
        for batch in batches:
            texts = _strings(batch.column(1))
            found = list(codes.encode_many(texts))
            ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
            out = [batch.column(0), pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(found), "<i4"))]
            if offsets:
                spans = [char_offsets(t, x, path, pattern) if x else ([], []) for t, x in zip(texts, found, strict=True)]
                out += [pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(out, [id_col, "ids", "char_start", "char_end"][: len(out)])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str | None = None, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows of (id, data binary): the bytes of the ids. Null ids give empty data; ids outside the vocabulary fail."""
    prepare(df.sparkSession)
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [decode_bytes(np.array(x or [], "<u4").tobytes(), path, pattern) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], [id_col, "data"])

    return df.select(id_col, ids_col).mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, pattern: str | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass and keep only digests: (id, n_tokens, ids_sha256, decoded_sha256).

    Same cases as :func:`encode`. One text is in memory at a time besides its Arrow batch.
    """
    prepare(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(path, pattern)
        for batch in batches:
            counts, a, b = [], [], []
            for ids in codes.encode_many(text.as_py() or "" for text in batch.column(1)):
                counts.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(decode_bytes(ids, path, pattern)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
