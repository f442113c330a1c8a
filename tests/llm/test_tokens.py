from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sieveline.llm import bpe, packing, queries, rollups

MULTI, GPT = queries.MULTI_50K, queries.GPT_50K
ODD = [None, "", " ", "  a", "a  ", "a \n b", "\n\n", "don't  stop", "日本語 テスト", "é" * 300, "<|endoftext|> x", "a  b", "\x1c x", "x" * 5000, "- " * 700, " a  ", "👩‍👩‍👧 ok"]


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(MULTI[0]), special_tokens={})


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(GPT[0])
    t.encode_special_tokens = True
    return t


def ids_of(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


PIECES = st.lists(st.sampled_from(["a", "b", " ", "  ", "\n", "\t", "'s", "1", "23", "é", "ß", "日", "-", "--", "=", "word", " word", " ", "\x1c", "aa", "_", "👍", "<|endoftext|>"]), max_size=40).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.one_of(PIECES, st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=60)))
def test_encoders_agree_with_the_libraries(text):
    tok = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=_ranks(), special_tokens={})
    for codes, want in ((bpe.encoder(*MULTI), tok.encode_ordinary(text)), (bpe.encoder(*GPT), bpe.load(*GPT).encode(text, add_special_tokens=False).ids)):
        assert ids_of(codes.encode(text)) == want
    assert bpe.counter((MULTI, GPT)).of([text, "", text]) == [[n, 0, n] for n in (len(bpe.encoder(*x).encode(text)) // 4 for x in (MULTI, GPT))]
    raw = bpe.encoder(*MULTI).encode(text)
    assert bpe.decode_bytes(raw, *MULTI) == text.encode()


_held: dict = {}


def _ranks():
    return _held.setdefault("ranks", bpe.read_ranks(MULTI[0]))


def test_cache_that_overflows_gives_the_same(spark, data, tik, monkeypatch):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()][:60]
    small = bpe.Segments(*MULTI)
    monkeypatch.setattr(bpe.Segments, "LIMIT", 50)
    assert [ids_of(x) for x in small.encode_many(texts)] == [tik.encode_ordinary(t) for t in texts]


def test_round_trip_query(spark, data, tik):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = queries.op9_byte_bpe(spark, data).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = tik.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest())


def test_encode_offsets_and_decode(spark, tik):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "null id", "x"), (0, None, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode(df, *MULTI, offsets=True)
    assert out.count() == len(rows)
    texts = defaultdict(list)
    for i, t, _ in rows:
        texts[i].append(t or "")
    for r in out.collect():
        text = texts[r["doc_id"]][0]
        assert r["ids"] == tik.encode_ordinary(text)
        pieces, spans = [tik.decode_single_token_bytes(i) for i in r["ids"]], list(zip(r["char_start"], r["char_end"], strict=True))
        assert len(pieces) == len(spans)
        for piece, (a, b) in zip(pieces, spans, strict=True):
            assert piece in text[a:b].encode()  # a token within a character has the whole character's span
        if all(len(x.encode()) == 1 for x in text):
            assert "".join(text[a:b] for a, b in spans) == text
    back = {(r["doc_id"], bytes(r["data"])) for r in bpe.decode(out, *MULTI).collect()}
    assert back == {(i, (t or "").encode()) for i, t, _ in rows}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string, lang string")
    assert bpe.encode(df, *MULTI).collect() == bpe.round_trip(df, *MULTI).collect() == []
    assert packing.pack_pieces(df, *GPT).collect() == packing.pack_matrix(df, *GPT).collect() == []


# packing


def check_pieces(rows, want: dict, capacity: int):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert {d: sum(r["length"] for r in x) for d, x in by_doc.items()} == {d: len(v) for d, v in want.items()}
    for doc, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(want[doc])
            assert r["ids_crc32"] == zlib.crc32(np.array(want[doc][at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return sum(r["length"] for r in rows) / (capacity * len(by_seq))


def test_packing_query(spark, data, plain):
    docs = {r["doc_id"]: plain.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    assert check_pieces(queries.op10_bin_slack_packing(spark, data).collect(), docs, 1024) > 0.985


def test_packing_odd_texts(spark, plain):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(ODD)], "doc_id long, text string, length int")
    want = {i: plain.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(ODD)}
    for method in packing.METHODS:
        check_pieces(packing.pack_pieces(df, *GPT, capacity=64, method=method).collect(), want, 64)
    named = spark.createDataFrame([("a", "x y"), (None, "z")], "doc_id string, text string")
    assert {r["doc_id"] for r in packing.pack_pieces(named, *GPT).collect()} == {"a", None}


def test_matrix_query(spark, data, plain):
    docs = {r["doc_id"]: plain.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    found, tokens = defaultdict(list), 0
    rows = queries.op2_bfd_matrix(spark, data).collect()
    for r in rows:
        ids, places, cuts = ids_of(r["input_ids"]), np.frombuffer(r["position_ids"], "<u2").tolist(), r["cu_seqlens"]
        assert len(ids) == len(places) == 1024 and cuts[0] == 0 and cuts[-1] == r["n_tokens"] and not any(ids[r["n_tokens"] :])
        for doc, start, a, b in zip(r["doc_ids"], r["starts"], cuts[:-1], cuts[1:], strict=True):
            found[doc].append((start, ids[a:b]))
            assert places[a:b] == list(range(b - a))
        assert places[r["n_tokens"] :] == list(range(1024 - r["n_tokens"]))
        tokens += r["n_tokens"]
    assert {d: [i for _, x in sorted(v) for i in x] for d, v in found.items()} == docs
    assert tokens / (1024 * len(rows)) > 0.98


def brute_fill(lengths, capacity):
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums if s + x <= capacity}
    return max(sums)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=30), st.integers(1, 60))
def test_closest_fill(lengths, capacity):
    taken = packing.closest_fill(Counter(lengths), capacity)
    assert all(n <= lengths.count(x) for x, n in taken.items())
    assert sum(x * n for x, n in taken.items()) == brute_fill(lengths, capacity)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_bins_hold_every_piece_once(lengths):
    for fill in packing.METHODS.values():
        bins = fill(lengths, 50)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 50 for b in bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_decreasing_is_the_textbook_one(lengths):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - x)
        else:
            rooms.append(50 - x)
    got = [50 - sum(lengths[i] for i in b) for b in packing.best_fit_decreasing(lengths, 50)]
    assert sorted(got) == sorted(rooms)


def test_matrix_files(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet").repartition(3)
    packed = packing.pack_matrix(docs, *GPT)
    index = packing.write_matrix(packed, f"file://{tmp_path}/m").collect()
    assert len(index) == 3 and len(list((tmp_path / "m").iterdir())) == 10
    rows, got = packed.collect(), Counter()
    for r in index:
        ids, places, ends = packing.read_matrix(f"file://{tmp_path}/m", r["file"], r["capacity"])
        assert len(ids) == len(places) == len(ends) == r["n_sequences"] and sum(int(e[-1]) for e in ends) == r["n_tokens"]
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        for one, place, end in zip(ids, places, ends, strict=True):
            assert all(place[a] == 0 and place[b - 1] == b - a - 1 for a, b in zip(end[:-1], end[1:], strict=True))
            got[one.tobytes(), tuple(end.tolist())] += 1
    assert got == Counter((bytes(r["input_ids"]), tuple(r["cu_seqlens"])) for r in rows)
    assert packing.write_matrix(packed.limit(0), f"file://{tmp_path}/none").collect() == []


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "decimal(5,0)", "string", "date"])
def test_packing_with_ids_of_other_types(spark, kind):
    of = "cast('2024-01-02' as date)" if kind == "date" else f"cast(7 as {kind})"
    df = spark.sql(f"select {of} as doc_id, 'a b c' as text union all select null, null")
    for r in packing.pack_pieces(df, *GPT).collect():
        assert (r["doc_id"] is None) == (r["doc_tokens"] == 1)
    assert {len(r["doc_ids"]) for r in packing.pack_matrix(df, *GPT).repartition(1).collect()} <= {1, 2}


# rollups


def test_rollup_of_deltas(spark, data, tmp_path, plain):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang", "source")
    rollup = rollups.Rollup(spark, f"file://{tmp_path}/r")
    kinds = {"v1": GPT}
    assert rollup.totals().count() == 0
    assert rollup.apply("one", docs, kinds) and not rollup.apply("one", docs, kinds)
    rows = docs.collect()
    gone, revised = rows[:10], rows[10:20]
    changes = [(*r, -1) for r in gone] + [(*r, -1) for r in revised] + [(r[0], (r[1] or "") + " more", r[2], r[3], 1) for r in revised]
    rollup.apply("two", spark.createDataFrame(changes, "doc_id long, text string, lang string, source string, sign int"), kinds)
    assert rollup.batches() == ["one", "two"]
    want = defaultdict(lambda: [0, 0, 0, 0])
    for r in rows[20:] + [type(rows[0])(doc_id=r[0], text=(r[1] or "") + " more", lang=r[2], source=r[3]) for r in revised]:
        t = r["text"] or ""
        for k, v in enumerate((1, len(plain.encode(t, add_special_tokens=False).ids), len(t), len(t.encode()))):
            want[r["source"], r["lang"], "v1"][k] += v
    assert {tuple(r)[:3]: list(r)[3:] for r in rollup.totals().collect()} == dict(want)


def test_rollup_retries_and_odd_rows(spark, tmp_path):
    rollup = rollups.Rollup(spark, f"file://{tmp_path}/r")
    df = spark.createDataFrame([("x y", None, "s", 1, 9), (None, "en", "s", 1, 9), ("x y", None, "s", 1, 9), ("z", "en", "s", None, 9)], "text string, lang string, source string, sign int, n_tokens int")
    (tmp_path / "r" / "attempt-1").mkdir(parents=True)
    (tmp_path / "r" / "attempt-1" / "part-0.parquet").write_bytes(b"left by a job that died")
    assert rollup.batches() == []
    assert rollup.apply("b", df, {"v": GPT})
    assert {tuple(r) for r in rollup.totals().collect()} == {("s", None, "v", 2, 4, 6, 6), ("s", "en", "v", 1, 0, 0, 0)}
    with pytest.raises(ValueError):
        rollup.apply("../x", df, {"v": GPT})


def test_rollup_writers_with_one_id(spark, tmp_path):
    rollup = rollups.Rollup(spark, f"file://{tmp_path}/r")
    df = spark.createDataFrame([("x y", "en", "s")], "text string, lang string, source string")
    other = rollups.Rollup(spark, f"file://{tmp_path}/r")
    assert rollup.apply("b", df, {"v": GPT})
    other.committed = lambda batch: False  # it looked before the first one had committed
    assert not other.apply("b", df.unionByName(df), {"v": GPT})
    assert [r["n_docs"] for r in rollup.totals().collect()] == [1]
    assert sorted(p.name for p in (tmp_path / "r").iterdir()) == ["batch=b"]


def test_rollup_compaction(spark, tmp_path):
    rollup = rollups.Rollup(spark, f"file://{tmp_path}/r")
    schema = "text string, lang string, source string, sign int"
    assert not rollup.compact()
    rollup.apply("a", spark.createDataFrame([("x" * 300_000, "en", "s", 1), ("y z", "en", "t", 1)], schema), {"v": GPT})
    rollup.apply("none", spark.createDataFrame([], schema), {"v": GPT})
    assert rollup.compact() and not rollup.compact()
    rollup.apply("b", spark.createDataFrame([("y z", "en", "t", -1), ("y", "en", "s", 1)], schema), {"v": GPT})
    want = {tuple(r) for r in rollup.totals().collect()}
    assert {r[:2] + r[3:4] for r in want} == {("s", "en", 2)} and {r[5] for r in want} == {300_001}
    assert rollup.compact()
    rollup.prune()
    assert not rollup.apply("a", spark.createDataFrame([("x", "en", "s", 1)], schema), {"v": GPT})
    assert {tuple(r) for r in rollup.totals().collect()} == want and rollup.batches() == ["a", "b", "none"]


def test_rollup_query(spark, data, plain, tik):
    """Both vocabularies by their libraries, over what the batches leave."""
    import re

    rows, first = spark.read.parquet(f"{data}/documents.parquet").collect(), {}
    for r in rows:
        if r["text"] is not None:
            first[r["text"]] = min(r["doc_id"], first.get(r["text"], r["doc_id"]))
    want = defaultdict(lambda: [0, 0, 0, 0])
    n_masked = 0
    for r in rows:
        if r["text"] is not None and first[r["text"]] < r["doc_id"]:
            continue
        t = re.sub(queries.EMAIL, "<email>", r["text"] or "")
        n_masked += t != (r["text"] or "")
        for name, n in (("byte_bpe_50k", len(plain.encode(t, add_special_tokens=False).ids)), ("byte_bpe_multi_50k", len(tik.encode_ordinary(t)))):
            for k, v in enumerate((1, n, len(t), len(t.encode()))):
                want[r["source"], r["lang"], name][k] += v
    assert n_masked and sum(v[0] for v in want.values()) < 2 * len(rows)
    assert {tuple(r)[:3]: list(r)[3:] for r in queries.op3_token_rollup(spark, data).collect()} == dict(want)
