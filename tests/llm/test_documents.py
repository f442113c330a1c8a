from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from sieveline.llm import components, html_text, near_dedup, quality, queries, suffix_dedup, topk
from sieveline.llm.common import Scratch, windows_hash

ODD = [None, "", " \n\t ", "word", "two words", "a a a a a a a a a a a a a a a a a a a a a a", "x" * 100_000, " ", "same text here", "same text here", "SAME Text here"]


def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


# near duplicates


def brute_components(sets: dict, percent: int = 80) -> dict:
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in seen[s])
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            seen[s].append(i)
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_equal_brute_force(spark, data, n):
    rows = documents(spark, data).collect()
    sets = {r["doc_id"]: near_dedup.shingles(near_dedup.words_of(r["text"] or ""), n) for r in rows}
    want = brute_components(sets)
    got = near_dedup.near_duplicates(documents(spark, data), n_words=n).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_near_duplicates_odd_rows(spark):
    rows = [(i, t, i) for i, t in enumerate(ODD)] + [(None, "same text here", 1), (8, "same text here", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __kept long")
    got = near_dedup.near_duplicates(df, n_words=2).collect()
    assert len(got) == len(rows)
    of = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert [of[i]["n_shingles"] for i in range(4)] == [0, 0, 0, 1]
    assert {i: of[i]["component_id"] for i in range(11)} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 8, 10: 8}
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]
    kept = near_dedup.filtered(df, n_words=2)
    assert kept.columns == df.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter([0, 1, 2, 3, 4, 5, 6, 7, 8, 8, None])
    assert near_dedup.near_duplicates(df.limit(0)).collect() == []


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        words = list(base)
        for at in rng.integers(0, 200, 4):
            words[at] = f"n{i}x{at}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"o{i}y{j}" for j in range(60))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: near_dedup.shingles(near_dedup.words_of(t), 2) for i, t in rows}
    want = brute_components(sets)
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, n_words=2).collect()} == want


def test_star_of_near_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(0, " ".join(f"w{i}" for i in range(201)))]
    for i in range(1, 1001):  # each change of a word changes two shingles: 0.82 like the base, 0.67 like each other
        words = rows[0][1].split()
        for at in rng.choice(np.arange(1, 199, 3), 10, replace=False):
            words[at] = f"n{i}x{at}"
        rows.append((i, " ".join(words)))
    sets = {i: near_dedup.shingles(near_dedup.words_of(t), 2) for i, t in rows}
    assert all(100 * len(sets[0] & s) >= 80 * len(sets[0] | s) for s in sets.values())  # so all are one component
    df = spark.createDataFrame(rows, "doc_id long, text string")
    apart = [r["doc_id"] for r in near_dedup.near_duplicates(df, n_words=2).collect() if r["component_id"] != 0]
    assert len(apart) == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, links):
    parent = {i: i for i in range(31)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    want = {i: root(i) for pair in links for i in pair if pair[0] != pair[1]}
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    assert {r["node"]: r["component"] for r in components.components(df, Scratch(spark, "test")).collect()} == want


def test_long_chain(spark):
    df = spark.range(2000).selectExpr("id as a", "id + 1 as b").repartition(8)
    assert {r["component"] for r in components.components(df, Scratch(spark, "test")).collect()} == {0}


# repeated passages


def covered(rows, n=50):
    """Words in windows that another document has."""
    words = {i: (t or "").encode().split() for i, t in rows}
    seen = defaultdict(set)
    for i, w in words.items():
        for p in range(len(w) - n + 1):
            seen[tuple(w[p : p + n])].add(i)
    out = {}
    for i, w in words.items():
        hit = {p + k for p in range(len(w) - n + 1) if len(seen[tuple(w[p : p + n])]) > 1 for k in range(n)}
        if hit:
            out[i] = hit
    return out


def spans(got):
    out = defaultdict(set)
    for r in got:
        out[r["doc_id"]] |= set(range(r["start_word"], r["start_word"] + r["n_words"]))
    return dict(out)


def test_repeated_passages_equal_brute_force(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, data).collect()]
    assert spans(queries.op6_sparse_suffixes(spark, data).collect()) == covered(rows)


def planted(seed=3, n=60):
    rng = np.random.default_rng(seed)
    fresh = lambda k: [f"w{x}" for x in rng.integers(0, 10**9, k)]
    shared = [fresh(k) for k in (50, 51, 75, 120, 400, 49)]
    rows = []
    for i in range(n):
        words = fresh(rng.integers(0, 60))
        for s in shared:
            if rng.random() < 0.4:
                words += s + fresh(rng.integers(0, 30))
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("group", [20_000, 5])
def test_planted_passages(spark, group):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = spans(suffix_dedup.repeated_passages(df, suffix_dedup.Sparse(group=group)).collect())
    want = covered(rows)
    assert all(got.get(i, set()) <= want.get(i, set()) for i in range(60))
    missed = sum(len(want[i] - got.get(i, set())) for i in want)
    assert missed == 0 if group > 100 else missed <= 0.02 * sum(map(len, want.values()))


def test_passages_told_apart_by_what_precedes(spark):
    rng = np.random.default_rng(4)
    fresh = lambda k: [f"w{x}" for x in rng.integers(0, 10**9, k)]
    boilerplate, lines = fresh(40), [fresh(12) for _ in range(60)]
    rows = [(i, " ".join(fresh(30) + lines[i // 2] + boilerplate + fresh(30))) for i in rng.permutation(120).tolist()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert spans(suffix_dedup.repeated_passages(df).collect()) == covered(rows)


def test_group_size_changes_nothing(spark):
    df = spark.createDataFrame(planted(), "doc_id long, text string")
    few, many = (sorted(map(tuple, suffix_dedup.repeated_passages(df, suffix_dedup.Sparse(group=g)).collect())) for g in (20_000, 5))
    assert spans(suffix_dedup.repeated_passages(df, suffix_dedup.Sparse(group=1)).collect()) == covered(planted())
    assert few == many


def test_words_whose_hashes_agree_in_half_are_told_apart(spark):
    """Three pairs of words agree in 32 bits of their hashes; with 47 words before them they aren't a shared passage."""
    start = [f"z{i}" for i in range(47)]
    rows = [(1, " ".join([*start, "w57212", "w22101", "w81646"])), (2, " ".join([*start, "w67677", "w77280", "w90278"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for group in (1, 5):
        assert suffix_dedup.repeated_passages(df, suffix_dedup.Sparse(group=group)).collect() == []
    assert sorted(map(tuple, suffix_dedup.deduplicated(df).collect())) == rows


def test_long_words_and_markers_in_contexts(spark):
    long, near = "x" * 300 + "a", "x" * 300 + "b"
    start = [f"z{i}" for i in range(47)]
    marked = "\0" + suffix_dedup.xxhash.xxh3_128_digest(long.encode()).hex()
    rows = [(1, " ".join([*start, long, "\0q", "e"])), (2, " ".join([*start, near, "\0q", "e"])), (3, " ".join([*start, long, "\0q", "e"])), (4, " ".join([*start, marked, "\0q", "e"]))]
    got = spans(suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == {1: set(range(50)), 3: set(range(50))}


def test_a_document_of_five_million_words_twice(spark):
    text = F.expr("concat_ws(' ', transform(sequence(1, 5000000), i -> concat('w', i % 3999999)))")
    df = spark.range(3).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2, text).otherwise("short").alias("text")).repartition(3)
    got = sorted(map(tuple, suffix_dedup.repeated_passages(df).collect()))
    assert got == [(0, 0, 5_000_000, 0, 1), (1, 0, 5_000_000, 5_000_000, 0)]


def test_deduplicated_keeps_each_passage_once(spark):
    rows = planted(5) + [(100, None), (101, ""), (102, "short text"), (None, "no id " * 60)]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, n_chars long, __cuts string")
    out = suffix_dedup.deduplicated(df)
    assert out.columns == ["doc_id", "text", "n_chars", "__cuts"]
    left = out.collect()
    assert covered([(r["doc_id"], r["text"]) for r in left if r["doc_id"] is not None]) == {}
    before = {w for _, t in rows for w in (t or "").split()}
    assert {w for r in left for w in (r["text"] or "").split()} == before  # nothing is lost altogether
    assert all(r["n_chars"] == len(r["text"]) for r in left if r["text"] is not None)
    assert {r["doc_id"] for r in left} >= {100, 101, 102, None}


def test_suffix_edge_cases(spark):
    long = " ".join(f"z{i}" for i in range(70))
    rows = [(i, t) for i, t in enumerate(ODD)] + [(20, long), (21, long), (21, long), (22, "same " * 500), (23, "same " * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = spans(suffix_dedup.repeated_passages(df).collect())
    assert got[20] == got[21] == set(range(70)) and got[22] == set(range(500)) and got[23] == set(range(300))
    assert set(got) == {20, 21, 22, 23}
    assert suffix_dedup.repeated_passages(df.limit(0)).collect() == []


def test_repeats_within_a_document(spark):
    block = " ".join(f"z{i}" for i in range(80))
    df = spark.createDataFrame([(1, f"{block} middle {block} end {block}"), (2, "same " * 200)], "doc_id long, text string")
    assert spans(suffix_dedup.repeated_passages(df, across=True).collect()) == {}
    assert spans(suffix_dedup.repeated_passages(df, across=False).collect())[1] == set(range(242)) - {80, 161}
    out = {r["doc_id"]: r["text"].split() for r in suffix_dedup.deduplicated(df, across=False).collect()}
    assert out[1] == [*block.split(), "middle", "end"] and 0 < len(out[2]) < 200


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=120), st.integers(1, 40))
def test_window_hashes_and_minimisers(values, n):
    h = np.array(values, np.uint64) * np.uint64(7919)
    got = windows_hash(h, n)
    assert len(got) == max(0, len(values) - n + 1)
    for i in range(len(got)):
        for j in range(i):
            assert (got[i] == got[j]) == (values[i : i + n] == values[j : j + n])
    s = suffix_dedup.Sparse()
    at = set(suffix_dedup.kept_positions(h, s).tolist())
    grams = windows_hash(h, s.gram)
    want = {p for a in range(len(grams) - s.window + 1) for p in range(a, a + s.window) if grams[p] == grams[a : a + s.window].min()}
    assert at == ({p for p in want if p <= len(h) - s.key} if len(h) >= s.min_words else set())


@pytest.mark.parametrize("run", [near_dedup.near_duplicates, suffix_dedup.repeated_passages, lambda df: topk.search(df, df["doc_id"].isNotNull(), id_col="doc_id", vector_col="text")])
def test_ids_are_integers(spark, run):
    with pytest.raises(TypeError):
        run(spark.createDataFrame([("a", "some text")], "doc_id string, text string"))


# quality


def slow_statistics(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", "#", " ", " ", "\n", " ", " ", "\x0b", "|x", "\x1c"]), max_size=80).map("".join))
def test_statistics(text):
    assert quality.text_statistics(text) == slow_statistics(text)


FLOOR = np.diag(np.square(list(quality.STATISTICS.values())))


def slow_mcd(x: np.ndarray, mcd: quality.MCD, trials: int = 60):
    """Distances to the least determinant found from many random subsets, with exact nearest rows: no bins, no sums."""
    rng, best = np.random.default_rng(3), (np.inf, None)
    h, factor = int(np.ceil(mcd.support * len(x))), quality.consistency(mcd.support)
    for _ in range(trials):
        keep = rng.choice(len(x), min(len(x), 6), replace=False)
        before = np.inf
        while True:
            mean, scatter = x[keep].mean(axis=0), np.cov(x[keep].T, bias=True) * factor + FLOOR
            now = np.linalg.slogdet(scatter)[1] if len(keep) == h else np.inf
            if now < best[0]:
                best = now, (mean, np.linalg.inv(scatter))
            if len(keep) == h and before - now < 1e-9:
                break
            before = now
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(scatter), x - mean)
            keep = np.argsort(d, kind="stable")[:h]
    mean, inverse = best[1]
    return best[0], np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)


def model_of(spark, x: np.ndarray, mcd: quality.MCD):
    """Log determinant and distances by the operator, for rows of one group."""
    rows = spark.createDataFrame([("a", "a", "a", *map(float, v)) for v in x], "g2 string, g1 string, g0 string, " + ", ".join(f"x{i} double" for i in range(5)))
    m = quality.robust_model(rows, mcd, Scratch(spark, "test")).where("level = 0").first()
    inverse = np.zeros((5, 5))
    for i in range(5):
        for j in range(i, 5):
            inverse[i, j] = inverse[j, i] = m[f"w{i}{j}"]
    away = x - np.array([m[f"m{i}"] for i in range(5)])
    return m["logdet"], np.einsum("ij,jk,ik->i", away, inverse, away)


@pytest.mark.parametrize("away", [8, 30])
def test_outliers_in_a_cluster_are_rejected(spark, away):
    """A fifth of the rows close together, far from the others: the plain estimate would take them in."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 5)) * 3
    x[:400] = np.array([away * 3, 0, 0, 0, 0]) + rng.normal(size=(400, 5)) * 0.3
    mcd = quality.MCD()
    logdet, d = model_of(spark, x, mcd)
    assert (d[:400] > mcd.cutoff).all() and (d[400:] <= mcd.cutoff).all()
    least, want = slow_mcd(x, mcd)
    assert logdet == pytest.approx(least, abs=0.05)
    assert np.corrcoef(d, want)[0, 1] > 0.999 and np.median(d[400:] / want[400:]) == pytest.approx(1, abs=0.05)


def test_consistency_factor():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400_000, 5))
    d = (x**2).sum(axis=1)
    near = x[d <= np.quantile(d, 0.75)]
    assert quality.consistency(0.75) == pytest.approx(1 / near.var(axis=0).mean(), rel=0.01)
    assert quality.consistency(1.0) == 1.0 and quality.chi2_share(6.626, 5) == pytest.approx(0.75, abs=1e-3)


def test_quality_equals_brute_force(spark, data):
    rows = documents(spark, data).collect()
    mcd = quality.MCD(least_rows=40)
    got = {r["doc_id"]: r for r in quality.quality(documents(spark, data), mcd).collect()}
    stats = {r["doc_id"]: slow_statistics(r["text"] or "") for r in rows}
    lines = {r["doc_id"]: 1 + (r["text"] or "").count("\n") for r in rows}
    bad = {i: s[0] < 20 or 100 * s[4] > 30 * s[0] for i, s in stats.items()}
    vec = {i: [np.log1p(s[0]), (s[1] + 250) / (s[0] + 50), np.log1p(s[2] / (s[0] + 50)), s[3] / (lines[i] + 10), s[4] / (s[0] + 50)] for i, s in stats.items()}
    of = {r["doc_id"]: (r["lang"], r["source"]) for r in rows}
    good = [i for i in stats if not bad[i]]
    d = {}
    for level in (lambda i: 0, lambda i: of[i][0], lambda i: of[i]):  # the narrowest group that is large enough counts
        for g in {level(i) for i in good}:
            members = [i for i in good if level(i) == g]
            if g == 0 or len(members) >= 40:
                d |= dict(zip(members, slow_mcd(np.array([vec[i] for i in members]), mcd)[1], strict=True))
    near = {}
    for i, s in stats.items():
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (*s, bad[i])
        if bad[i]:
            assert not r["kept"]
        else:
            near[i] = (r["distance2"], d[i])
            assert r["kept"] == (r["distance2"] <= mcd.cutoff)
            if not 0.8 < d[i] / mcd.cutoff < 1.25:  # the search by random subsets ends elsewhere by a little
                assert r["kept"] == (d[i] <= mcd.cutoff)
    ours, theirs = np.array(list(near.values())).T
    assert np.corrcoef(np.log1p(ours), np.log1p(theirs))[0, 1] > 0.98


def test_quality_odd_rows(spark):
    rows = [(i, t, None if i % 2 else "en", None, 1) for i, t in enumerate(ODD)] + [(None, "word " * 3, "en", "s", 1)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    got = quality.quality(df).collect()
    assert len(got) == len(rows) and not any(r["kept"] for r in got if (r["n_words"] or 0) < 20)
    assert quality.quality(df.limit(0)).collect() == []
    assert quality.filtered(df).columns == df.columns
    fine = " ".join(f"plain{i}" for i in range(60))
    rows = [(1, "bad text", "en", "s", 1), (1, fine, "en", "s", 2), (1, fine, "en", "s", 2), (None, "bad text", "en", "s", 3), (None, fine, None, "s", 4), (2, "word " * 30, "en", "s", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, __id int")
    assert sorted(r["__id"] for r in quality.filtered(df).collect()) == [2, 2, 4]  # each row by its own verdict


# search


def brute_topk(ids, vectors, k=5):
    v = np.floor(256 * vectors.astype(float))
    out = []
    for i in np.flatnonzero(ids % 50 == 0):
        s = v @ v[i]
        s[ids == ids[i]] = -np.inf
        order = np.lexsort((ids, -s))[:k]
        out += [(int(ids[i]), n + 1, int(ids[j]), int(s[j])) for n, j in enumerate(order) if np.isfinite(s[j])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [16_384, 100])
def test_topk_equals_brute_force(spark, data, monkeypatch, shard_rows):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "LEAF", 16)
    rows = spark.read.parquet(f"{data}/embeddings.parquet").toPandas().sort_values("vec_id")
    got = sorted(tuple(r) for r in queries.op5_ball_tree(spark, data).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute_topk(rows["vec_id"].to_numpy(), np.vstack(rows["embedding"].to_numpy()))


def test_topk_ties_and_odd_vectors(spark):
    from pyspark.sql import functions as F

    rows = [(i, [1.0, 2.0], 0) for i in range(400)] + [(401, None, 0), (402, [1.0, None], 0), (403, [float("nan"), 1.0], 0), (404, [float("inf"), 1.0], 0), (405, [], 0), (406, [1.0], 0), (None, [9.0, 9.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = topk.search(df, F.col("vec_id") % 100 == 0).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in got if r["query_id"] == 0} == {(0, k, k) for k in range(1, 6)}
    assert {r["vec_id"] for r in got if r["query_id"] == 200} == {0, 1, 2, 3, 4}
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.search(few, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 131072)]
    assert topk.search(few.limit(0), F.lit(True)).collect() == []


def test_search_visits_few_shards_of_clusters(spark, monkeypatch):
    """30 clusters of 200 vectors in shards of 100: a query goes to the shards of its cluster and few others, and nothing is lost."""
    import pandas as pd

    seen, table = {}, Scratch.table

    def kept(self, df, name, **options):
        seen[name] = table(self, df, name, **options)
        return seen[name]

    monkeypatch.setattr(topk, "SHARD_ROWS", 100)
    monkeypatch.setattr(Scratch, "table", kept)
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(30, 16))[np.arange(6_000) % 30] + rng.normal(size=(6_000, 16)) * 0.02).astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(6_000), "embedding": list(vectors)}))
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 50 == 0).collect())
    assert got == brute_topk(np.arange(6_000), vectors)
    visits = seen["queries"].count() + seen["sent2"].count() + seen["sent3"].count()
    assert visits <= 0.35 * seen["queries"].count() * seen["trees"].count()


def big_topk(rows, asks, k=5, scale=256):
    """By whole numbers of any size, all rows against all queries of their length."""
    from fractions import Fraction

    held = [(i, [(Fraction(x) * scale).__floor__() for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in held if i % asks == 0}):
        asked = min((v for i, v in held if i == q), key=lambda v: (len(v), v))
        scores = sorted((-sum(x * y for x, y in zip(asked, v, strict=True)), i) for i, v in held if i != q and len(v) == len(asked))
        out += [(q, n + 1, i, max(-(2**63) + 1, min(2**63 - 1, -s))) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [16_384, 20])
def test_topk_of_large_components(spark, monkeypatch, shard_rows):
    from pyspark.sql import functions as F

    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "LEAF", 4)
    rng = np.random.default_rng(4)
    rows = [(0, [1e6, 1 / 256]), (1, [1e6, 0.0]), (2, [1e6, 1 / 256]), (3, [1e6, -1 / 256]), (5, []), (10, []), (15, [1.5]), (20, [2.0]), (21, [-3.0])]
    rows += [(100 + i, (rng.normal(size=2) * 10.0 ** rng.integers(-2, 9)).tolist()) for i in range(60)]
    rows += [(200 + i, (rng.normal(size=2) * 10.0 ** rng.integers(30, 300)).tolist()) for i in range(60)]
    rows += [(300, [3e38, 3e38]), (301, [-3e38, 3e38]), (302, [1.7e308, 1.7e308]), (303, [-1.7e308, 1e-300]), (305, [2.0**53 + 2, 1.0]), (306, [2.0**53, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 5 == 0).collect())
    assert got == big_topk(rows, 5)
    assert [r[2:] for r in got if r[:2] == (0, 1)] != []


@given(st.lists(st.integers(-(2**90), 2**90), min_size=1))
def test_wide_scores_sort(scores):
    assert [s for _, s in sorted((topk.sortable(s), s) for s in scores)] == sorted(scores, reverse=True)
    assert all(topk.wide_value(topk.wide_key(s)) == s for s in scores)


# pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">X</a></ul></nav><div class="cookie-notice">We use cookies on this site to make it better for all of you.</div>
<div id="wrap"><div class="sidebar"><p>Other stories that you may like to read today</p></div><div class="post"><h2>Head &amp; title</h2>
<p>First  paragraph with <b>bold</b>&nbsp;and <a href="#">a link</a> and quite some words that make it dense.<p>Second&#33; paragraph, unclosed, which also has quite a number of words in it.
<ul><li>one<li>two</ul><p>Short.</p></div><section class="comments"><p>A reader says that this is a very long comment, longer than the article itself, on and on.</p></section></div>
<form><label>Mail</label><input></form><footer>&copy; all rights reserved by the people who own this</footer></body></html>"""


def test_article_of_a_page():
    assert html_text.main_text(PAGE) == "Head & title\nFirst paragraph with bold and a link and quite some words that make it dense.\nSecond! paragraph, unclosed, which also has quite a number of words in it.\none\ntwo\nShort."


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("   ", ""), ("<html></html>", ""), ("just text &lt;b&gt;", "just text <b>"), ("<p>a<br>b</p><p>c", "a b\nc"), ("<article><p>x</p></article>", "x"), ("<p>open <b>bold <i>it", "open bold it"),
    ('<div class="with-sidebar"><article><p>x</p></article></div>', "x"), ('<div class="comments"><p>only this</p></div>', "only this"), ('<div id="topNav">a</div><p>text</p>', "text"), ("<script>never closed", ""), ("<!-- a <p>b</p> --><p>c</p>", "c"), ("<p>1 < 2 &amp;&amp; 3 > 2</p>", "1 < 2 && 3 > 2"), ("</div></p>text", "text"), ("<div><p>a</p>b<p>c</p></div>", "a\nb\nc"),
])
def test_small_pages(page, text):
    assert html_text.main_text(page) == text


# what the title says, and nothing else, tells the article here: names and kinds of elements only weigh
LOST = [
    ("<p title=it's>First para</p><p>Second para isn't lost</p><p>Third</p>", "First para\nSecond para isn't lost\nThird"),
    ('<p title="a hidden gem">First.</p><p data-hidden="no">Second.</p><p hidden>Third</p>', "First.\nSecond."),
    ('<p style="color:red">First.</p><p style="color: red; DISPLAY : none !important">x</p><p aria-hidden="true">y</p><p aria-hidden="false" style="display:block;visibility:visible">Second.</p><p style="visibility:hidden">z</p>', "First.\nSecond."),
    ('<article><p>Text of an article.</p><div class="social-history"><p>A</p></div><p class="notice-of-intent">B</p><section id="ad-hoc-networks">C</section><div class="share-buttons">D</div></article>', "Text of an article.\nA\nB\nC"),
    ('<body><form id="aspnetForm"><article><p>In a form</p><select><option>x</option></select></article></form></body>', "In a form"),
    ('<body><form id="aspnetForm"><div><p>In a form</p><button>Go</button></div></form></body>', "In a form"),
    ("<article><p>One article with text.</p></article><div>x</div><article><p>Another article with text.</p></article>", "One article with text.\nAnother article with text."),
    ('<body><div class="content no-sidebar"><p>the article</p></div></body>', "the article"),
    ('<p>short</p><div class="commentary"><p>a commentary on it</p></div>', "short\na commentary on it"),
    ("<nav>a</nav><article>Hi</article><footer>A footer that is longer than the article, all rights reserved</footer>", "Hi"),
    ('<article><p>Hello</p><section class="comments"><article class="comment"><p>A comment that is longer than the article itself.</p></article></section></article>', "Hello"),
    ('<nav>a</nav><div class="ad">Buy</div><article></article><footer>x</footer>', ""),
]


@pytest.mark.parametrize(("page", "text"), LOST)
def test_names_and_kinds_only_weigh(page, text):
    assert html_text.main_text(page) == text


def test_densities_by_hand():
    import math

    body = html_text._body(html_text.parse(f"<body><div id=a><p>{'x' * 100}</p><p>{'y' * 50}<a>{'z' * 10}</a></p></div><div><a>{'l' * 20}</a><a>{'m' * 20}</a></div></body>"))
    html_text.densities(body)
    (one, other), share = body.items, 50 / 200
    first, second = one.items

    def by_hand(c, t, lc, lt):
        b = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        return c / t * max(0.0, math.log(c / max(lc, 1) * t / max(lt, 1)) / max(1.0, math.log(b)))

    assert (body.chars, body.tags, body.link_chars, body.link_tags) == (200, 7, 50, 3)
    assert first.density == pytest.approx(100 * math.log(100) / max(1, math.log(math.log(25 + math.e))))
    assert second.density == pytest.approx(60 * math.log(6) / max(1, math.log(math.log(60 / 50 * 10 + 15 + math.e))))
    assert (one.density, other.density) == pytest.approx((by_hand(160, 3, 10, 1), 0.0))
    assert one.total == pytest.approx(first.density + second.density)
    assert body.total == pytest.approx(one.density)
    assert html_text._chosen(body) == ({id(one)}, {id(one), id(body)})


def test_threshold_of_the_body_path():
    long, short = "word " * 60, "word " * 25
    page = f"<body><ul><li><a href=x>one</a><li><a href=y>two</a></ul><h1>{'t' * 60}</h1><div><section><p>{long}</p><p>{long}</p><p>{long}</p></section><section><p>{short}</p><p>{short}</p></section></div><div><span>a</span> <span>b</span> <a href=z>c</a></div></body>"
    assert html_text.main_text(page).split("\n") == ["t" * 60, *[long.strip()] * 3, *[short.strip()] * 2]


def slow_text(body):
    """The module's definition read literally, on a tree (tag, children) without marks: every figure by a walk of its own."""
    import math

    chars = lambda x: sum(c not in " \n" for c in x)
    every = lambda n: [n] + [y for x in n[1] if not isinstance(x, str) for y in every(x)]
    total_chars = lambda n: sum(chars(x) if isinstance(x, str) else total_chars(x) for x in n[1])
    linked = lambda n: total_chars(n) if n[0] == "a" else sum(linked(x) for x in n[1] if not isinstance(x, str))
    prior = lambda n: 0.002 if n[0] in ("nav", "aside", "footer") else 1.0
    share = linked(body) / max(total_chars(body), 1)

    def parents(n, above=()):
        yield n, above
        for x in reversed(n[1]):  # of equal sums the outer, then the later node
            if not isinstance(x, str):
                yield from parents(x, (n, *above))

    way = {id(n): above for n, above in parents(body)}
    weight = lambda n: math.prod(prior(x) for x in (n, *way[id(n)]) if x is not body)

    def formula(c, t, lc, lt, share=share):
        if c == 0:
            return 0.0
        b = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        return c / max(t, 1) * max(0.0, math.log((c / max(lc, 1)) * (max(t, 1) / max(lt, 1))) / max(1.0, math.log(b)))

    density = lambda n: weight(n) * formula(total_chars(n), len(every(n)) - 1, linked(n), sum(x[0] == "a" for x in every(n)))
    own = lambda n: sum(chars(x) for x in n[1] if isinstance(x, str))

    def sums(n):
        inside = own(n) if n[0] == "a" else 0
        return sum(density(x) for x in n[1] if not isinstance(x, str)) + weight(n) * formula(own(n), 1, inside, min(inside, 1))

    found = [(sums(n), n) for n, _ in parents(body)]
    best = max(x for x, _ in found)
    core = next(n for x, n in found if x >= best * (1 - 1e-9))
    path = [core, *way[id(core)]]
    least = min(density(n) for n in path) * (1 - 1e-9)
    taken, alone = [core], []
    for child, node in zip(path, path[1:], strict=False):
        at = next(i for i, x in enumerate(node[1]) if x is child)
        for i, x in enumerate(node[1]):
            if not isinstance(x, str) and x is not child and prior(x) == 1:
                title = x[0] == "h1" and i < at and 2 * linked(x) < total_chars(x)
                if title or total_chars(x) and (density(x) >= least or sums(x) >= 0.2 * best * (1 - 1e-9)):
                    taken.append(x)
        if own(node) and weight(node) * formula(own(node), 1, 0, 0, 0.0) >= least:
            alone.append(node)
    held = lambda n, nodes: any(n is x for x in nodes)

    def text(n, inside):
        block = n[0] not in ("a", "b", "span") or (held(n, taken) and not inside)
        inside = inside or held(n, taken)
        out = "\0" if block else ""
        for x in n[1]:
            if isinstance(x, str):
                out += x if inside or held(n, alone) else ""
            elif not inside or prior(x) == 1 or held(x, path):
                out += text(x, inside)
        return out + ("\0" if block else "")

    blocks = [" ".join(b.split()) for b in text(body, False).split("\0")]
    return "\n".join(b for b in blocks if b)


def test_unmarked_pages_equal_slow_sums():
    """Trees by chance: links, lists, furniture by kind and texts of all lengths, nothing that marks the article."""
    import random
    import re

    chance = random.Random(13)
    words = lambda n: " ".join("x" * chance.randint(1, 9) + str(chance.randint(0, 10**6)) for _ in range(n))

    def inline():
        return [words(chance.choice([1, 3, 12, 40])), *([(chance.choice(["a", "a", "b", "span"]), [words(chance.choice([1, 2, 5]))]), " " + words(3)] if chance.random() < 0.5 else [])]

    def tree(depth):
        kind = chance.random()
        if depth == 0 or kind < 0.35:
            return (chance.choice(["p", "p", "p", "h1", "h2"]), inline())
        if kind < 0.5:
            return ("ul", [("li", [("a", [words(chance.randint(1, 4))])]) for _ in range(chance.randint(1, 6))])
        tag = chance.choice(["div", "div", "section", "nav", "aside", "footer"])
        return (tag, [*([words(chance.choice([1, 8]))] if chance.random() < 0.3 else []), *[tree(depth - 1) for _ in range(chance.randint(1, 5))]])

    shown = lambda n: n if isinstance(n, str) else f"<{n[0]}>{''.join(map(shown, n[1]))}</{n[0]}>"
    several = 0
    for _ in range(1_000):
        body = ("body", [tree(chance.randint(1, 4)) for _ in range(chance.randint(1, 6))])
        want = slow_text(body)
        assert html_text.main_text(f"<html>{shown(body)}</html>") == want, shown(body)
        several += 0 < len(want) < len(re.sub("<[^>]*>", "", shown(body))) / 2
    assert several > 100  # pages of which less than half is the article


def test_marks_change_little(spark, data):
    """Without its <article> tag, a page of the table keeps its article's paragraphs and none of its furniture."""
    for r in spark.read.parquet(f"{data}/pages.parquet").collect():
        want = html_text.main_text(r["html"]).split("\n")
        got = html_text.main_text(r["html"].replace("<article>", "<div>").replace("</article>", "</div>")).split("\n")
        assert max(want, key=len) in got and set(got) <= set(want)


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 20_000 + "deep") == "deep"
    assert len(html_text.main_text("<p>" + "word " * 200_000)) == 999_999


def test_pages_query(spark, data):
    import html
    import re

    rows = spark.read.parquet(f"{data}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.op4_text_density(spark, data).collect()}
    assert len(got) == len(rows)
    for r in rows:  # these pages mark their article, in blocks of p and h1
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", r["html"], re.DOTALL)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " ")))).strip() for x in re.split(r"</?(?:p|h1)>", body)]
        want = "\n".join(b for b in blocks if b)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (want, len(want))
    df = spark.createDataFrame([(1, None, None, "x")], "page_id long, url string, html string, text string")
    assert [tuple(r) for r in html_text.extract(df).collect()] == [(1, None, "", 0)]
    assert html_text.extract(df.limit(0)).collect() == []


# pipeline


def test_pipeline_stages(spark, data):
    docs = documents(spark, data)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "repeated_passages", "packing"]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = Scratch(spark, "test").table(stage(spark, docs, data), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "near_duplicates":
            sets = {i: near_dedup.shingles(near_dedup.words_of(t or ""), 5) for i, t in before.items()}
            roots = brute_components(sets)
            assert set(now) == {i for i in before if roots[i] == i}
        if name == "repeated_passages":
            assert covered(list(now.items())) == {}
        else:
            assert all(before[i] == t for i, t in now.items())
        before = now
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
    assert {r["doc_id"] for r in pieces} == set(before)
    assert {(r["doc_id"], r["start"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, data).collect()} == {(r["doc_id"], r["start"], r["ids_crc32"]) for r in pieces}


def test_medians_of_very_large_statistics(spark):
    """Beyond the even bins medians are known to a thousandth of a doubling, not cut off."""
    values = [10.0 ** (i % 9) * (1 + i / 100) for i in range(45)]
    rows = spark.createDataFrame([(*["g"] * len(quality._LEVELS), *[v] * len(quality._X)) for v in values], ", ".join([*[f"{g} string" for g in quality._LEVELS], *[f"{x} double" for x in quality._X]]))
    found = quality._middles(rows).first()
    median = sorted(values)[len(values) // 2]
    for i, floor in enumerate(quality.STATISTICS.values()):
        assert abs(found[f"c{i}"] - median) <= max(floor / quality.PER_FLOOR, median * 0.001)
