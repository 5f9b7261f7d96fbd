"""Lexical search, nearest vectors and whitening against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from docpack.llm import pivots, search, whitening
from tests.llm.helpers import ROWS, all_null, awkward, nothing

SF = "/root/testdata/sf0.001"


# -- ranked lexical search


def found_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, k=10):
    """``docs`` (key, text), ``items`` (key, text): the contract, pair by pair."""
    held = [(key, Counter(found_terms(text))) for key, text in docs]
    held = [(key, c, c.total()) for key, c in held if c]
    n, length = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for key, text in items:
        asked.setdefault(key, set()).update(found_terms(text))
    out = []
    for item, own in asked.items():
        scored = []
        for key, c, size in held:
            m = 10 + (90 * size * n) // length
            score = sum(int(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return out


def plain(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, x or 0) for x in r])


def test_terms():
    text = "Ab-cd É9_ﬁ\x00x\x7f日本 ŞTR\n" + "Q" * 5
    assert [t.decode() for part in search.terms(text) for t in part] == found_terms(text)
    assert list(search.terms(None)) == list(search.terms("")) == []
    long = "word " * 700_000
    parts = list(search.terms(long))
    assert len(parts) > 2 and sum(map(len, parts)) == 700_000 and {x for p in parts for x in p} == {b"word"}


ITEMS = [(1, "word3 WORD4 tail two"), (1, "boilerplate"), (2, None), (3, ""), (4, "nothing alike"), (None, "日本語 one y"), (5, "y"), (6, "line line line enough")]


@pytest.mark.parametrize("most", [200_000, 0])
def test_search_awkward(spark, most):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "'x' AS block", "'x' AS term", "1 AS bundle")
    got = search.ranked(awkward(spark).repartition(3), items, most_terms=most)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert plain(got.collect()) == plain(brute_force([(r[0], r[1]) for r in ROWS], ITEMS))


def test_search_many_blocks_and_bundles(spark):
    rng = np.random.default_rng(3)
    common = [f"c{k}" for k in range(30)]
    rare = [f"r{k}" for k in range(3000)]
    docs = [(k, " ".join([*rng.choice(common, int(rng.integers(1, 40))), *rng.choice(rare, int(rng.integers(0, 6)))])) for k in range(1500)]
    docs += [(5000 + k, "c1 c2 r7 r8") for k in range(600)]  # a group of copies, all of one score
    items = [(k, " ".join([*rng.choice(common, 6), *rng.choice(rare, 4)])) for k in range(150)] + [(999, "r7 r8 c1"), (1000, "c1")]
    got = search.ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(items, "item_id long, text string"))
    assert plain(got.collect()) == plain(brute_force(docs, items))


def test_search_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.ranked(nothing(spark), items).collect() == []
    assert search.ranked(all_null(spark), items).collect() == []
    assert search.ranked(awkward(spark), items.limit(0)).collect() == []
    assert search.ranked(awkward(spark), items.where("text IS NULL")).collect() == []


def test_search_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert plain(search.op13_ranked_search(spark, SF).collect()) == plain(brute_force(docs, items))


# -- nearest vectors


def vector_rows(n=900, d=12, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    x[: n // 3] = x[0] + 0.05 * rng.standard_normal((n // 3, d))  # a hot direction
    x[40:60] = x[40]  # ties
    x[100] *= 9
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    odd = [(10_000, None), (10_020, [0.0] * d), (10_040, [float("nan")] * d), (10_060, [1.0] * (d - 1) + [float("inf")]), (10_080, [1.0] * (d - 1)), (10_100, [1.0] * (d - 1) + [None]), (10_120, [])]
    return rows, odd + [(20, x[20].tolist()), (None, x[41].tolist())]  # a repeated row, a null key


def exact_nearest(rows, asked, k):
    x = np.array([v for _, v in rows])
    out = []
    for at, (key, v) in enumerate(rows):
        if asked(key):
            score = (np.array(v) * x).sum(1)
            best = sorted((c for c in range(len(rows)) if c != at), key=lambda c: (-score[c], rows[c][0] is None, rows[c][0] or 0))[:k]
            out += [(key, rank, rows[c][0], score[c]) for rank, c in enumerate(best, 1)]
    return out


def rounded(rows):
    return sorted(((q, r, v, round(s, 9)) for q, r, v, s in rows), key=str)


def test_all_rows_within_the_bound_are_exact(spark):
    rows, odd = vector_rows()
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS block", "'x' AS lane", "'x' AS score").repartition(5)
    got = pivots.nearest(df, "vec_id % 20 = 0", k=7, share=1.0)
    want = exact_nearest(rows + [r for r in odd if r[0] in (20, None)], lambda key: key is not None and key % 20 == 0, 7)
    assert rounded(map(tuple, got.collect())) == rounded(want)


def test_footrule():
    rng = np.random.default_rng(1)
    near = np.array([rng.permutation(30)[:8] for _ in range(50)])
    place = np.full((50, 30), 8)
    np.put_along_axis(place, near, np.arange(8)[None], 1)
    lists = pivots.inverted(near, 30)
    footrule = np.abs(place[:, None, :] - place[None]).sum(2)
    assert (8 * 9 - 2 * pivots.shared_places(lists, lists, 50, 50) == footrule).all()


@pytest.mark.parametrize("d, spread", [(8, 0.0), (32, 0.3), (128, 0.0), (200, 0.2)])
def test_the_share_follows_the_vectors(spark, d, spread):
    """More dimensions, or lengths that differ, ask for more candidates; recall stays."""
    rng = np.random.default_rng(d)
    x = rng.standard_normal((6000, d)) * np.exp(spread * rng.standard_normal((6000, 1)))
    rows = list(enumerate(x.tolist()))
    got = {}
    for q, _, v, _ in pivots.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), "vec_id % 100 = 0", k=20).collect():
        got.setdefault(q, set()).add(v)
    want = {}
    for q in range(0, 6000, 100):
        score = x @ x[q]
        score[q] = -np.inf
        want[q] = set(np.argsort(-score)[:20].tolist())
    assert set(got) == set(want) and sum(len(want[q] & got[q]) for q in want) >= 0.9 * 20 * len(want)


def test_pivots_differ():
    rows = np.repeat(np.eye(4), 5, axis=0)
    assert len(pivots.farthest_first(rows, 10)) == 4


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    path = f"/root/testdata/{sf}"
    got = {}
    for q, rank, v, s in pivots.op12_nearest_vectors(spark, path).collect():
        got.setdefault(q, {})[rank] = (v, s)
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = {}
    for q, _, v, _ in exact_nearest(rows, lambda key: key % 20 == 0, 20):
        want.setdefault(q, set()).add(v)
    assert set(got) == set(want) and all(sorted(x) == list(range(1, 21)) for x in got.values())
    assert sum(len(want[q] & {v for v, _ in got[q].values()}) for q in want) >= 0.95 * sum(map(len, want.values()))


def test_nearest_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    assert pivots.nearest(spark.createDataFrame([], schema), "vec_id % 20 = 0").collect() == []
    assert pivots.nearest(spark.createDataFrame([(0, None), (20, [0.0])], schema), "vec_id % 20 = 0").collect() == []
    assert pivots.nearest(spark.createDataFrame([(0, [1.0])], schema), "vec_id % 20 = 0").collect() == []
    two = spark.createDataFrame([(0, [1.0, 0.0]), (7, [0.5, 0.5])], schema)
    assert [tuple(r) for r in pivots.nearest(two, "vec_id % 20 = 0").collect()] == [(0, 1, 7, 0.5)]


# -- whitening


def check_whitened(rows, vectors):
    """Rows of ``op11`` against an eigendecomposition of the covariance that numpy forms."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    centred = x - s / n
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1]
    keep = int((values[:32] > 1e-9 * values[0]).sum())
    w = np.array([r["whitened"] for r in rows])
    assert w.shape == (n, keep)
    assert [r["n"] for r in rows] == [n] * n
    assert [r["deviation"] for r in rows] == ((n * x - s) ** 2).sum(1).tolist()
    assert np.allclose(rows[0]["explained"], values[:keep] / np.trace(cov), rtol=1e-9)
    axes = centred.T @ w / n / np.sqrt(values[:keep])  # what was projected on
    assert np.abs(cov @ axes - axes * values[:keep]).max() < 1e-9 * values[0]
    assert np.abs(np.linalg.norm(axes, axis=0) - 1).max() < 1e-9
    assert np.abs(w.T @ w / n - np.eye(keep)).max() < 1e-9 and rows[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("d, n, parts", [(64, 400, 3), (40, 300, 2), (5, 50, 1), (64, 20, 2), (90, 500, 4)])
def test_whitening(spark, d, n, parts):
    rng = np.random.default_rng(d)
    vectors = (rng.standard_normal((n, d)) * np.linspace(4, 0.1, d)).tolist()
    rows = list(enumerate(vectors))
    odd = [(-1, None), (-2, [float("nan")] * d), (-3, [1.0] * (d - 1)), (-4, [None] * d), (-5, [float("-inf")] * d), (-6, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS n", "'x' AS block").repartition(parts)
    got, found = whitening.whitened(df)
    assert found.residual <= 1000 * whitening.TOLERANCE
    check_whitened(sorted(got.collect(), key=lambda r: r["vec_id"]), vectors)


def test_whitening_of_a_hot_direction(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 64)) / 8
    x[:200] = x[0] * 40 + 0.01 * x[:200]
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got, _ = whitening.whitened(df)
    check_whitened(sorted(got.collect(), key=lambda r: r["vec_id"]), x)


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)]):
        got, found = whitening.whitened(spark.createDataFrame(rows, schema))
        assert got.collect() == [] and found.passes == 0
    got, _ = whitening.whitened(spark.createDataFrame([(1, [0.5, 0.5])] * 3 + [(None, [0.5, 0.5])], schema))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 4, 0, [], [], 0.0)] * 3 + [(None, 4, 0, [], [], 0.0)], key=str)


def test_whitening_query(spark):
    got = whitening.op11_whitening(spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert got.count() == 32 * vectors and got.agg({"component": "max"}).first()[0] == 32


def test_dominant_of_known_spectra():
    rng = np.random.default_rng(0)
    for values in (np.linspace(1, 2, 100), 10.0 ** -np.arange(80), np.r_[1e6, np.ones(99)], np.r_[5.0, 4.0, np.zeros(70)]):
        q = np.linalg.qr(rng.standard_normal((len(values),) * 2))[0]
        a = (q * values) @ q.T
        got = whitening.dominant(lambda x, a=a: a @ x, len(values), 8)
        assert np.allclose(got.values, np.sort(values)[::-1][:8], atol=1e-11 * values.max()) and got.residual < 1e-10
