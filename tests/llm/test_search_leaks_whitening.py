"""Decontamination, ranked search and whitening against brute force."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chainstar.llm import decontaminate as D
from chainstar.llm import eigen_update as U
from chainstar.llm import search as S
from chainstar.llm import whitening as W

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


# --- decontamination -----------------------------------------------------

def leaks(docs, items, window):
    wins = defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1)):
            if w[k:k + window]:
                wins[tuple(w[k:k + window])].add(item)
    out = []
    for i, text in docs:
        w, hit, got = words(text), set(), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in wins:
                    hit.update(range(k, k + size))
                    got |= wins[tuple(w[k:k + size])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in got if x is not None)))
    return sorted(out, key=str)


def run_leaks(spark, docs_of, docs, items, **kw):
    frame = docs_of([t for _, t in docs], [i for i, _ in docs], extra="items")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n string")
    got = D.decontaminate(frame, bench, **kw).collect()
    assert all(r.contaminated == (r.n_hit > 0) == bool(r.spans) for r in got)
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.items) for r in got], key=str)


ITEM = "One two three, four FIVE six-seven eight nine ten eleven twelve"


@pytest.mark.parametrize("kw", [{}, {"block_bytes": 300}, {"shingle": 1}, {"shingle": 10}, {"window": 4}])
def test_leaks_against_brute_force(spark, docs_of, kw):
    items = [(1, ITEM), (2, ITEM + " more"), (3, "just two"), (4, "solo"), (5, None), (6, "..."), (None, "a b a b a b"),
             (7, "É è ÉÈ straße 東京 x y z 1 2 3 4 5"), (7, "other text under the same id")]
    rng = np.random.default_rng(3)
    docs = [(1, "before " + ITEM.lower() + " after"), (2, None), (3, ""), (4, "one two three four five six seven eight nine"),
            (5, "just two solo just"), (5, "a b a b a b a b"), (None, ITEM), (None, ITEM), (8, "é è éè straße 東京 X Y Z 1 2 3 4 5"),
            (9, "É è ÉÈ straße 東京 X Y Z 1 2 3 4 5"), (10, (ITEM + ". ") * 30), (11, "ΣΑΣ İstanbul ǅ Ⅷ Ⓐ one two three"),
            *[(20 + k, " ".join(rng.choice(["a", "b", "just", "two", "solo", "x"], size=rng.integers(1, 30))))
              for k in range(40)]]
    assert run_leaks(spark, docs_of, docs, items, **kw) == leaks(docs, items, kw.get("window", 10))


def test_leaks_of_empty_tables(spark, docs_of):
    assert run_leaks(spark, docs_of, [], [(1, ITEM)]) == []
    assert run_leaks(spark, docs_of, [(1, "a b")], []) == [(1, 2, 0, [])]


def test_leaks_in_a_very_long_text(spark, docs_of):
    text = "lorem ipsum " * 100_000 + ITEM + " dolor" * 100_000
    assert run_leaks(spark, docs_of, [(1, text)], [(1, ITEM)]) == [(1, 300_012, 12, ["1"])]


# --- ranked search ---------------------------------------------------------

def ranked(docs, items, k):
    counted = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 25 + (75 * c.total() * n_docs) // total
            got = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                      * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in words(text) if t in c)
            if got > 0:
                scores.append((-got, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("kw", [{}, {"block_postings": 4}, {"k": 1}])
def test_search_against_brute_force(spark, docs_of, kw):
    rng = np.random.default_rng(5)
    vocabulary = ["alpha", "BETA", "gamma", "Émile", "émile", "東京", "x1", "the", "the", "the"]
    docs = [(k // 2 if k % 7 else None, " ".join(rng.choice(vocabulary, size=rng.integers(0, 12)))) for k in range(120)]
    docs += [(900, "the the"), (901, "the the"), (902, None), (903, "!?"), (-4, "the the")]
    items = [(1, "alpha beta the"), (2, "ÉMILE Émile émile émile"), (3, None), (4, "absent"), (5, "東京, X1! x1"), (5, "gamma"),
             (None, "the gamma")]
    frame = docs_of([t for _, t in docs], [i for i, _ in docs], extra="score").repartition(5)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = S.search(frame, bench, **({"k": 10} | kw)).collect()
    assert sorted(map(tuple, got), key=str) == ranked(docs, items, kw.get("k", 10))


def test_search_of_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert S.search(docs_of([]), items).collect() == []
    assert S.search(docs_of(["", None]), items).collect() == []
    assert S.search(docs_of(["a"]), items.limit(0)).collect() == []


def test_terms_of_a_long_text_are_cut_at_spaces(monkeypatch):
    text = "Alpha  beta,gamma " * 500 + "東京" * 50
    whole = S.term_counts(text)
    monkeypatch.setattr(S, "LONG", 64)
    assert S.term_counts(text) == whole == S.term_counts(text.encode())
    assert whole[b"beta"] == 500 and whole["東京".encode() * 50] == 1


# --- rank-one updates and whitening -------------------------------------------

@pytest.mark.parametrize("dim", [1, 2, 5, 33])
def test_spectra_of_rows_and_of_merged_parts(dim):
    rng = np.random.default_rng(dim)
    x = np.floor(rng.normal(size=(200, dim)) * rng.uniform(1, 60, size=dim))
    x[50:90] = x[0]
    x[:, -1] = x[:, 0] if dim > 2 else x[:, -1]     # a direction without variance
    want = (x - x.mean(0)).T @ (x - x.mean(0))
    whole, parts = U.Spectrum(dim), [U.Spectrum(dim) for _ in range(4)]
    for k, row in enumerate(x):
        whole.add(row)
        parts[min(k // 60, 2)].add(row)             # the fourth part stays empty
    for p in parts[1:]:
        parts[0].merge(p)
    for got in (whole, parts[0]):
        assert got.n == 200 and np.allclose(got.mean, x.mean(0))
        assert np.abs(got.vectors.T @ got.vectors - np.eye(dim)).max() < 1e-12
        assert np.abs(want @ got.vectors - got.vectors * got.values).max() < 1e-11 * np.trace(want)


@pytest.mark.parametrize("rows", [np.ones((5, 3)), np.array([[1, 2, 3], [2, 4, 6], [3, 6, 9]]), np.repeat(np.eye(4), 3, 0),
                                  np.array([[0, 0], [1e9, 0], [0, 1.0]])])
def test_spectra_with_equal_and_zero_values(rows):
    got = U.Spectrum(rows.shape[1])
    for row in rows.astype(float):
        got.add(row)
    want = np.linalg.eigvalsh((rows - rows.mean(0)).T @ (rows - rows.mean(0)))
    assert np.allclose(got.values, want, atol=1e-12 * max(1, want.max()))


def whitened(vectors):
    """{row number: (deviation, whitened)}, n and shares by numpy."""
    good = {i: np.floor(np.array(v, dtype=np.float64) * 256) for i, v in enumerate(vectors)
            if v and all(e is not None and math.isfinite(e) for e in v)}
    fit = np.unique(np.array(list(good.values())), axis=0)
    n, mean = len(fit), fit.mean(0)
    e, q = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    sums = [int(s) for s in fit.sum(0)]
    rows = {i: (sum((n * int(a) - s) ** 2 for a, s in zip(x, sums)), (x - mean) @ q[:, ::-1] / np.sqrt(np.maximum(e[::-1], 1e-300)))
            for i, x in good.items()}
    return rows, n, e[::-1] / e.sum()


def run_whitening(spark, vectors, **kw):
    table = spark.createDataFrame([(i, list(v) if v is not None else None, "x") for i, v in enumerate(vectors)],
                                  "vec_id long, embedding array<float>, x string")
    return W.whiten(table.repartition(6), **kw).collect()


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.normal(size=(300, 12)) * np.linspace(3, 0.2, 12)).astype(np.float32).tolist()
    vectors += [vectors[0]] * 40 + [None, [], [1.0] * 11 + [None], [1.0] * 11 + [float("nan")], [1.0] * 11 + [float("inf")]]
    want, n, share = whitened(vectors)
    got = run_whitening(spark, vectors)
    assert n == 300 and len(got) == 4 * len(want) == 4 * 340
    by = {(r.vec_id, r.component): r for r in got}
    sign = [np.sign(by[0, c].whitened * want[0][1][c - 1]) for c in range(1, 5)]
    for (i, comp), r in by.items():
        assert r.n == n and r.deviation == want[i][0] and r.identity_error < 1e-10
        assert math.isclose(r.whitened, sign[comp - 1] * want[i][1][comp - 1], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r.explained, share[comp - 1], rel_tol=1e-12)


def test_whitening_of_few_and_odd_vectors(spark):
    assert run_whitening(spark, []) == []
    assert run_whitening(spark, [None, []]) == []
    assert run_whitening(spark, [[1.0, 2.0]] * 3) == []                      # no variance
    got = run_whitening(spark, [[0.0, 0.0], [1.0, 0.0], [5.0, 5.0, 5.0]])    # one direction; another length is left out
    assert sorted((r.vec_id, r.component, r.deviation, round(abs(r.whitened), 9)) for r in got) == [
        (0, 1, 256 ** 2, 1.0), (1, 1, 256 ** 2, 1.0)]
    big = run_whitening(spark, [[1e15, 0.0], [-1e15, 1.0], [3e16, 2.0]])     # the last is beyond the limit, sums are not 64-bit safe
    assert {r.vec_id for r in big} == {0, 1} and all(r.deviation is None for r in big)


def test_refinement_finds_the_leading_pairs_from_a_rough_basis(spark, tmp_dir):
    rng = np.random.default_rng(9)
    x = np.floor(rng.normal(size=(400, 10)) * np.array([90, 60, 40, 9, 8, 7, 6, 5, 4, 3])).astype(int)
    fit = spark.createDataFrame([(r,) for r in x.tolist()], "x array<long>").repartition(5)
    mean = x.mean(0)
    rough = rng.normal(size=(10, 5))                                          # not even near the right space
    e, q, trace = W.refine(fit, len(x), mean, rough, 2, tmp_dir)
    v = (x - mean).T @ (x - mean) / len(x)
    assert np.allclose(e, np.linalg.eigvalsh(v)[::-1][:2], rtol=1e-12) and math.isclose(trace, np.trace(v))
    assert np.abs(v @ q - q * e).max() < 1e-10 * e[0]
