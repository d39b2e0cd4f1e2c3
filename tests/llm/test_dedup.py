"""Exact and near duplicates against brute force."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from chainstar.llm import exact_dedup, simhash
from chainstar.llm.common import work_dir
from chainstar.llm.components import components


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return {t: (min((i for i in v if i is not None), default=None), len(v)) for t, v in groups.items()}


TEXTS = ["a b", "a  b", "a\tb", "b a", None, "", " ", "same prefix " * 20 + "x", "same prefix " * 20 + "y",
         "same prefix " * 20 + "x", "z" * 300_000, "z" * 300_000, "a b"]


@pytest.mark.parametrize("bits", [1 << 17, 1])
def test_exact(spark, docs_of, bits):
    docs = docs_of(TEXTS * 3 + ["hot"] * 500, extra="keep_id")
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    texts = TEXTS * 3 + ["hot"] * 500
    want = brute_exact(zip(ids, texts))
    got = exact_dedup.annotate(docs, filter_bits=bits).collect()
    assert len(got) == len(ids)
    for r in got:
        assert (r.keep_id, r.group_size) == want[norm(texts[r.doc_id])] and r.kept == (r.doc_id == r.keep_id)
    left = exact_dedup.drop_copies(docs, filter_bits=bits)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(v[0] for v in want.values())


def test_exact_ties_and_nulls(spark, docs_of):
    docs = docs_of(["t", "t", "t", "u", "u", None], ids=[5, 5, 7, None, None, None])
    got = exact_dedup.annotate(docs).collect()
    five = [r for r in got if r.doc_id == 5]
    assert sorted(r.kept for r in five) == [False, True] and all(r.group_size == 3 for r in five)
    assert sum(r.kept for r in got) == 3
    assert exact_dedup.drop_copies(docs).count() == 3
    assert exact_dedup.annotate(docs.limit(0)).count() == 0 and exact_dedup.drop_copies(docs.limit(0)).count() == 0


def test_exact_is_native(spark, docs_of, capsys):
    docs = docs_of(["a", "a", "b"])
    for df in (exact_dedup.annotate(docs), exact_dedup.drop_copies(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# -- SimHash ----------------------------------------------------------------------------

def brute_fingerprint(text):
    lower = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    s = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", "  \n", "One", "a b c", "A B c d", "ÄÖ é ß x y z", "a b c d e f g " * 9,
                                  "x\x0by\x0cz w v", "a b c d e"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_every_close_pair_is_a_candidate():
    """The five patterns of a start cover every way to differ in at most four bits."""
    rng = np.random.default_rng(1)
    pats = simhash.patterns()
    assert len(pats) == 40
    for _ in range(4000):
        x = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))
        seg = [x >> 8 * k & 255 for k in range(8)]
        hit = [(start, eq) for start, eq in pats if all(seg[k] == 0 for k in eq)]
        assert any(all((x & int(m)).bit_count() <= budget for m, budget in simhash.chain_masks(start)) for start, _ in hit)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.sets(st.integers(0, 63), max_size=3)), min_size=2, max_size=30), st.integers(0, 39))
def test_links_span_the_close_pairs_of_a_run(rows, pattern):
    """Within one key: the links connect exactly what the chain and Hamming checks connect."""
    base = [0, 2**64 - 1, 0x0F0F0F0F0F0F0F0F, 0xF0F0F0F0F0F0F0F0, 0x00FF00FF00FF00FF, 0xFF00FF00FF00FF00]
    fp = sorted({base[b] ^ sum(1 << i for i in bits) for b, bits in rows})
    arr = np.array(fp, dtype=np.uint64)
    k = np.full(len(fp), pattern << 24, dtype=np.int64)
    a, b = simhash.links_of_runs(k, arr)
    up = {x: x for x in fp}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        assert (x ^ y).bit_count() <= 4
        up[find(x)] = find(y)
    masks = simhash.chain_masks(simhash.patterns()[pattern][0])
    for i, x in enumerate(fp):
        for y in fp[i + 1:]:
            if (x ^ y).bit_count() <= 4 and all(((x ^ y) & int(m)).bit_count() <= n for m, n in masks):
                assert find(x) == find(y)


def fake_texts(n, seed=3):
    """Texts with copies and near copies (a word changed in a long text)."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    while len(out) < n:
        base = [words[i] for i in rng.integers(0, 400, 300)]
        for _ in range(int(rng.integers(1, 6))):
            near = list(base)
            for i in rng.integers(0, 300, int(rng.integers(0, 3))):
                near[i] = words[int(rng.integers(0, 400))]
            out.append(" ".join(near))
    return out[:n]


def brute_components(ids, fps):
    up = list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                up[find(i)] = find(j)
    return [min(ids[j] for j in range(len(ids)) if find(j) == find(i)) for i in range(len(ids))]


def test_near_duplicates(spark, docs_of):
    texts = fake_texts(120) + [None, "", "the same", "the same"] + ["hot text of a few words"] * 200
    ids = [1000 - i for i in range(len(texts))]
    docs = docs_of(texts, ids=ids, extra="component_id")
    fps = [brute_fingerprint(t) for t in texts]
    want = dict(zip(ids, brute_components(ids, fps)))
    got = simhash.near_duplicates(docs).withColumn("hex", simhash.hex_digits()).collect()
    assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(ids)
    assert {r.doc_id: r.hex for r in got} == {i: f"{f:016x}" for i, f in zip(ids, fps)}
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(want.values()))


def test_large_keys_are_compared_in_blocks(spark):
    """A dense cluster, with blocks of a few members, keeps its components."""
    rng = np.random.default_rng(5)
    fps = sorted({sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(300)}
                 | {int(x) for x in rng.integers(0, 2**63, 100)})
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = simhash.class_links(classes, block=7)
    part = {r.node: r.root for r in components(links, work_dir(spark, "t")).collect()}
    want = brute_components(list(range(len(fps))), fps)
    groups = {}
    for i, x in enumerate(signed):
        groups.setdefault(part.get(x, ("alone", x)), set()).add(want[i])
    assert all(len(v) == 1 for v in groups.values()) and len(groups) == len(set(want))


def test_near_duplicates_of_nothing_and_of_nulls(spark, docs_of):
    docs = docs_of(["a b c d e", "a b c d e", None], ids=[None, None, 4])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert got == [("4", "4"), ("None", "None"), ("None", "None")]


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    links = spark.createDataFrame(edges, "a long, b long")
    part = {r.node: r.root for r in components(links, work_dir(spark, "t")).collect()}
    assert part == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}


def test_near_duplicates_are_dropped_by_row(spark, docs_of):
    """A doc_id on two texts, null ids, equal rows and clashing names: one row of each group stays."""
    x, y = "the first text has words of its own here", "another one that shares nothing with the former"
    docs = docs_of([x, y, y], [5, 5, 2], extra="x_gone")
    assert sorted((r.doc_id, r.text) for r in simhash.drop_near_duplicates(docs).collect()) == [(2, y), (5, x)]
    docs = docs_of([x, x, y, y, y, None, ""], [None, None, None, 7, 7, 3, None], extra="n")
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == [("3", "None"), ("7", y), ("None", x)]
