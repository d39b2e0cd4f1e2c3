"""The canonical chain against a walk over all branches."""

import random

import pytest

from chainstar.operators.chain import canonical_chain, without_stale
from chainstar.operators.quality import broken_links, stale_heights
from chainstar.plans.dims import staged_blocks

from fixtures import RUN_TS, blocks_df


def _blocks(spark, rows):
    """rows: (key, parent, height, seconds)."""
    return staged_blocks(blocks_df(spark, [(h, f"2024-04-23 {s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}", "alpha", "5", 10, 1, 1, k, p)
                                           for k, p, h, s in rows]), RUN_TS)


def _walk(rows):
    """Keys on the chain: from every root, the child whose branch ends highest, earliest, least."""
    by = {k: (p, h, s) for k, p, h, s in rows}
    children, roots = {}, []
    for k, (p, h, s) in by.items():
        if p in by and by[p][1] == h - 1:
            children.setdefault(p, []).append(k)
        else:
            roots.append(k)
    end = {}
    for k in sorted(by, key=lambda k: -by[k][1]):
        end[k] = min([(-by[k][1], by[k][2], k)] + [end[c] for c in children.get(k, [])])
    out = set()
    for k in roots:
        while k is not None:
            out.add(k)
            k = min(children.get(k, []), key=lambda c: end[c], default=None)
    return out


def _check(spark, tmp_dir, rows):
    df = _blocks(spark, rows)
    got = canonical_chain(df, f"{tmp_dir}/a").collect()
    assert {r.block_key for r in got if r.is_canonical} == _walk(rows)
    assert len(got) == len(rows)
    return df


def test_forks_gaps_and_ties(spark, tmp_dir):
    rows = [("a1", "a0", 1, 0), ("a2", "a1", 2, 10), ("b2", "a1", 2, 5), ("b3", "b2", 3, 20), ("a3", "a2", 3, 25),
            ("a4", "a3", 4, 30),                                     # a2..a4 win although b2 came first
            ("a5", "a4", 5, 40), ("c5", "a4", 5, 39),                # a tie at the top: the earlier one
            ("d9", "lost", 9, 50), ("d10", "d9", 10, 60), ("e10", "d9", 10, 60),   # after a gap; equal times: the lesser key
            ("odd", "a1", 7, 70)]                                    # its parent is not one height below: a root
    df = _check(spark, tmp_dir, rows)
    assert _walk(rows) == {"a1", "a2", "a3", "a4", "c5", "d9", "d10", "odd"}
    kept = without_stale(df, f"{tmp_dir}/b")
    assert kept.count() == 8 and stale_heights(kept).count() == 0
    assert {r.block_key for r in broken_links(df).collect()} == {"d9"}


def test_long_contested_branches(spark, tmp_dir):
    rows = [("m0", "x", 0, 0)]
    for n in range(1, 41):
        rows += [(f"m{n}", f"m{n - 1}", n, n), (f"s{n}", f"s{n - 1}" if n > 1 else "m0", n, n)]
    _check(spark, tmp_dir, rows + [("s41", "s40", 41, 50)])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_trees(spark, tmp_dir, seed):
    rng = random.Random(seed)
    rows = [("n0", "none", 0, 0)]
    for n in range(1, 150):
        p = rng.choice(rows[-6:])
        rows.append((f"n{n}", p[0], p[2] + 1, rng.randrange(500)))
    rows = [r for r in rows if rng.random() > 0.05]
    _check(spark, tmp_dir, rows)


def test_no_blocks_and_no_forks(spark, tmp_dir):
    df = _blocks(spark, [("a1", "a0", 1, 0), ("a2", "a1", 2, 10)])
    assert [r.is_canonical for r in canonical_chain(df, f"{tmp_dir}/a").collect()] == [True, True]
    assert canonical_chain(df.limit(0), f"{tmp_dir}/b").count() == 0
