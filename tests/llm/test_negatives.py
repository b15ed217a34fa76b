"""Hard negatives against brute force: the tree's bounds, a shard's walk, whole tables, hot groups and awkward rows."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talus.llm import negatives

COLUMNS = "vec_id long, embedding array<double>, label long, row int, q string, x string, shard int, id string, w int, salt int, leaf int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, "q", "x", 1, "i", 1, 1, 1) for i, v, lab in rows], COLUMNS)


def brute(rows, every=100, positives=5, wanted=5):
    """The contract, row by row."""
    ok = [(i, v, lab) for i, v, lab in rows if lab is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max((len(v) for _, v, _ in ok), default=0)
    x = [[max(-(1 << 24), min(1 << 24, math.floor(256 * c))) for c in v] + [0] * (size - len(v)) for _, v, _ in ok]
    out = []
    for a, (anchor, _, own) in enumerate(ok):
        if anchor is None or anchor % every:
            continue
        score = [sum(p * q for p, q in zip(x[a], y)) for y in x]
        order = sorted(range(len(ok)), key=lambda j: (-score[j], ok[j][0] is None, ok[j][0] or 0))
        for p in [j for j in order if ok[j][2] == own and j != a][:positives]:
            hard = [j for j in order if ok[j][2] != own and 80 * score[p] <= 100 * score[j] <= 100 * score[p]][:wanted]
            out += [(anchor, ok[p][0], n, ok[j][0], score[p], score[j]) for n, j in enumerate(hard, 1)]
    return sorted(out, key=repr)


def mined(df, **kw):
    return sorted((tuple(r) for r in negatives.mine(df, **kw).collect()), key=repr)


def cloud(seed, n, size, labels, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (scale * rng.normal(size=size) / math.sqrt(size)).tolist(), int(rng.integers(labels))) for i in range(n)]


@settings(deadline=None, max_examples=40)
@given(st.integers(1, 120), st.integers(1, 5), st.integers(0, 2**32 - 1), st.booleans())
def test_bounds_hold_for_every_row_of_a_leaf(n, size, seed, flat):
    rng = np.random.default_rng(seed)
    x = rng.integers(-3, 4, (n, size)) if flat else rng.integers(-300, 300, (n, size))
    longest = float((x * x).sum(1).max())
    points = negatives.augmented(x, longest)
    assert np.allclose((points * points).sum(1), longest, atol=1e-6 * max(1, longest))
    queries = np.column_stack([rng.integers(-300, 300, (7, size)), np.zeros(7)]).astype(float)
    for whole in (True, False):
        tree, leaves = negatives.Tree.grow(points, 4, whole)
        assert sorted(np.concatenate(leaves).tolist()) == list(range(n)) and len(leaves) == tree.leaves
        # A leaf is larger only where its rows are equal.
        assert all(len(leaf) <= 4 or len(np.unique(points[leaf], axis=0)) == 1 for leaf in leaves)
        low, high = tree.bounds(queries)
        for number, leaf in enumerate(leaves):
            d = np.sqrt(((queries[:, None, :] - points[leaf][None]) ** 2).sum(2))
            assert (low[:, number, None] <= d + 1e-3).all() and (d <= high[:, number, None] + 1e-3).all()
    # Rows that the tree was not grown from go where the bounds hold for them too.
    others = negatives.augmented(rng.integers(-200, 200, (50, size)), max(longest, 200.0**2 * size))
    at = tree.leaf_of(others)
    d = np.sqrt(((queries[:, None, :] - others[None]) ** 2).sum(2))
    assert (low[:, at] <= d + 1e-3).all() and (d <= high[:, at] + 1e-3).all()


@settings(deadline=None, max_examples=40)
@given(st.integers(1, 150), st.integers(0, 2**32 - 1), st.booleans())
def test_a_shard_is_searched_as_a_list_is(n, seed, same):
    rng = np.random.default_rng(seed)
    x = rng.integers(-4, 5, (n, 3))
    ids, labels = rng.permutation(n) // 2, rng.integers(0, 3, n).astype(str).tolist()
    shard = negatives.Shard(x, np.arange(n), ids, labels, float((x * x).sum(1).max()))
    q = rng.integers(-4, 5, (6, 3))
    low = rng.integers(-20, 20, (6, 2))
    asked = negatives.Asked(q, rng.integers(0, 4, 6).astype(str).tolist(), low, low + rng.integers(-1, 30, (6, 2)), rng.integers(0, n, (6, 2)))
    want = []
    for i in range(6):
        for w in range(2):
            score = x @ q[i]
            fits = [
                (-int(s), int(ids[j]), j)
                for j, s in enumerate(score)
                if (labels[j] == asked.labels[i]) == same and (asked.low[i, w] < s or asked.low[i, w] == s and ids[j] <= asked.last[i, w]) and s <= asked.high[i, w]
            ]
            want += [(i, w, -s, d, j) for s, d, j in sorted(fits)[:3]]
    kept = asked.low.copy()
    assert sorted(shard.search(asked, 3, same)) == sorted(want)
    assert (asked.low == kept).all()


def test_most_leaves_are_not_looked_at_where_rows_are_near():
    """The walk is worth its tree: in a few dimensions it reads a small part of a shard."""
    rng = np.random.default_rng(3)
    x = rng.integers(-3000, 3000, (4000, 2))
    shard = negatives.Shard(x, np.arange(4000), np.arange(4000), ["a"] * 4000, float((x * x).sum(1).max()))
    seen = []
    real = shard._keep
    shard._keep = lambda *a: (seen.append(len(a[6])), real(*a))[1]
    asked = negatives.Asked(rng.integers(-3000, 3000, (5, 2)), ["a"] * 5, *(np.full((5, 1), v, dtype=np.int64) for v in (-negatives.OPEN, negatives.OPEN, negatives.NO_ID)))
    assert len(list(shard.search(asked, 5, True))) == 25
    assert sum(seen) < 0.1 * 5 * 4000


@pytest.mark.parametrize(("size", "labels", "spread"), [(3, 2, 1.0), (16, 4, 1.0), (2, 30, 40.0)])
def test_whole_tables(spark, monkeypatch, size, labels, spread):
    monkeypatch.setattr(negatives, "LEAST_SHARD", 16)
    rows = cloud(size, 400, size, labels, spread)
    want = brute(rows, every=10)
    assert want and mined(frame(spark, rows).repartition(3), every=10) == want


def test_hot_vectors(spark, monkeypatch):
    """A third of all rows are one vector, of two labels: as anchors, positives and negatives."""
    monkeypatch.setattr(negatives, "LEAST_SHARD", 16)
    rows = cloud(8, 200, 4, 3)
    hot = rows[0][1]
    rows += [(200 + i, hot, i % 2) for i in range(100)]
    assert mined(frame(spark, rows).repartition(5), every=20) == brute(rows, every=20)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = cloud(4, 60, 3, 2) + [(i, None, 1) for i in (0, 100)] + [(100, [0.1, nan, 0.2], 0), (200, [0.1, None, 0.1], 0), (300, [inf, 0.0, 0.0], 1)]
    rows += [(500, [0.2, 0.1, -0.3], None), (None, [30.0, 20.0, 10.0], 1), (None, [30.0, 20.0, 10.0], 0), (600, [0.25], 0), (700, [], 1)]
    rows += [(800, [30.0, 20.0, 10.0], 1), (800, [30.0, 20.0, 10.0], 1), (800, [30.0, 20.0, 10.0], 0), (900, [1e30, -1e30, 5.0], 0), (-100, [-0.0, 0.4, 0.1], 1)]
    want = brute(rows)
    assert any(None in r for r in want) and mined(frame(spark, rows)) == want
    for nothing in ([], [(100, None, 1), (200, [], 1)], [(100, [1.0], 1)]):
        assert mined(frame(spark, nothing)) == []


def test_partitions_do_not_matter(spark):
    rows = cloud(6, 120, 5, 3)
    once, again = (mined(frame(spark, rows).repartition(n), every=10) for n in (1, 9))
    assert once == again == brute(rows, every=10)


def test_texts_as_labels(spark):
    rows = cloud(7, 60, 3, 2)
    df = frame(spark, rows).withColumn("label", F.concat(F.lit("größe "), F.col("label").cast("string")))
    assert mined(df, every=10) == brute(rows, every=10)
