"""Whitening against a plain eigen-decomposition, its parts, and awkward vectors."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talus.llm import whitening
from talus.llm.queries import QUERIES

from ..conftest import DATA

COLUMNS = "vec_id long, embedding array<double>, label int, x string, id string, v int, r string, at int, n long"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", "i", 1, "r", 1, 1) for i, v in vectors], COLUMNS)


def brute(vectors):
    """Distinct rows, exact deviations, whitened rows up to sign, shares of variance."""
    x = [[math.floor(256 * c) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    apart = [[n * c - s for c, s in zip(v, sums)] for v in x]
    centred = np.array([[n * c - s for c, s in zip(v, sums)] for v in fit], dtype=float) / n
    e, w = np.linalg.eigh(centred.T @ centred / n)
    e, w = e[::-1], w[:, ::-1]
    return n, [sum(c * c for c in a) for a in apart], np.array(apart, dtype=float) / n @ w[:, :4] / np.sqrt(e[:4]), e[:4] / e.sum()


def test_the_query_against_eigenvectors(spark):
    df = spark.read.parquet(str(DATA / "sf0.01" / "embeddings.parquet"))
    rows = df.orderBy("vec_id").collect()
    n, deviations, z, shares = brute([r["embedding"] for r in rows])
    got = QUERIES["op12_whiten"](spark, str(DATA / "sf0.01")).orderBy("vec_id", "component").collect()
    assert len(got) == 4 * len(rows)
    found = np.array([r["whitened"] for r in got]).reshape(-1, 4)
    assert np.abs(found * np.sign((found * z).sum(0)) - z).max() < 1e-9
    assert [r["deviation"] for r in got[::4]] == deviations and {r["n"] for r in got} == {n}
    assert np.allclose([r["explained"] for r in got[:4]], shares, rtol=1e-9)
    assert [r["component"] for r in got[:4]] == [1, 2, 3, 4] and {r["identity_error"] < 1e-10 for r in got} == {True}
    assert dict(QUERIES["op12_whiten"](spark, str(DATA / "sf0.01")).dtypes)["deviation"] == "bigint"


@settings(deadline=None, max_examples=40)
@given(st.integers(1, 9), st.integers(0, 12), st.integers(0, 2**32 - 1))
def test_rotations_against_a_plain_svd(size, rows, seed):
    rng = np.random.default_rng(seed)
    r = rng.normal(size=(rows, size)) * 10.0 ** rng.integers(-3, 4, size)
    if size > 2:
        r[:, 1] = r[:, 0]  # a dependent column
    lengths, v = whitening.jacobi(r)
    plain = np.linalg.svd(r, compute_uv=False)
    plain = np.concatenate([plain, np.zeros(size - len(plain))])
    assert np.allclose(lengths, plain, rtol=1e-10, atol=1e-12 * max(1, plain.max(initial=0)))
    assert np.allclose(v.T @ v, np.eye(size), atol=1e-12)
    turned = r @ v
    assert np.allclose(turned.T @ turned, np.diag(lengths**2), atol=1e-10 * max(1.0, plain.max(initial=0) ** 2))


def test_copies_count_once_and_partitions_do_not_matter(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, list(map(float, rng.normal(size=6)))) for i in range(40)]
    hot = [(100 + i, vectors[0][1]) for i in range(60)]
    n, deviations, z, _ = brute([v for _, v in vectors + hot])
    for parts in (1, 30):
        df = frame(spark, vectors + hot).repartition(parts)
        got = whitening.whiten(df).orderBy("vec_id", "component").collect()
        found = np.array([r["whitened"] for r in got]).reshape(-1, 4)
        assert n == 40 and {r["n"] for r in got} == {40}
        assert np.abs(found * np.sign((found * z).sum(0)) - z).max() < 1e-9
        assert [int(r["deviation"]) for r in got[::4]] == deviations


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [1.0, -inf]), (None, [0.5, -0.5]), (5, [0.5, -0.5]), (5, [0.5, -0.5])]
    rows += [(6, []), (7, [2.0]), (8, [2.0, 0.0, 0.0]), (9, [-0.0, 1.0, 3.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    # As if followed by zeros: four different vectors of three entries.
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == sorted((i, c) for i in (0, 5, 5, 6, 7, 8, 9) for c in (1, 2, 3))
    assert {r["n"] for r in got} == {4}
    same = {(r["component"], r["whitened"]) for r in got if r["vec_id"] in (7, 8)}
    assert len(same) == 3
    for nothing in ([], [(1, None)], [(1, []), (2, [])]):
        assert whitening.whiten(frame(spark, nothing)).count() == 0
    # One vector, however often, has no variance.
    alone = whitening.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect()
    assert {(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in alone} == {(None, 0.0, 0.0, 0)}
    # A flat direction has none either.
    flat = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])).where("whitened IS NOT NULL")
    assert {r["component"] for r in flat.collect()} == {1}


def test_sums_stay_exact_beyond_64_bits(spark):
    rows = [(1, [1e15, 1.0]), (2, [-1e15, 2.0]), (3, [1e14, 3.0]), (4, [1e300, 1.0])]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame(spark, rows[:3])).where("component = 1").collect()}
    _, deviations, _, _ = brute([v for _, v in rows[:3]])
    assert [int(got[i]) for i in (1, 2, 3)] == deviations
    # What a long can't hold counts as its end; what a variance hides behind rounding has none.
    ends = whitening.whiten(frame(spark, rows)).where("component = 1").collect()
    assert len(ends) == 4 and all(math.isfinite(r["whitened"]) for r in ends)


def test_the_column_of_sums_follows_its_sql(spark):
    assert "vector_deviations" in QUERIES
    got = QUERIES["vector_deviations"](spark, str(DATA / "sf0.001"))
    assert got.columns == ["vec_id", "n", "deviation"] and got.count() == 500
    assert got.where(F.col("deviation").isNull()).count() == 0


def test_too_few_rounds_raise(monkeypatch):
    monkeypatch.setattr(whitening, "SWEEPS", 1)
    with pytest.raises(ValueError, match="not orthogonal"):
        whitening.jacobi(np.random.default_rng(1).normal(size=(20, 12)))
