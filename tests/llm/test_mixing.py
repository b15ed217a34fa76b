import math
import re
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talus.llm import mixing

from ..conftest import DATA
from .rows import awkward

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share by weight, stop at the ceiling, share the excess anew, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        left, per = total - sum(fixed.values()), sum(weight[s] for s in open_)
        target = {s: left * weight[s] / per for s in open_}
        above = [s for s in open_ if target[s] > cap * sizes[s]]
        if not above:
            return fixed | target
        fixed |= {s: cap * sizes[s] for s in above}


source_sizes = st.dictionaries(st.one_of(st.none(), st.text("ab0é\U0001f600", max_size=2)), st.integers(0, 500), min_size=1, max_size=9)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(source_sizes)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6) for s in want)


def check(df, rows, tolerance):
    text = {}
    for r in df.collect():
        text.setdefault(r["doc_id"], []).append((r["source"], len(WORD.findall(r["text"] or ""))))
    sizes = defaultdict(int)
    for pairs in text.values():
        for s, n in pairs:
            sizes[s] += n
    assert len(rows) == df.count()
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0 for r in rows)
    want, taken, source_of = brute_targets(dict(sizes)), defaultdict(int), {i: p[0][0] for i, p in text.items()}
    for r in rows:
        s = source_of[r["doc_id"]]
        taken[s] += r["taken"]
        if len(text[r["doc_id"]]) == 1:
            assert (r["size"], r["source_size"]) == (text[r["doc_id"]][0][1], sizes[s])
            assert r["target"] == pytest.approx(want[s], rel=1e-9)
    for s, target in want.items():
        assert abs(taken[s] - target) <= tolerance * target + 3


def test_whole_table_and_reruns(spark):
    df = spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet"))
    rows = mixing.mix(df).collect()
    check(df, rows, 0.01)
    assert sorted(rows) == sorted(mixing.mix(df.repartition(5)).collect())


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = mixing.mix(df).collect()
    assert len(rows) == df.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert all(r["copies"] == 1 for r in rows if r["size"] == 0)
    assert mixing.mix(awkward(spark, empty=True)).count() == 0
    taken = mixing.take_mix(df)
    assert taken.columns == df.columns
    assert mixing.take_mix(awkward(spark, empty=True)).count() == 0


def test_a_hot_source_of_equal_rows_is_dealt_into_small_blocks(spark):
    df = spark.range(9000).selectExpr("CASE WHEN id < 8500 THEN 1 ELSE id END AS doc_id", "'a b c' AS text", "CASE WHEN id < 8500 THEN 'hot' END AS source")
    rows = mixing.mix(df).collect()
    taken = defaultdict(int)
    for r in rows:
        taken[r["source_size"]] += r["taken"]
    want = brute_targets({"hot": 25500, None: 1500})
    assert taken[25500] == pytest.approx(want["hot"], rel=0.02) and taken[1500] == pytest.approx(want[None], rel=0.02)


@pytest.mark.parametrize("key", ["1", "NULL"])
def test_a_block_just_above_the_limit_keeps_its_rate(spark, key):
    """Equal rows of three sources, each a hot block: 1,000 parts of 4 rows each would all round alike."""
    df = spark.range(13_500).selectExpr(f"CAST({key} AS LONG) AS doc_id", "'a b c' AS text", "element_at(array('a', 'b', 'c'), CAST(1 + id % 3 AS INT)) AS source")
    want = brute_targets({"a": 13_500, "b": 13_500, "c": 13_500})
    kept = {r["source"]: 3 * r["count"] for r in mixing.take_mix(df).groupBy("source").count().collect()}
    taken = mixing.mix(df).groupBy("target").agg(F.sum("taken").alias("n")).collect()
    # Half a document of three words for each of 9 parts.
    assert all(abs(kept[s] - want[s]) <= 14 for s in want)
    assert len(taken) == 3 and all(abs(r["n"] - r["target"]) <= 14 for r in taken)


def test_the_dual_along_a_tilt(spark):
    """Newton meets the constraints for a tilt that differs between documents, caps included."""
    df = spark.range(400).selectExpr("id AS doc_id", "concat_ws(' ', array_repeat('w', CAST(1 + id % 37 AS INT))) AS text", "CAST(id % 5 AS STRING) AS source")
    rows = mixing.mix(df, x=F.size(F.split("text", " ")) / 10).collect()
    assert {round(r["rate"], 6) for r in rows if r["source_size"] == rows[0]["source_size"]}.__len__() > 5
    for size in {r["source_size"] for r in rows}:
        mine = [r for r in rows if r["source_size"] == size]
        assert sum(r["rate"] * r["size"] for r in mine) == pytest.approx(mine[0]["target"], rel=1e-6)
        assert max(r["rate"] for r in mine) <= 3


def test_copies_are_taken(spark):
    df = spark.read.parquet(str(DATA / "sf0.001" / "documents.parquet"))
    want = sorted(r["doc_id"] for r in mixing.mix(df).collect() for _ in range(r["copies"]))
    assert sorted(r["doc_id"] for r in mixing.take_mix(df).collect()) == want


def brute_rates(sizes, target, cap=3.0):
    """The multiplier of one source by bisection, and each document's rate."""
    mean = sum(sizes) / len(sizes)
    low, high = -500.0, 500.0
    for _ in range(200):
        lam = (low + high) / 2
        rates = [min(cap, math.exp(min(50.0, lam * n / mean))) for n in sizes]
        low, high = (lam, high) if sum(r * n for r, n in zip(rates, sizes)) < target else (low, lam)
    return rates


def test_every_document_has_a_rate_of_its_own(spark):
    """Rates are the dual's solution by brute force, and differ within a source."""
    sizes = {"a": [1, 2, 5, 9, 40, 7, 7, 300], "b": [10, 20, 30, 1000, 4, 4], "c": [50, 60, 1], None: [8, 9, 200, 31]}
    rows = [(i, " ".join(["w"] * n), s, n) for i, (s, n) in enumerate((s, n) for s, all_ in sizes.items() for n in all_)]
    df = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["rate"] for r in mixing.mix(df).collect()}
    targets = brute_targets({s: sum(all_) for s, all_ in sizes.items()})
    for s, all_ in sizes.items():
        mine = [got[i] for i, _, t, _ in rows if t == s]
        if targets[s] < 3 * sum(all_) * (1 - 1e-9):
            assert mine == pytest.approx(brute_rates(all_, targets[s]), rel=1e-5, abs=1e-8)
            assert len({round(r, 6) for r in mine}) == len(set(all_)) or max(mine) == 3
        else:
            assert set(mine) == {3.0}


def test_rates_differ_within_the_sources_of_a_table(spark):
    rows = mixing.mix(spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet"))).where("size > 0").collect()
    by_source = defaultdict(lambda: defaultdict(set))
    for r in rows:
        by_source[r["source_size"]][r["size"]].add(r["rate"])
    assert all(len(rates) == 1 for levels in by_source.values() for rates in levels.values())
    open_sources = [r for r in rows if r["target"] < 3 * r["source_size"] * (1 - 1e-9)]
    assert open_sources and all(len(by_source[r["source_size"]]) < 3 or len(set().union(*by_source[r["source_size"]].values())) > 1 for r in open_sources)


def test_repeated_ids_meet_the_target_when_taken(spark):
    """A third of all rows share an id but not a text, another third have no id."""
    df = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN id END AS doc_id",
        "concat_ws(' ', array_repeat('w', CAST(1 + id % 11 AS INT))) AS text",
        "CAST(id % 4 AS STRING) AS source",
    )
    sizes = {r["source"]: r["n"] for r in df.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    kept = mixing.take_mix(df).groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()
    want = brute_targets(sizes)
    assert all(abs(r["n"] - want[r["source"]]) <= 0.01 * want[r["source"]] + 3 for r in kept) and len(kept) == 4


def test_a_mix_that_does_not_converge_raises(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROUNDS", 1)
    df = spark.createDataFrame([(i, "w " * (1 + i % 7), None, "ab"[i % 3 == 0]) for i in range(60)], "doc_id long, text string, lang string, source string")
    with pytest.raises(ValueError, match="not met after 1 rounds"):
        mixing.mix(df).collect()
