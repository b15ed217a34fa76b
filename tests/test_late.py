"""Geometry read for chosen rows alone: the same rows, and nothing wide in the way of the others."""

import re

import pytest
from pyspark.sql import functions as F

from talus.functions.normalize import normalize
from talus.operators import dedup, late
from talus.plans import workflow
from talus.plans.scenario import filter_scenario, run_together
from talus.queries import EVERY, FREE, SIZE1, WINTER
from talus.sources.fixtures import directory as view
from talus.sources.fixtures import with_geometry

from .conftest import DATA


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('late')}/d.parquet"
    with_geometry(view(spark, str(DATA / "sf0.001"))).repartition(5).write.parquet(at)
    return spark.read.parquet(at)


SELECTIONS = {
    "variants": lambda d: dedup.single_r_size(normalize(d)),
    "winter": lambda d: filter_scenario(d, WINTER),
    "together": lambda d: run_together(d, [WINTER, SIZE1, FREE, EVERY]),
    "nothing": lambda d: filter_scenario(d, WINTER).where("praID < 0"),
}


@pytest.mark.parametrize("name", SELECTIONS)
def test_the_same_rows(stored, name):
    select = SELECTIONS[name]
    found, want = late.selected_late(stored, select), select(stored)
    assert found.columns == want.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))


def test_losers_are_neither_sorted_nor_shuffled_with_their_geometry(spark, stored):
    found = late.selected_late(stored, SELECTIONS["variants"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 2
    wide, narrow = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert "geometry" in wide and "geometry" not in narrow
    # The exchange that geometry passes has the chosen rows only.
    chosen = SELECTIONS["variants"](stored).count()
    assert chosen < stored.count() / 2
    kept = SELECTIONS["variants"](late.addressed(stored).drop("geometry")).select(late.FILE, late.ROW)
    assert late.only(late.addressed(stored), late.bitmaps(kept)).count() == chosen


def test_bitmaps_hold_any_address(spark):
    rows = [("a", r) for r in (0, 1, 7, 8, 32_766, 32_767, 32_768, 65_535, 65_536, 10**7)] + [("b", 5), ("b", 5)]
    every = [(f, r) for f in "ab" for r in [*range(20), *range(32_760, 32_775), *range(65_530, 65_540), 10**7 - 1, 10**7]]
    schema = f"{late.FILE} string, {late.ROW} long"
    found = late.bitmaps(spark.createDataFrame(rows, schema))
    got = late.only(spark.createDataFrame(every, schema), found).collect()
    assert sorted(map(tuple, got)) == sorted(set(rows))


def test_a_table_too_long_for_the_bitmaps_is_selected_from_at_once(stored, monkeypatch):
    monkeypatch.setattr(late, "MOST_BITMAPS", 4)
    found = late.selected_late(stored, SELECTIONS["variants"])
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    plain = late.selected_late(stored.drop("geometry"), SELECTIONS["variants"])
    assert found.count() == plain.count()


def test_a_run_with_late_geometry(stored, tmp_path):
    scenarios = [WINTER, FREE]
    found = workflow.run_scenarios(stored, scenarios, staging=tmp_path / "a", late=True)
    plain = workflow.run_scenarios(stored, scenarios, staging=tmp_path / "b")
    for (s, a), (t, b) in zip(found, plain, strict=True):
        assert s == t and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
