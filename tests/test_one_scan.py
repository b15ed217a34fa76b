"""Runs that read their table once: any mix of scenarios, counted and checked as its rows pass by."""

import itertools
import logging

import pytest
from pyspark.sql import functions as F

from talus.operators import diagnostics, legend
from talus.plans import workflow
from talus.plans.scenario import STEPS, attribute_predicates, count_together, filter_scenario, one_of, run_together
from talus.functions.normalize import normalize
from talus.queries import EVERY, FREE, QUERIES, SIZE1, WINTER
from talus.schema import MATRIX_KEY
from talus.sources.config import Scenario
from talus.sources.directory import write_bucketed
from talus.sources.fixtures import directory as view
from talus.sources.fixtures import with_geometry

from .conftest import DATA
from .test_engine import frame

KINDS = {
    "matrix": WINTER,
    "size 1": SIZE1,
    "size 1, all variants": Scenario(name="s", lk=("70601",), pots=("high",), size=1, single_r_size=False),
    "free": FREE,
    "all variants": EVERY,
    "free, all variants": Scenario(name="f", sub_catchments=(500,), flows=("wet",), single_r_size=False),
    "no cell": Scenario(name="n", pots=("low",), size=5),
    "size 1 without a cell": Scenario(name="m", pots=("none such",), size=1),
}
MIXES = [m for n in (1, 2) for m in itertools.combinations(KINDS, n)] + [tuple(KINDS)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The test view as files, with keys that aren't typed as whole numbers."""
    at = f"file://{tmp_path_factory.mktemp('view')}/d.parquet"
    view(spark, str(DATA / "sf0.001")).withColumns({c: F.col(c).cast("double") for c in MATRIX_KEY[:3]}).write.parquet(at)
    return spark.read.parquet(at)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("mix", MIXES, ids="+".join)
def test_any_mix_is_one_scan_and_one_shuffle(spark, stored, mix):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    together = run_together(stored, [KINDS[k] for k in mix])
    text = plan(together)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs.getJobIdsForGroup("plan")  # nothing is looked at while the plan is made
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") <= 1 and "Union" not in text


@pytest.mark.parametrize("mix", [("size 1", "free", "matrix"), tuple(KINDS)], ids="+".join)
def test_any_mix_equals_scenario_by_scenario(stored, mix):
    scenarios = [KINDS[k] for k in mix]
    together = run_together(stored, scenarios).cache()
    for i, s in enumerate(scenarios):
        alone = filter_scenario(stored, s)
        joint = one_of(together, s, i)
        if "AvaSizePotential" not in alone.columns:  # no cell: no rows and no tags
            joint = joint.drop("AvaSizePotential", "AvaDistributionPotential")
        assert sorted(joint.columns) == sorted(alone.columns)
        assert sorted(map(repr, joint.select(*(F.col(c).cast("string") for c in sorted(joint.columns))).collect())) == sorted(
            map(repr, alone.select(*(F.col(c).cast(joint.schema[c].dataType).cast("string") for c in sorted(joint.columns))).collect())
        )
    together.unpersist()


@pytest.mark.parametrize("mix", [("matrix",), ("size 1", "all variants"), tuple(KINDS)], ids="+".join)
def test_counts_without_the_rows(stored, mix):
    scenarios = [KINDS[k] for k in mix]
    doubled = stored.union(stored.withColumn("praID", F.when(F.col("praID") % 2 == 0, F.col("praID"))))  # null keys are a group
    want = {r["scenario"]: r["count"] for r in run_together(doubled, scenarios).groupBy("scenario").count().collect()}
    assert {r["scenario"]: r["n"] for r in count_together(doubled, scenarios).collect()} == want


def test_coverage_sorts_and_ranks_no_row(spark):
    text = plan(QUERIES["legend_coverage"](spark, str(DATA / "sf0.001")))
    assert "Window" not in text and "SortAggregate" not in text


@pytest.mark.parametrize("mix", [("matrix",), ("size 1", "free"), tuple(KINDS)], ids="+".join)
def test_no_row_is_sorted_before_it_is_moved(stored, mix):
    """A sort below the exchange would hold all rows of a task; only rows with geometry are thinned there."""
    text = plan(run_together(stored, [KINDS[k] for k in mix]))
    assert "Sort" in text and "Sort" not in text[text.index("Exchange hashpartitioning") :]
    assert "Window" not in text[text.index("Exchange hashpartitioning") :]
    wide = plan(run_together(with_geometry(stored), [KINDS[k] for k in mix]))
    assert "WindowGroupLimit" in wide[wide.index("Exchange hashpartitioning") :]


def test_single_rsize_moves_rows_first(spark):
    text = plan(QUERIES["single_rsize"](spark, str(DATA / "sf0.001")))
    assert text.count("Exchange") == 1 and "Sort" not in text[text.index("Exchange") :]


def test_counts_of_the_run_itself(spark, stored, tmp_path, caplog):
    scenarios = [WINTER, SIZE1, FREE, Scenario(name="all")]
    reads = []

    class Counted(logging.Handler):
        def emit(self, record):
            if "after each step" in record.getMessage():
                reads.append(record.args)

    handler = Counted()
    logging.getLogger("talus.plans.workflow").addHandler(handler)
    caplog.set_level(logging.INFO)
    try:
        observed = workflow.run_scenarios(stored, scenarios, staging=tmp_path / "a", observed=True)
        apart = reads[:]
        reads.clear()
        workflow.log_steps(stored, scenarios)
    finally:
        logging.getLogger("talus.plans.workflow").removeHandler(handler)
    assert apart == reads and [name for name, _ in apart] == [s.name for s in scenarios]
    base = normalize(stored)
    for s, (_, kept) in zip(scenarios, apart):
        want = {r["step"]: r["kept"] for r in diagnostics.funnel(base, attribute_predicates(base, s)).collect()}
        assert kept == want and list(kept) == ["start", *STEPS]
    plain = workflow.run_scenarios(stored, scenarios, staging=tmp_path / "b")
    for (_, a), (_, b) in zip(observed, plain):
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_a_bad_key_fails_the_query_that_meets_it(spark, tmp_path):
    df = frame(spark, {"PPM": 5.0}, {"PPM": 4.5, "flow": "wet"}, {"PPM": float("inf"), "flow": "odd"})
    dry, wet, free = (Scenario(name=f, flows=(f,), pots=("very high",), size=5) for f in ("dry", "wet", "odd"))
    for bad in (wet, free):
        for query in (run_together(df, [dry, bad]), filter_scenario(df, bad, eager=False)):
            with pytest.raises(Exception, match="UnusableKeys: PPM"):
                query.collect()
        with pytest.raises(legend.UnusableKeys):
            filter_scenario(df, bad)
    # Rows of scenarios that need no key, or that no scenario takes, may have any.
    assert run_together(df, [dry]).count() == 1
    assert run_together(df, [dry, Scenario(name="x", flows=("wet",)), Scenario(name="y", flows=("odd",), pots=("high",), size=1)]).count() == 3
    found = workflow.run_scenarios(df, [dry, wet, free], staging=tmp_path / "s")
    assert [s.name for s, _ in found] == ["dry"]
    assert not (tmp_path / "s").exists()


def test_a_profile_holds_few_values(spark):
    df = spark.range(30_000).selectExpr("id AS subC", "cast(id % 3 AS string) AS flow", "cast(NULL AS string) AS sector", "id AS elevMin", "double(id) AS elevMax")
    (one,) = diagnostics.stage_profile([("s", df)]).collect()
    first = ",".join(sorted(map(str, range(30_000)))[:8])
    assert tuple(one) == ("s", 30_000, first + ",...", "0,1,2", "", 0.0, 29_999.0, 0.0, 29_999.0)
    (none,) = diagnostics.stage_profile([("n", df.where("subC < 0"))]).collect()
    assert tuple(none) == ("n", 0, "", "", "", None, None, None, None)
    text = plan(diagnostics.stage_profile([("s", df)]))
    assert "collect_set" not in text and text.count("Range") == 1 and "WindowGroupLimit" in text
    with pytest.raises(ValueError, match="no stages"):
        diagnostics.stage_profile([])


def test_release_and_runout_join_where_they_lie(spark, tmp_path):
    rows = with_geometry(view(spark, str(DATA / "sf0.001")).limit(400))
    runs = write_bucketed(rows, "talus_test_runs", tmp_path / "runs", 4)
    try:
        both = diagnostics.rel_res_joined(runs)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "Exchange" not in plan(both) and "SortMergeJoin" in plan(both)
        want = {}
        for r in rows.collect():
            want.setdefault((r["praID"], r["resultID"]), {}).setdefault(r["modType"].strip().lower(), []).append(bytes(r["geometry"]))
        pairs = sorted((*k, a, b) for k, v in want.items() for a in v.get("rel", []) for b in v.get("res", []))
        got = sorted((r["praID"], r["resultID"], bytes(r["rel_geometry"]), bytes(r["res_geometry"])) for r in both.collect())
        assert got == pairs and len(pairs) > 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE talus_test_runs")
