"""Edge cases of the selection semantics, on hand-made rows."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from talus.functions.normalize import normalize
from talus.operators import dedup, diagnostics, legend, matrix, predicates
from talus.plans.scenario import filter_scenario, filtered, master, run_together
from talus.sources.config import Scenario, as_list

BASE = dict(
    praID=1, resultID="a", modType="rel", LKGebietID="70601", LWDGebietID="X", subC=500, sector="E", elevMin=1800.0,
    elevMax=5000.0, flow="dry", PPM=5, PEM=5, rSize=5,
)


def frame(spark, *changes, schema=None):
    return spark.createDataFrame([Row(**(BASE | c)) for c in changes], schema)


def ids(df):
    return sorted(r["resultID"] for r in df.collect())


def test_nan_elevation_is_dropped_and_edges_are_kept(spark):
    df = frame(spark, {"elevMin": math.nan}, {"resultID": "edge"}, {"resultID": "low", "elevMin": 1700.0, "elevMax": 1900.0})
    assert ids(filtered(normalize(df), Scenario(elev_min=1800, elev_max=5000))) == ["edge"]


def test_elevation_predicates_reach_the_scan(spark, tmp_path):
    frame(spark, {}).write.parquet(f"{tmp_path}/t")
    df = filter_scenario(spark.read.parquet(f"{tmp_path}/t"), Scenario(lk=("70601", "70602"), elev_min=1800, elev_max=5000))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for pushed in ("GreaterThanOrEqual(elevMin,1800.0)", "LessThanOrEqual(elevMax,5000.0)", "In(LKGebietID, [70601,70602])"):
        assert pushed in plan


def test_blanks_of_any_kind_are_stripped(spark):
    df = frame(spark, {"flow": "\tDry\n", "modType": " REL "})
    row = normalize(df).first()
    assert (row["flow"], row["modType"]) == ("dry", "rel")


def test_normalise_is_idempotent_and_keeps_nulls(spark):
    df = frame(spark, {"flow": None, "resultID": "n"}, {"flow": " Wet "})
    once = normalize(df)
    assert once.collect() == normalize(once).collect()
    assert {r["flow"] for r in once.collect()} == {None, "wet"}


def test_text_numbers(spark):
    df = spark.createDataFrame([("1d",), (" 12 ",), ("abc",), (None,), ("2.5",), ("NaN",), ("1e3",)], "subC string")
    assert [r[0] for r in normalize(df).collect()] == [None, 12.0, None, None, 2.5, None, 1000.0]


def test_sector_is_an_exact_token(spark):
    df = frame(spark, {"sector": "NE"}, {"sector": " e", "resultID": "b"})
    out = filtered(normalize(df), Scenario(sectors=("E",)))
    assert [(r["resultID"], r["sector"]) for r in out.collect()] == [("b", "E")]


@pytest.mark.parametrize("value", [70601, 70601.0, "70601"])
def test_region_ids_compare_as_text(spark, value):
    df = frame(spark, {"LKGebietID": value})
    assert df.where(predicates.region(df, lk=["IT-32", "70601"])).count() == 1


def test_region_modes_and_missing_columns(spark):
    df = frame(spark, {}, {"resultID": "b", "LWDGebietID": "Y"}, {"resultID": "c", "LKGebietID": "0"})
    pick = lambda mode, lwd=("Y",): ids(df.where(predicates.region(df, ["70601"], lwd, mode)))
    assert pick("or") == ["a", "b"] and pick(" AND ") == ["b"] and pick("nonsense") == ["a", "b"]
    assert predicates.region(df) is None
    assert predicates.region(df.drop("LKGebietID"), ["70601"]) is None
    assert ids(df.drop("LKGebietID").where(predicates.region(df.drop("LKGebietID"), ["70601"], ["Y"], "and"))) == ["b"]


def test_fractional_sub_catchment_matches_its_number(spark):
    df = frame(spark, {"subC": 500.0}, {"subC": 500.5, "resultID": "b"})
    assert ids(filtered(normalize(df), Scenario(sub_catchments=(500,)))) == ["a"]


@pytest.mark.parametrize("bad", [4.5, math.inf])
def test_fractional_keys_fail_loudly(spark, bad):
    df = frame(spark, {"PPM": 5.0}, {"PPM": bad})
    with pytest.raises(legend.UnusableKeys):
        filter_scenario(df, Scenario(pots=("very high",), size=5))
    # Rows that the scenario filters drop don't count.
    ok = frame(spark, {"PPM": 5.0}, {"PPM": bad, "flow": "wet"})
    assert filter_scenario(ok, Scenario(flows=("dry",), pots=("very high",), size=5)).count() == 1


def test_case_of_key_columns(spark, case_sensitive):
    df = frame(spark, {}).withColumnRenamed("PPM", "ppm").withColumnRenamed("PEM", "Pem")
    assert {"PPM", "PEM"} <= set(normalize(df).columns)
    with pytest.raises(ValueError, match="differ only in case"):
        normalize(frame(spark, {}).withColumn("ppm", F.lit(1)))


def test_matrix_has_all_rows():
    rows = matrix.cells()
    assert len(rows) == 56
    assert sum(c.mod_type == "res / rel" for c in rows) == 30
    assert sum(len(c.mod_type.split(" / ")) for c in rows) == 86
    assert matrix.max_sizes(rows, ["very high", "high", "moderat", "low", "x"]) == {"very high": 5, "high": 4, "moderate": 3, "low": 2, "x": None}
    assert [matrix.r_size_of(5, 5 - d) for d in (0, 1, 2, 3, 4, -1)] == [5, 4, 3, 2, 1, 1]


def test_undefined_cell_gives_no_rows_and_no_tags(spark):
    out = filter_scenario(frame(spark, {}), Scenario(pots=("low",), size=5))
    assert out.count() == 0 and "AvaSizePotential" not in out.columns


@pytest.mark.parametrize(("pots", "size", "rows"), [((), 5, 1), (("very high",), None, 1), (("very high",), 0, 0)])
def test_when_the_matrix_stage_runs(spark, pots, size, rows):
    out = filter_scenario(frame(spark, {}), Scenario(pots=pots, size=size))
    assert out.count() == rows and "AvaSizePotential" not in out.columns


def test_blank_levels_run_the_stage_and_find_nothing(spark):
    s = Scenario.from_criteria({"AvaDistributionPotential": " , ", "AvaSizePotential": 5})
    assert s.uses_matrix and filter_scenario(frame(spark, {}), s).count() == 0


def test_partly_unknown_levels_and_alias(spark):
    df = frame(spark, {"PPM": 5, "PEM": 4, "rSize": 4})
    out = filter_scenario(df, Scenario(pots=("foo", "High"), size=4)).first()
    assert (out["AvaDistributionPotential"], out["AvaSizePotential"]) == ("foo,high", 4)
    df = frame(spark, {"PPM": 5, "PEM": 3, "rSize": 3})
    assert filter_scenario(df, Scenario(pots=("moderat",), size=3)).first()["AvaDistributionPotential"] == "moderate"


def test_tags_overwrite_input_columns(spark):
    df = frame(spark, {}).withColumn("AvaSizePotential", F.lit("old"))
    assert filter_scenario(df, Scenario(pots=("very high",), size=5)).first()["AvaSizePotential"] == 5


def test_rel_only_cells_never_give_runouts(spark):
    df = frame(spark, {"PPM": 2, "PEM": 1, "rSize": 4}, {"PPM": 2, "PEM": 1, "rSize": 4, "modType": "res", "resultID": "b"})
    assert ids(filter_scenario(df, Scenario(pots=("high",), size=4))) == ["a"]


def test_size_one_takes_release_areas_whatever_their_cells(spark):
    df = frame(spark, {"PPM": 9, "PEM": 3}, {"PEM": 2, "resultID": "b", "PPM": 9}, {"modType": "res", "PEM": 1, "resultID": "c"}, {"praID": 2, "PEM": None, "resultID": "d"})
    out = filter_scenario(df, Scenario(pots=("very high",), size=1))
    assert ids(out) == ["b", "d"]
    assert filter_scenario(df.drop("modType"), Scenario(pots=("very high",), size=1)).count() == 0


def test_missing_key_columns_give_no_rows(spark):
    assert filter_scenario(frame(spark, {}).drop("PEM"), Scenario(pots=("very high",), size=5)).count() == 0


def test_custom_matrix(spark):
    rows = matrix.from_frame(spark.createDataFrame([(" Wild ", 7, 5, 5, 5, "REL")], "AvaDistributionPotential string, AvaSizePotential int, PPM int, PEM int, rSize int, modType string"))
    assert filter_scenario(frame(spark, {}), Scenario(pots=("wild",), size=7), rows).count() == 1


def test_a_matrix_with_null_cells_in_one_pass(spark):
    schema = "AvaDistributionPotential string, AvaSizePotential int, PPM int, PEM int, rSize int, modType string"
    rows = matrix.from_frame(spark.createDataFrame([("wild", 7, 5, 5, 5, "rel"), ("wild", 7, None, 5, 5, "rel"), ("wild", 7, 4, None, None, "res / rel")], schema))
    s = Scenario(pots=("wild",), size=7)
    assert ids(run_together(frame(spark, {}), [s, s], rows)) == ids(filter_scenario(frame(spark, {}), s, rows)) * 2 == ["a", "a"]


def test_dedup_keeps_the_largest_and_breaks_ties_by_id(spark):
    df = frame(spark, {"rSize": 3, "resultID": "a"}, {"rSize": 4, "resultID": "c"}, {"rSize": 4, "resultID": "b"}, {"rSize": None, "resultID": "0"})
    assert ids(dedup.single_r_size(df)) == ["b"]
    df = df.withColumn("LKRegion", F.lit(None).cast("string"))
    assert ids(dedup.single_r_size(df)) == ["b"]
    assert dedup.single_r_size(df.drop("rSize")).count() == 4
    assert filter_scenario(df, Scenario(single_r_size=False)).count() == 4


def test_master_fills_missing_columns(spark):
    tagged = filter_scenario(frame(spark, {}), Scenario(pots=("very high",), size=5))
    plain = filter_scenario(frame(spark, {"resultID": "b"}), Scenario())
    rows = {r["resultID"]: r["AvaSizePotential"] for r in master([tagged, plain]).collect()}
    assert rows == {"a": 5, "b": None}


SCENARIOS = [
    Scenario(name="a", lk=("70601",), pots=("very high",), size=5),
    Scenario(name="b", sectors=("E",), single_r_size=False),
    Scenario(name="c", pots=("high", "very high"), size=1),
    Scenario(name="d", pots=("low",), size=5),
    Scenario(name="e", lwd=("Y",), flows=("wet",), pots=("high",), size=3),
]
row = st.fixed_dictionaries(
    {
        "praID": st.integers(1, 3),
        "modType": st.sampled_from(["rel", "RES "]),
        "LKGebietID": st.sampled_from(["70601", "1"]),
        "LWDGebietID": st.sampled_from(["X", "Y"]),
        "sector": st.sampled_from(["E", "ne", " e"]),
        "flow": st.sampled_from(["dry", "Wet"]),
        "PPM": st.integers(2, 5),
        "PEM": st.integers(1, 5),
        "rSize": st.integers(1, 5),
    }
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25))
def test_one_pass_equals_scenario_by_scenario(spark, changes):
    df = frame(spark, *(c | {"resultID": f"{i:03}"} for i, c in enumerate(changes)))
    together = run_together(df, SCENARIOS)
    names = [c for c in together.columns if c != "scenario"]
    got = sorted((r["scenario"], *map(repr, (r[c] for c in names))) for r in together.collect())
    want = []
    for i, s in enumerate(SCENARIOS):
        one = filter_scenario(df, s)
        result = {r["resultID"] for r in one.collect()}
        assert result <= {f"{k:03}" for k in range(len(changes))}
        for r in one.collect():
            want.append((i, *(repr(r[c]) if c in one.columns else "None" for c in names)))
    assert got == sorted(want)


def test_diagnostics_on_edge_rows(spark):
    df = normalize(frame(spark, {"praID": None, "elevMin": math.nan}, {"resultID": "b", "modType": "res"}))
    assert diagnostics.scenario_summary(df).first().asDict() == {"total": 2, "n_res": 1, "n_rel": 1, "n_areas": 1}
    ranges = {r["attribute"]: (r["low"], r["high"]) for r in diagnostics.available_options(df).collect()}
    assert ranges["elevMin"] == (1800.0, 1800.0) and "praAreaM" not in ranges
    assert diagnostics.check_input(df.drop("flow")).first().asDict() == {"missing": "flow", "empty": False, "ok": False}
    assert diagnostics.check_input(df.limit(0)).first()["empty"]
    assert diagnostics.join_key_topn(df).count() == 2


def test_lists():
    assert as_list(None) == [] and as_list(" a, ,b ") == ["a", "b"] and as_list((1, 2)) == [1, 2]
