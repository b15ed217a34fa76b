"""Geometry, sinks, configuration and whole runs."""

import json
import sqlite3
import struct

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talus import sinks
from talus.functions import geometry, viewer
from talus.plans import cli, workflow
from talus.plans.scenario import filter_scenario
from talus.queries import QUERIES
from talus.sources import config, directory
from talus.sources.fixtures import directory as view
from talus.sources.fixtures import with_geometry

from .conftest import DATA

number = st.floats(-1e6, 1e6, allow_nan=False)
point = st.lists(number, min_size=2, max_size=2)
line = st.lists(point, min_size=2, max_size=5)
polygon = st.lists(line, min_size=1, max_size=3)


def shape(kind, coordinates):
    return coordinates.map(lambda c: {"type": kind, "coordinates": c})


@given(
    st.one_of(
        shape("Point", point), shape("LineString", line), shape("Polygon", polygon), shape("MultiPoint", line),
        shape("MultiLineString", polygon), shape("MultiPolygon", st.lists(polygon, min_size=1, max_size=3)),
    )
)
def test_wkb_round_trip(g):
    assert geometry.decode(geometry.encode(g)) == g


def test_wkb_variants():
    big = struct.pack(">BI2d", 0, 1, 1.5, -2.0)
    assert geometry.decode(big) == {"type": "Point", "coordinates": [1.5, -2.0]}
    extended = struct.pack("<BII3d", 1, 0xA0000001, 4326, 1, 2, 3)
    assert geometry.decode(extended)["coordinates"] == [1, 2, 3]
    assert geometry.wkt(struct.pack("<BI3d", 1, 1001, 1, 2, 3)) == "POINT Z (1 2 3)"
    assert geometry.wkt(geometry.encode({"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1.5], [0, 0]]]})) == "POLYGON ((0 0, 1 0, 1 1.5, 0 0))"
    assert geometry.wkt(None) is None and geometry.decode(None) is None
    collection = {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1.0, 2.0]}]}
    assert geometry.decode(geometry.encode(collection)) == collection
    with pytest.raises(ValueError, match="not known"):
        geometry.decode(struct.pack("<BI", 1, 99))


def winter_ini(folder, extra="", filters="winter"):
    text = f"""
[WORKFLOW]
checkAvaDirResult = False
mapperPathMode = AvaScenDirectory
{extra}
[PATHS]
baseDir = {folder}
[FILTER]
filters = {filters}
[FILTER.winter]
name = Winter A
LKRegionID = 70601, 70602
LwdRegionID = IT-32-BZ-18-02, IT-32-TN-16
subC = 500
sector = E,N,S,W
flow = dry
elevMin = 1800
elevMax = 5000
AvaDistributionPotential = very high
AvaSizePotential = 5
[FILTER.bad]
name = Bad
AvaDistributionPotential = low
AvaSizePotential = 5
[FILTER.all]
SUBC = 500, 600
elevmin = 1800.5
applySingleRsizeRule = no
"""
    path = folder / "run.ini"
    path.write_text(text)
    return path


@pytest.fixture
def tree(spark, tmp_path):
    source = with_geometry(view(spark, str(DATA / "sf0.001")))
    (tmp_path / "12_avaDirectory" / "one").mkdir(parents=True)
    sinks.write_parquet(source, tmp_path / "12_avaDirectory" / "one" / "avaDirectoryResults.parquet", crs={"id": "test"})
    return tmp_path


def test_config_rules(tmp_path):
    path = winter_ini(tmp_path, filters="all, nothere, winter")
    (tmp_path / "local_run.ini").write_text("[FILTER.winter]\nelevMin = 2000\n")
    found = config.scenarios(config.read_config(path))
    assert [s.name for s in found] == ["all", "Winter A"]
    assert found[0].sub_catchments == () and found[0].elev_min is None and not found[0].single_r_size
    assert found[1].elev_min == 2000 and found[1].stem == "WinterA" and found[1].lk == ("70601", "70602")
    with pytest.raises(FileNotFoundError):
        config.read_config(tmp_path / "none.ini")
    assert config.Scenario(name="/ /").stem == "unnamed"
    assert config.scenarios_from_bulletin("x") == []


def test_paths(tmp_path):
    cfg = config.read_config(winter_ini(tmp_path))
    assert config.resolve_paths(cfg).directory == tmp_path / "12_avaDirectory" / "avaDirectoryResults.parquet"
    for name in ("a", "b"):
        (tmp_path / "12_avaDirectory" / name).mkdir(parents=True)
        (tmp_path / "12_avaDirectory" / name / "avaDirectoryResults.parquet").touch()
        if name == "a":
            assert config.resolve_paths(cfg).directory.parent.name == "a"
    with pytest.raises(RuntimeError):
        config.resolve_paths(cfg)
    cfg["WORKFLOW"]["mapperPathMode"] = "customPaths"
    cfg["PATHS"].update({"avaDirectoryResults": "/x/y.parquet", "avaScenMapsDir": str(tmp_path / "out")})
    assert str(config.resolve_paths(cfg).directory) == "/x/y.parquet" and (tmp_path / "out").is_dir()


def test_whole_run(spark, tree):
    path = winter_ini(
        tree,
        "writeScenarioGeoJson = yes\nwriteScenarioGpkg = yes\nwriteScenarioCsv = yes\nwriteScenarioCsvWkt = yes\nmapperMakeMaster = yes",
        "winter, bad, all",
    )
    assert cli.main(["--cfg", str(path)]) == 0
    out = tree / "13_avaScenMaps"
    assert spark.read.parquet(f"file://{out}/avaScen_WinterA.parquet").count() == 32
    assert not (out / "avaScen_Bad.parquet").exists()
    whole = json.loads((out / "avaScen_WinterA.geojson").read_text())
    assert whole["type"] == "FeatureCollection" and len(whole["features"]) == 32
    assert {f["geometry"]["type"] for f in whole["features"]} == {"Polygon", "MultiPolygon"}
    assert (out / "avaScen_WinterA.csv").read_text().count("POLYGON") == 32
    db = sqlite3.connect(out / "avaScen_WinterA.gpkg")
    assert db.execute('SELECT count(*) FROM "avaScen_WinterA"').fetchone() == (32,)
    assert db.execute("PRAGMA application_id").fetchone() == (0x47504B47,)
    assert spark.read.parquet(f"file://{out}/avaScen_Master.parquet").count() == 32 + spark.read.parquet(f"file://{out}/avaScen_all.parquet").count()
    assert directory.read_crs(str(out / "avaScen_WinterA.parquet")) == {"id": "test"}
    assert not [p for p in out.iterdir() if p.name.startswith(".")] and list(out.glob("*.log"))
    # What exists is not made again.
    before = (out / "avaScen_WinterA.parquet").stat().st_mtime_ns
    (out / "avaScen_all.parquet").unlink()
    assert workflow.run(config.read_config(path)) == []
    assert (out / "avaScen_WinterA.parquet").stat().st_mtime_ns == before


def test_early_ends_and_exit_codes(spark, tree):
    assert cli.main(["--cfg", str(tree / "none.ini")]) == 1
    path = winter_ini(tree, filters="")
    assert cli.main(["--cfg", str(path)]) == 0
    path.write_text(path.read_text().replace("checkAvaDirResult = False", "checkAvaDirResult = True").replace("filters = ", "filters = winter"))
    assert cli.main(["--cfg", str(path)]) == 0
    path.write_text(path.read_text().replace("applySingleRsizeRule = no", "").replace("flow = dry", "applySingleRsizeRule = perhaps").replace("checkAvaDirResult = True", ""))
    assert cli.main(["--cfg", str(path)]) == 1
    assert not list((tree / "13_avaScenMaps").glob("*.parquet"))


def test_a_failing_scenario_or_sink_stops_no_other(spark, tmp_path):
    df = view(spark, str(DATA / "sf0.001"))
    broken = df.withColumn("PPM", df.PPM + 0.5)
    results = workflow.run_scenarios(broken, [config.Scenario(name="x", pots=("high",), size=4), config.Scenario(name="y")])
    assert [s.name for s, _ in results] == ["y"]
    (tmp_path / "gone").write_text("a file where a folder should be")
    to = sinks.Outputs(parquet=tmp_path / "a.parquet", geojson=tmp_path / "gone" / "x.geojson", csv=tmp_path / "a.csv")
    assert sinks.write(df.limit(3), to) == [tmp_path / "a.parquet", tmp_path / "a.csv"]
    assert sinks.write(df.limit(0), to) == []


def test_same_stem_warns(tmp_path, caplog):
    cfg = config.read_config(winter_ini(tmp_path))
    both = [config.Scenario(name="Winter A"), config.Scenario(name="WinterA")]
    assert len(workflow.pending(cfg, tmp_path, both)) == 2
    assert "share the file stem" in caplog.text


def test_geojson_source_with_mixed_shapes(spark, tmp_path):
    rows = with_geometry(view(spark, str(DATA / "sf0.001")).limit(20))
    path = tmp_path / "in.GEOJSON"
    sinks.write_geojson(rows, path)
    back = directory.read_directory(spark, f"file://{path}")
    assert sorted(map(repr, back.select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))
    with pytest.raises(FileNotFoundError):
        directory.read_directory(spark, str(tmp_path / "none.parquet"))


def test_scenarios_of_a_run_share_one_scan(spark, tmp_path, monkeypatch):
    """The joint plan of a configured run pushes the scenarios' disjunction to the scan, and stages each apart."""
    source = view(spark, str(DATA / "sf0.001"))
    source.write.parquet(str(tmp_path / "12_avaDirectory" / "one" / "avaDirectoryResults.parquet"))
    path = winter_ini(tmp_path, "logFilterSteps = yes\nsortOutputs = yes", "winter, spring")
    path.write_text(path.read_text() + "[FILTER.spring]\nname = Spring\nLKRegionID = 70601\nelevMin = 1800\nelevMax = 2200\nAvaDistributionPotential = very high\nAvaSizePotential = 3\n")
    seen = []
    real = workflow.run_together

    def spied(df, scenarios, rows):
        out = real(df, scenarios, rows)
        spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
        seen.append(out._jdf.queryExecution().executedPlan().toString())
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        return out

    monkeypatch.setattr(workflow, "run_together", spied)
    monkeypatch.setattr(workflow, "filter_scenario", lambda *a: pytest.fail("run alone"))
    written = workflow.run(config.read_config(path))
    assert sorted(p.name for p in written) == ["avaScen_Spring.parquet", "avaScen_WinterA.parquet"]
    (plan,) = seen
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert "Or(" in pushed and "GreaterThanOrEqual(elevMin,1800" in pushed and "In(LKGebietID, [70601,70602])" in pushed
    assert plan.count("FileScan") <= 1 + plan.count("Union") and "InMemoryTableScan" not in plan
    monkeypatch.undo()
    for s in config.scenarios(config.read_config(path)):
        alone = filter_scenario(source, s)
        joint = spark.read.parquet(f"file://{tmp_path}/13_avaScenMaps/avaScen_{s.stem}.parquet")
        assert joint.columns == alone.columns and sorted(joint.collect()) == sorted(alone.collect())
        sizes = [r["rSize"] for r in joint.coalesce(1).collect()]
        assert sizes == sorted(sizes, reverse=True)


def test_a_joint_failure_falls_back_to_single_runs(spark, tmp_path):
    df = view(spark, str(DATA / "sf0.001"))
    broken = df.withColumn("PPM", df.PPM + 0.5)
    both = [config.Scenario(name="x", pots=("high",), size=4), config.Scenario(name="y"), config.Scenario(name="z", lk=("70601",))]
    results = workflow.run_scenarios(broken, both, staging=tmp_path / "staging")
    assert [s.name for s, _ in results] == ["y", "z"]
    whole = workflow.run_scenarios(df, both, staging=tmp_path / "again")
    assert [s.name for s, _ in whole] == ["x", "y", "z"]
    for s, result in whole:
        alone = filter_scenario(df, s)
        assert set(result.columns) == set(alone.columns)
        assert sorted(result.select(*alone.columns).collect()) == sorted(alone.collect())


def test_folder_outputs(spark, tmp_path):
    rows = view(spark, str(DATA / "sf0.001")).limit(50)
    sinks.write_parquet(rows, tmp_path / "d.parquet", single_file=False)
    assert spark.read.parquet(f"file://{tmp_path}/d.parquet").count() == 50
    shaped = with_geometry(rows).repartition(3)
    sinks.write_parquet(shaped, tmp_path / "g.parquet", single_file=False, crs={"id": "x"})
    parts = list((tmp_path / "g.parquet").glob("part-*.parquet"))
    assert len(parts) > 1 and all(directory.read_crs(str(p)) == {"id": "x"} for p in parts)
    assert sorted(map(repr, spark.read.parquet(f"file://{tmp_path}/g.parquet").collect())) == sorted(map(repr, shaped.collect()))


def test_a_geopackage_is_read_back_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "_CHUNK", 7)
    rows = with_geometry(view(spark, str(DATA / "sf0.001")).limit(40)).selectExpr(
        "*", "praID % 2 = 0 AS even", "nullif(flow, 'DRY ') AS odd", "date_add(date'2026-01-01', int(praID % 9)) AS day", "int(PPM) AS `a b`"
    )
    rows = rows.withColumn("geometry", F.when(F.col("even"), F.col("geometry"))).localCheckpoint()
    sinks.write_gpkg(rows, tmp_path / "a #1.gpkg")
    monkeypatch.setattr(sinks, "read_gpkg", lambda *a: pytest.fail("all rows pass the driver"))
    back = sinks.scan_gpkg(spark, tmp_path / "a #1.gpkg", rows.schema)
    assert back.schema.simpleString() == rows.schema.simpleString() and back.rdd.getNumPartitions() > 1
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))
    sinks.write_gpkg(rows.limit(0), tmp_path / "none.gpkg")
    assert sinks.scan_gpkg(spark, tmp_path / "none.gpkg", rows.schema).collect() == []
    assert QUERIES["sink_gpkg"](spark, str(DATA / "sf0.001")).count() == 32


def test_viewer_columns(spark):
    df = spark.createDataFrame([("REL", "", "#123456", 0.2), ("res", None, None, 9.0), (None, "#ffffff", "", None)], "modType string, hexSize string, hex_rel string, v double")
    rows = viewer.styled(df).withColumn("ramp", viewer.ramp_color(df.v)).collect()
    assert [r["viewer_visible"] for r in rows] == [True, False, False]
    assert [r["viewer_hex"] for r in rows] == ["#123456", "#808080", "#808080"]
    assert [r["ramp"] for r in rows] == ["#09a2ff", "#5b0069", None]
    assert [r["viewer_hex"] for r in viewer.styled(df, by_size=True, show_res=True).collect()] == ["#808080", "#808080", "#ffffff"]
    assert viewer.popup(df).columns == ["modType"]
