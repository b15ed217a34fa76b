"""GeoJSON cut anywhere, outputs written by tasks, and runs on other file systems than this machine's."""

import json
import logging
import sqlite3

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talus import sinks
from talus.functions import geometry
from talus.plans import cli, workflow
from talus.plans.scenario import filter_scenario
from talus.sources import config, directory, files, geojson
from talus.sources.files import Uri
from talus.sources.fixtures import directory as view
from talus.sources.fixtures import with_geometry

from .conftest import DATA
from .test_outputs import winter_ini

POINT = {"type": "Point", "coordinates": [1.0, 2.0]}
#: Braces, quotes and brackets in texts, members that look like features, features that look like members.
TRICKY = {
    "type": "FeatureCollection",
    "name": 'a}b{"features":[{',
    "note": {"features": [{"x": 1}], "y": "]"},
    "crs": {"properties": {"name": "x"}},
    "features": [
        {"type": "Feature", "properties": {"a": '}{][\\"', "b": {"c": [{"d": 1}]}, "features": "q"}, "geometry": POINT},
        {"properties": {}, "geometry": None, "type": "Feature"},
        {"type": "Feature", "properties": {"a": "\\", "é}": "漢"}, "geometry": {"type": "GeometryCollection", "geometries": [POINT, POINT]}},
    ],
    "more": {"z": {"features": [{"n": 1}]}},
    "features2": [{"type": "Feature"}],
    "}features": [{"q": 1}],
}
FORMS = {
    "compact": lambda d: json.dumps(d, separators=(",", ":"), ensure_ascii=False),
    "plain": json.dumps,
    "indented": lambda d: json.dumps(d, indent=2) + "\n",
}


def cut(splits):
    """What the reader does, split by split, without Spark."""
    starts = geojson.starts((i, geojson.Effect(False).feed(s), geojson.Effect(True).feed(s)) for i, s in enumerate(splits))
    heads = {}
    for i, s in enumerate(splits):
        if starts[i].is_open:
            heads.setdefault(starts[i].owner, []).append(next(geojson.cut(s, starts[i]))[2])
    out = []
    for i, s in enumerate(splits):
        out += [text if ended else text + "".join(heads.get(i, [])) for begun, ended, text in geojson.cut(s, starts[i]) if begun]
    return [json.loads(text) for text in out]


@pytest.mark.parametrize("form", FORMS)
def test_every_cut_in_two_and_three(form):
    records = FORMS[form](TRICKY).split("}")
    for i in range(len(records) + 1):
        for j in range(i, len(records) + 1):
            splits = [s for s in (records[:i], records[i:j], records[j:]) if s]
            assert cut(splits) == TRICKY["features"], (i, j)
    assert cut([[r] for r in records]) == TRICKY["features"]


@pytest.mark.parametrize("odd", [{}, {"features": []}, {"features": [], "a": [{}]}, {"features": {"a": 1}}, {"type": "Feature", "geometry": POINT}, [], [{"features": [{}]}]])
def test_collections_without_features(odd):
    records = json.dumps(odd).split("}")
    assert cut([records]) == [] and cut([[r] for r in records]) == []


@pytest.fixture
def split_bytes(spark):
    def to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("n", [13, 61, 10_000])
def test_splits_of_spark(spark, tmp_path, split_bytes, n):
    text = FORMS["compact"](TRICKY)
    (tmp_path / "tricky.geojson").write_text(text, encoding="utf-8")
    split_bytes(n)
    found = geojson.features(spark, f"file://{tmp_path}/tricky.geojson")
    assert sorted(json.dumps(json.loads(r["feature"])) for r in found.collect()) == sorted(map(json.dumps, TRICKY["features"]))


def test_a_file_of_many_ranges_is_read_by_as_many_tasks(spark, tmp_path, split_bytes):
    rows = with_geometry(view(spark, str(DATA / "sf0.001")).limit(3000))
    path = tmp_path / "in.geojson"
    sinks.write_geojson(rows, path)
    ranges = 12
    split_bytes(-(-path.stat().st_size // ranges))
    back = directory.read_directory(spark, str(path))
    parts = back.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= ranges - 1 and max(r["count"] for r in parts) < 3000 / 6
    assert sorted(map(repr, back.select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))
    # A folder of collections is read as one.
    sinks.write_geojson(rows.repartition(3), tmp_path / "parts.geojson", parts=True)
    names = list((tmp_path / "parts.geojson").glob("part-*"))
    assert len(names) == 3 and sum(len(json.loads(p.read_text())["features"]) for p in names) == 3000
    again = directory.read_directory(spark, str(tmp_path / "parts.geojson"))
    assert sorted(map(repr, again.select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))


@pytest.fixture
def no_rows_to_driver(monkeypatch):
    def barred(self, *a, **b):
        raise AssertionError("rows through the driver")

    for name in ("collect", "toLocalIterator", "toPandas", "toArrow", "take", "head"):
        monkeypatch.setattr(DataFrame, name, barred)
    return monkeypatch


def test_geojson_is_written_by_tasks(spark, tmp_path, no_rows_to_driver):
    rows = with_geometry(view(spark, str(DATA / "sf0.001"))).repartition(5).sortWithinPartitions("resultID", "modType")
    sinks.write_geojson(rows, tmp_path / "x.geojson")
    sinks.write_geojson(rows.where("subC < 0"), tmp_path / "none.geojson")
    no_rows_to_driver.undo()
    want = [r["resultID"] for r in rows.collect()]
    whole = json.loads((tmp_path / "x.geojson").read_text())
    assert [f["properties"]["resultID"] for f in whole["features"]] == want and whole["name"] == "x"
    assert json.loads((tmp_path / "none.geojson").read_text())["features"] == []
    assert sorted(p.name for p in tmp_path.iterdir()) == ["none.geojson", "x.geojson"]


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    rows = view(spark, str(DATA / "sf0.001")).repartition(4)
    broken = rows.withColumn("bad", F.when(F.col("praID") % 50 == 3, F.raise_error(F.lit("broken"))))
    (tmp_path / "old.geojson").write_text("old")
    for write, name in ((sinks.write_geojson, "x.geojson"), (sinks.write_gpkg, "x.gpkg"), (sinks.write_csv, "x.csv"), (sinks.write_parquet, "x.parquet"), (sinks.write_geojson, "old.geojson")):
        with pytest.raises(Exception, match="broken"):
            write(broken.withColumn("bad", F.col("bad").cast("string")), tmp_path / name)
    assert [p.name for p in tmp_path.iterdir()] == ["old.geojson"] and (tmp_path / "old.geojson").read_text() == "old"


def test_geopackage_of_tasks_with_its_extent(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "_CHUNK", 100)
    rows = with_geometry(view(spark, str(DATA / "sf0.001")).limit(1000)).repartition(3)
    rows = rows.withColumns({"when": F.lit("2020-01-02 03:04:05").cast("timestamp"), 'odd "name"': F.col("subC") > 500, "none": F.lit(None).cast("double")})
    sinks.write_gpkg(rows, tmp_path / "x.gpkg")
    back = sinks.read_gpkg(tmp_path / "x.gpkg")
    want = [r.asDict() for r in rows.collect()]
    assert [r["fid"] for r in back] == list(range(1, 1001)) and [r["resultID"] for r in back] == [w["resultID"] for w in want]
    assert [bytes(r["geometry"]) for r in back] == [bytes(w["geometry"]) for w in want]
    assert {r["when"] for r in back} == {"2020-01-02 03:04:05"} and {r["none"] for r in back} == {None}
    boxes = [geometry.bounds(w["geometry"]) for w in want]
    extent = (min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes))
    db = sqlite3.connect(tmp_path / "x.gpkg")
    assert db.execute("SELECT min_x, min_y, max_x, max_y FROM gpkg_contents").fetchone() == extent
    assert db.execute("SELECT name FROM sqlite_master WHERE name IN ('layer', 'part')").fetchall() == []
    assert [p.name for p in tmp_path.iterdir()] == ["x.gpkg"]


def test_bounds():
    encode = geometry.encode
    assert geometry.bounds(None) is None and geometry.bounds(encode({"type": "Point", "coordinates": []})) is None
    assert geometry.bounds(encode({"type": "Point", "coordinates": [3.0, -1.0]})) == (3, -1, 3, -1)
    assert geometry.bounds(encode({"type": "MultiPoint", "coordinates": [[0.0, 5.0], [2.0, 1.0]]})) == (0, 1, 2, 5)
    multi = {"type": "MultiPolygon", "coordinates": [[[[0.0, 0.0], [9.0, 0.0], [0.0, 4.0], [0.0, 0.0]]], [[[-1.0, 2.0], [0.0, 2.0], [0.0, 3.0], [-1.0, 2.0]]]]}
    assert geometry.bounds(encode(multi)) == (-1, 0, 9, 4)
    both = {"type": "GeometryCollection", "geometries": [multi, {"type": "Point", "coordinates": [1.0, 7.0, 3.0]}]}
    assert geometry.bounds(encode(both)) == (-1, 0, 9, 7)
    assert geometry.bounds(encode({"type": "GeometryCollection", "geometries": []})) is None


def test_places():
    assert files.place("file:///a/b") == files.place("/a/b") and str(files.place("~/x")).startswith("/")
    at = files.place("viewfs://store/in/x.geojson")
    assert isinstance(at, Uri) and (at.name, at.stem, at.suffix, str(at.parent)) == ("x.geojson", "x", ".geojson", "viewfs://store/in")
    assert str(at.parent / "y") == "viewfs://store/in/y" and str(at.with_name("z")) == "viewfs://store/in/z"
    assert files.beside(at).name.startswith(".x.geojson.")


@pytest.fixture
def store(spark, tmp_path):
    """A folder by a path that only Spark can read."""
    (tmp_path / "disk").mkdir()
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.talus.link./t", f"file://{tmp_path}/disk")
    spark._jvm.org.apache.hadoop.fs.FileSystem.closeAll()
    yield files.place("viewfs://talus/t")
    spark._jvm.org.apache.hadoop.fs.FileSystem.closeAll()


@pytest.mark.parametrize("single", ["yes", "no"])
def test_a_whole_run_on_another_file_system(spark, store, tmp_path, single):
    source = with_geometry(view(spark, str(DATA / "sf0.001")))
    sinks.write_parquet(source, store / "12_avaDirectory" / "one" / "avaDirectoryResults.parquet", single_file=single == "yes", crs={"id": "test"})
    extra = f"writeScenarioGeoJson = yes\nwriteScenarioGpkg = yes\nwriteScenarioCsv = yes\nmapperMakeMaster = yes\nsingleFiles = {single}"
    path = winter_ini(tmp_path, extra, "winter, bad, all")
    path.write_text(path.read_text().replace(f"baseDir = {tmp_path}", f"baseDir = {store}"))
    assert cli.main(["--cfg", str(path)]) == 0
    out = store / "13_avaScenMaps"
    here = tmp_path / "disk" / "13_avaScenMaps"
    scenario = config.scenarios(config.read_config(path))[0]
    want = sorted(map(repr, filter_scenario(source, scenario).collect()))
    for ending in ("parquet", "geojson"):
        back = directory.read_directory(spark, str(out / f"avaScen_WinterA.{ending}"))
        if ending == "parquet":
            assert sorted(map(repr, back.select(*filter_scenario(source, scenario).columns).collect())) == want
        assert back.count() == 32
    assert spark.read.option("header", True).option("multiLine", True).csv(str(out / "avaScen_WinterA.csv")).count() == 32
    assert sqlite3.connect(here / "avaScen_WinterA.gpkg").execute('SELECT count(*) FROM "avaScen_WinterA"').fetchone() == (32,)
    assert not files.exists(out / "avaScen_Bad.parquet") and files.exists(out / "avaScen_Master.parquet")
    assert directory.read_crs(str(out / "avaScen_WinterA.parquet")) == {"id": "test"} == directory.read_crs(str(out / "avaScen_Master.parquet"))
    assert files.is_folder(out / "avaScen_WinterA.parquet") == files.is_folder(out / "avaScen_WinterA.geojson") == (single == "no")
    left = [p.name for p in here.iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]
    assert not left and list(here.glob("run_*.log"))
    # What is there in whole is not made again; a folder that isn't, is.
    assert workflow.run(config.read_config(path)) == []
    if single == "no":
        files.delete(out / "avaScen_WinterA.parquet" / files.DONE)
        for ending in ("geojson", "csv", "gpkg"):
            files.delete(out / f"avaScen_WinterA.{ending}")
        assert workflow.run(config.read_config(path)) != []


def test_a_store_without_renames(spark, store, monkeypatch):
    monkeypatch.setattr(files, "_renamed", lambda *a: False)
    monkeypatch.setattr(files, "_renamed_over", lambda *a: False)
    copied = []
    real = files._copy
    monkeypatch.setattr(files, "_copy", lambda a, b: (copied.append(b.name), real(a, b)))
    rows = view(spark, str(DATA / "sf0.001")).repartition(3)
    for _ in range(2):
        sinks.write_parquet(rows, store / "a.parquet", single_file=False)
        assert copied[-1] == files.DONE and files.is_complete(store / "a.parquet")
        assert spark.read.parquet(str(store / "a.parquet")).count() == rows.count()
    sinks.write_csv(rows.limit(5), store / "a.csv")
    sinks.write_geojson(rows.limit(5), store / "a.geojson")
    assert directory.read_directory(spark, str(store / "a.geojson")).count() == 5
    assert sorted(p.name for p in files.listed(store, "*")) == ["a.csv", "a.geojson", "a.parquet"]


def test_places_of_one_machine_are_refused_on_a_cluster(spark, tmp_path, monkeypatch):
    rows = view(spark, str(DATA / "sf0.001")).limit(3)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077")
    for write in (sinks.write_parquet, sinks.write_geojson, sinks.write_gpkg, sinks.write_csv):
        with pytest.raises(RuntimeError, match="own disk"):
            write(rows, tmp_path / "x")
    assert sinks.write(rows, sinks.Outputs(parquet=tmp_path / "y.parquet")) == []
    spark.conf.set(files.MOUNTS, f"/mnt/none, {tmp_path}")
    try:
        sinks.write_csv(rows, tmp_path / "x.csv")
    finally:
        spark.conf.unset(files.MOUNTS)
    assert [p.name for p in tmp_path.iterdir()] == ["x.csv"]


def test_coordinate_systems(spark, tmp_path, store):
    rows = with_geometry(view(spark, str(DATA / "sf0.001")).limit(5))
    for at in (tmp_path / "a.parquet", store / "a.parquet"):
        sinks.write_parquet(rows, at, crs={"id": "x"})
        assert directory.read_crs(str(at)) == {"id": "x"}
        assert sorted(map(repr, spark.read.parquet(files.spark_path(at)).collect())) == sorted(map(repr, rows.collect()))
    sinks.write_parquet(rows.drop("geometry"), store / "b.parquet")
    assert directory.read_crs(str(store / "b.parquet")) is None and directory.read_crs(str(store / "none")) is None


def test_the_log_goes_where_the_run_does(store):
    handler = workflow.start_log(store / "logs")
    logging.getLogger("talus").info("said")
    logging.getLogger("talus").removeHandler(handler)
    handler.close()
    (log,) = files.listed(store / "logs", "run_*.log")
    assert files.size(log) > 0


def test_folders(store, tmp_path):
    for base in (tmp_path / "x", store / "x"):
        files.make_folder(base / "a" / "b")
        files.joined([], base / "a" / "b" / "f.txt", "head", "tail")
        assert files.listed(base, "*", "b") == [base / "a" / "b"] and files.listed(base / "none", "*") == []
        assert files.is_folder(base / "a") and not files.is_complete(base / "a") and files.size(base / "a" / "b" / "f.txt") == 8
        files.delete(base / "a")
        files.delete(base / "a")
        assert not files.exists(base / "a")
