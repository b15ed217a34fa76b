"""Scenario outputs: Parquet, CSV, GeoJSON and GeoPackage, on any file system that Spark knows.

Everything is written beside its place and put there at the end, so that a
half-written output never looks like a whole one. Tasks write all rows; the
driver joins or merges what they wrote, as bytes. Parquet and CSV are single
files where ``single_file`` is set (results are of scenario size) and folders of
part files otherwise; GeoJSON is one FeatureCollection, or with ``parts`` one for
each task; GeoPackage is a single file by nature.
"""

from __future__ import annotations

import json
import logging
import sqlite3
import struct
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from talus.functions.geometry import bounds, decode, wkb_to_geojson, wkb_to_wkt
from talus.schema import GEOMETRY
from talus.shipping import with_package
from talus.sources import files
from talus.sources.directory import COMMON
from talus.sources.files import Place, Uri

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outputs:
    """Where to write; None leaves a format out."""

    parquet: Place | None = None
    geojson: Place | None = None
    gpkg: Place | None = None
    csv: Place | None = None
    csv_wkt: bool = False
    single_file: bool = True
    by_size: bool = False
    crs: object | None = None
    geojson_parts: bool = False

    def paths(self) -> list[Place]:
        return [p for p in (self.parquet, self.gpkg, self.geojson, self.csv) if p is not None]


def _written(df: DataFrame, path: Place, single: bool, write: Callable[[DataFrame, Place], None]) -> None:
    """Have tasks write ``df`` next to ``path``, then put it there: the folder, or its only part."""
    files.check_writable(path)
    beside = files.beside(path)
    try:
        write(df.coalesce(1) if single else df, beside)
        files.publish(files.listed(beside, "part-*")[0] if single else beside, path)
    finally:
        files.delete(beside)


def _geo(kinds: set[str], crs: object | None) -> str:
    """What a footer says that makes a Parquet file with WKB a geo-parquet one; no kind of shape means any."""
    column = {"encoding": "WKB", "geometry_types": sorted(kinds)} | ({"crs": crs} if crs is not None else {})
    return json.dumps({"version": "1.0.0", "primary_column": GEOMETRY, "columns": {GEOMETRY: column}})


def _with_geo_footer(path: Path, crs: object | None) -> None:
    """Complete the footer of a file that this machine has, with the kinds of shapes in it."""
    import pyarrow.parquet as pq

    source = pq.ParquetFile(path)
    kinds: set[str] = set()
    beside = path.with_name(f".{path.name}.geo")
    for group in range(source.num_row_groups):
        for wkb in source.read_row_group(group, columns=[GEOMETRY]).column(0):
            if wkb.is_valid:
                kinds.add(decode(wkb.as_py())["type"])
    schema = source.schema_arrow
    schema = schema.with_metadata((schema.metadata or {}) | {b"geo": _geo(kinds, crs).encode()})
    with pq.ParquetWriter(beside, schema) as writer:
        for group in range(source.num_row_groups):
            writer.write_table(source.read_row_group(group).cast(schema))
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)  # of the file as it was
    beside.replace(path)


def _footed(spark: SparkSession, part: Uri, crs: object | None) -> None:
    """The same for a file of another file system: its pages are copied as they are, under a new footer."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parquet, util = jvm.org.apache.parquet.hadoop, jvm.org.apache.parquet.hadoop.util
    made = files.beside(part)
    source = util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(str(part)), conf)
    to = util.HadoopOutputFile.fromPath(jvm.org.apache.hadoop.fs.Path(str(made)), conf)
    reader = parquet.ParquetFileReader.open(source)
    try:
        old = reader.getFooter().getFileMetaData()
        mode = getattr(parquet, "ParquetFileWriter$Mode").CREATE
        writer = parquet.ParquetFileWriter(to, old.getSchema(), mode, 128 << 20, 8 << 20)
        writer.start()
        writer.appendFile(source)
        said = jvm.java.util.HashMap(old.getKeyValueMetaData())
        said.put("geo", _geo(set(), crs))
        writer.end(said)
    finally:
        reader.close()
    files.publish(made, part)


def write_parquet(df: DataFrame, path: Place, single_file: bool = True, crs: object | None = None) -> None:
    """One geo-parquet file, or a folder of them.

    On a mounted file system the tasks that hold a folder's parts complete their
    footers; on any other the folder has one common footer for all of them.
    """
    spark = df.sparkSession

    def write_parts(d: DataFrame, to: Place) -> None:
        d.write.parquet(files.spark_path(to))
        if GEOMETRY not in df.columns:
            return
        parts = files.listed(to, "part-*")
        if isinstance(to, Uri):
            if single_file:
                _footed(spark, parts[0], crs)
            else:
                _common_footer(spark, parts, to, crs)
            return

        def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in batch.column("part"):
                    _with_geo_footer(Path(part.as_py()), crs)
                yield batch.select(["part"])

        names = spark.createDataFrame([(str(p), p.name) for p in parts], "part string, name string")
        with_package(names).repartition(max(1, len(parts)), "name").mapInArrow(complete, "part string").count()

    _written(df, path, single_file, write_parts)


def _common_footer(spark: SparkSession, parts: list[Place], folder: Uri, crs: object | None) -> None:
    """A file without rows whose footer speaks for all of a folder's."""
    if not parts:
        return
    import pyarrow.parquet as pq

    schema = to_arrow_schema(spark.read.parquet(str(parts[0])).schema)
    with tempfile.TemporaryDirectory() as here:
        local = Path(here) / COMMON
        pq.write_metadata(schema.with_metadata({b"geo": _geo(set(), crs).encode()}), local)
        files.put(local, folder / COMMON)


def attributes(df: DataFrame, with_wkt: bool = False) -> DataFrame:
    """Columns for a text file: geometry dropped, or as WKT."""
    if GEOMETRY not in df.columns:
        return df
    return with_package(df).withColumn(GEOMETRY, wkb_to_wkt(GEOMETRY)) if with_wkt else df.drop(GEOMETRY)


def write_csv(df: DataFrame, path: Place, with_wkt: bool = False, single_file: bool = True) -> None:
    flat = attributes(df, with_wkt)
    _written(flat, path, single_file, lambda d, to: d.write.option("header", True).option("emptyValue", "").csv(files.spark_path(to)))


def features(df: DataFrame) -> DataFrame:
    """One GeoJSON feature for each row, as the text column ``feature``."""
    names = [c for c in df.columns if c != GEOMETRY]
    properties = F.to_json(F.struct(*names), {"ignoreNullFields": "false"}) if names else F.lit("{}")
    shape = F.coalesce(wkb_to_geojson(GEOMETRY), F.lit("null")) if GEOMETRY in df.columns else F.lit("null")
    text = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), shape, F.lit("}"))
    return with_package(df).select(text.alias("feature"))


#: What tasks write after each feature, and the driver leaves off after the last.
_BETWEEN = ",\n"


def _collection(name: str) -> str:
    return f'{{"type":"FeatureCollection","name":{json.dumps(name)},"features":[\n'


def _collections(df: DataFrame, name: str) -> DataFrame:
    """The lines of one FeatureCollection for each partition, a feature on each."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = _collection(name)
        for batch in batches:
            texts = batch.column("feature").to_pylist()
            if texts:
                yield pa.RecordBatch.from_pydict({"line": [before + texts[0], *("," + t for t in texts[1:])]})
                before = ","
        yield pa.RecordBatch.from_pydict({"line": [("" if before == "," else before) + "]}"]})

    return features(df).mapInArrow(lines, "line string")


def write_geojson(df: DataFrame, path: Place, parts: bool = False) -> None:
    """One FeatureCollection, or a folder with one for each task (``parts``).

    Tasks write features, by Spark's own writer: a failed one leaves nothing.
    For one file their parts are joined in order, stream to stream.
    """
    if parts:
        _written(_collections(df, path.stem), path, False, lambda d, to: d.write.text(files.spark_path(to)))
        return
    files.check_writable(path)
    made, beside = files.beside(path, path.suffix), files.beside(path)
    try:
        features(df).write.option("lineSep", _BETWEEN).text(files.spark_path(beside))
        files.joined(files.listed(beside, "part-*"), made, _collection(path.stem), "\n]}\n", len(_BETWEEN))
        files.publish(made, path)
    finally:
        files.delete(beside)
        files.delete(made)


#: The tables that the GeoPackage standard requires, and its reference systems.
_GPKG_TABLES = """
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER NOT NULL PRIMARY KEY, organization TEXT NOT NULL,
  organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT NOT NULL PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE,
  description TEXT DEFAULT '', last_change DATETIME NOT NULL DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ','now')),
  min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL,
  srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name));
INSERT INTO gpkg_spatial_ref_sys VALUES ('Undefined Cartesian', -1, 'NONE', -1, 'undefined', NULL);
INSERT INTO gpkg_spatial_ref_sys VALUES ('Undefined geographic', 0, 'NONE', 0, 'undefined', NULL);
INSERT INTO gpkg_spatial_ref_sys VALUES ('WGS 84', 4326, 'EPSG', 4326, 'GEOGCS["WGS 84"]', NULL);
"""
_APPLICATION_ID = 0x47504B47


def _sql_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegralType):
        return "INTEGER"
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return "DOUBLE"
    return {"binary": "BLOB", "boolean": "BOOLEAN"}.get(dtype.typeName(), "TEXT")


#: Rows of one database that a task makes.
_CHUNK = 5000


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _layer(columns: list[tuple[str, str]], srs_id: int) -> tuple[str, Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]]:
    """The statement that makes a table ``layer``, and a task's function that fills one after another with its rows."""
    key = "fid" if "fid" not in {n.lower() for n, _ in columns} else "_fid"
    create = f"({', '.join([f'{key} INTEGER PRIMARY KEY AUTOINCREMENT', *(f'{_quoted(n)} {kind}' for n, kind in columns)])})"
    names = [n for n, _ in columns]
    insert = f"INSERT INTO layer ({', '.join(map(_quoted, names))}) VALUES ({', '.join('?' * len(names))})"
    head = b"GP\x00\x01" + struct.pack("<i", srs_id)

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                some = batch.slice(at, _CHUNK)
                values = [some.column(n).to_pylist() for n in names]
                box: list[float | None] = [None] * 4
                if GEOMETRY in names:
                    place = names.index(GEOMETRY)
                    boxes = [b for b in map(bounds, values[place]) if b]
                    if boxes:
                        low, high = zip(*(b[:2] for b in boxes)), zip(*(b[2:] for b in boxes))
                        box = [*map(min, low), *map(max, high)]
                    values[place] = [None if v is None else head + v for v in values[place]]
                db = sqlite3.connect(":memory:")
                db.execute(f"CREATE TABLE layer {create}")
                db.executemany(insert, zip(*values))
                db.commit()
                row = {"part": part, "chunk": chunk, "db": db.serialize(), **dict(zip(_BOX, box))}
                db.close()
                chunk += 1
                yield pa.RecordBatch.from_pylist([row], schema=made)

    made = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("db", pa.binary()), *((b, pa.float64()) for b in _BOX)])
    return create, filled


_BOX = ("min_x", "min_y", "max_x", "max_y")


def write_gpkg(df: DataFrame, path: Place, layer: str | None = None, srs_id: int = -1) -> None:
    """A GeoPackage with one feature layer, named after the file, and its extent.

    Tasks turn their rows into small databases, staged as a table next to the
    place; the driver attaches one at a time and has it copied, page to page.
    """
    files.check_writable(path)
    layer = layer or path.stem
    plain = (T.IntegralType, T.FractionalType, T.StringType, T.BinaryType, T.BooleanType)
    shaped = [f for f in df.schema if f.name != GEOMETRY] + [f for f in df.schema if f.name == GEOMETRY]
    texts = {f.name: F.col(f"`{f.name}`") if isinstance(f.dataType, plain) else F.col(f"`{f.name}`").cast("string") for f in shaped}
    columns = [(f.name, "BLOB" if f.name == GEOMETRY else _sql_type(f.dataType)) for f in shaped]
    create, filled = _layer(columns, srs_id)
    beside = files.beside(path)
    rows = with_package(df).select(*(c.alias(n) for n, c in texts.items()))
    schema = f"part int, chunk int, db binary, {', '.join(f'{b} double' for b in _BOX)}"
    try:
        rows.mapInArrow(filled, schema).write.parquet(files.spark_path(beside))
        made = df.sparkSession.read.schema(schema).parquet(files.spark_path(beside))
        extent = made.agg(*(f(b).alias(b) for f, b in zip((F.min, F.min, F.max, F.max), _BOX))).first()
        with tempfile.TemporaryDirectory() as here:
            whole = Path(here) / "whole.gpkg"
            _merged(made, whole, layer, create, [n for n, _ in columns], srs_id, [extent[b] for b in _BOX])
            files.put(whole, path)
    finally:
        files.delete(beside)


def _merged(made: DataFrame, whole: Path, layer: str, create: str, names: list[str], srs_id: int, extent: list[float | None]) -> None:
    """One GeoPackage of the tasks' databases, in their order."""
    part = whole.with_name("part.db")
    listed = ", ".join(map(_quoted, names))
    has_shape = GEOMETRY in names
    db = sqlite3.connect(whole, isolation_level=None)
    try:
        db.executescript(f"PRAGMA application_id = {_APPLICATION_ID}; PRAGMA user_version = 10200; {_GPKG_TABLES}")
        db.execute(f"CREATE TABLE {_quoted(layer)} {create}")
        for row in made.select("part", "chunk", "db").orderBy("part", "chunk").toLocalIterator():
            part.write_bytes(row["db"])
            db.execute("ATTACH ? AS part", (str(part),))
            db.execute(f"INSERT INTO {_quoted(layer)} ({listed}) SELECT {listed} FROM part.layer ORDER BY rowid")
            db.execute("DETACH part")
        columns = "table_name, data_type, identifier, srs_id, min_x, min_y, max_x, max_y"
        kind = "features" if has_shape else "attributes"
        db.execute(f"INSERT INTO gpkg_contents ({columns}) VALUES ({', '.join('?' * 8)})", (layer, kind, layer, srs_id, *extent))
        if has_shape:
            db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, ?, 'GEOMETRY', ?, 0, 0)", (layer, GEOMETRY, srs_id))
    finally:
        db.close()


def read_gpkg(path: Path, layer: str | None = None) -> list[dict]:
    """Rows of a layer that :func:`write_gpkg` wrote, geometry as WKB."""
    db = sqlite3.connect(path)
    db.row_factory = sqlite3.Row
    try:
        rows = [dict(r) for r in db.execute(f'SELECT * FROM "{layer or path.stem}"')]
    finally:
        db.close()
    for r in rows:
        if r.get(GEOMETRY):
            r[GEOMETRY] = r[GEOMETRY][8:]
    return rows


def scan_gpkg(spark: SparkSession, path: Path, schema: T.StructType, layer: str | None = None) -> DataFrame:
    """Rows of a layer that :func:`write_gpkg` wrote of a table with this schema, read by tasks, each some rows at a time.

    The file must be where all machines have it mounted.
    """
    at, table = f"file:{quote(str(path.absolute()))}?mode=ro&immutable=1", _quoted(layer or path.stem)
    db = sqlite3.connect(at, uri=True)
    try:
        last = db.execute(f"SELECT coalesce(max(rowid), 0) FROM {table}").fetchone()[0]
    finally:
        db.close()

    def held(dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, (T.IntegralType, T.BooleanType)):
            return T.LongType()
        return T.DoubleType() if isinstance(dtype, T.FractionalType) else dtype if isinstance(dtype, T.BinaryType) else T.StringType()

    stored = T.StructType([T.StructField(f.name, held(f.dataType)) for f in schema])
    types, names = to_arrow_schema(stored), schema.names
    wanted = f"SELECT {', '.join(map(_quoted, names))} FROM {table} WHERE rowid > ? AND rowid <= ?"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db = sqlite3.connect(at, uri=True)
        try:
            for batch in batches:
                for chunk in batch.column("id").to_pylist():
                    found = db.execute(wanted, (chunk * _CHUNK, (chunk + 1) * _CHUNK)).fetchall()
                    values = [list(c) for c in zip(*found)] or [[] for _ in names]
                    if GEOMETRY in names:
                        place = names.index(GEOMETRY)
                        values[place] = [None if v is None else v[8:] for v in values[place]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, types)], schema=types)
        finally:
            db.close()

    chunks = -(-last // _CHUNK)
    numbers = spark.range(0, chunks, 1, max(1, min(chunks, 4 * spark.sparkContext.defaultParallelism)))
    back = with_package(numbers).mapInArrow(rows, stored)
    return back.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema))


def write(df: DataFrame, to: Outputs) -> list[Place]:
    """Write every asked format; one that fails is logged and the others go on. Returns what was written.

    A result without rows writes nothing. Only the folder of the first format
    is made.
    """
    if df.isEmpty():
        log.warning("no rows, nothing is written")
        return []
    if to.by_size and "rSize" in df.columns:
        df = df.orderBy(F.desc_nulls_last("rSize"))
    paths = [p for p in (to.parquet, to.geojson, to.gpkg, to.csv) if p is not None]
    if paths:
        files.make_folder(paths[0].parent)
    jobs = [
        (to.parquet, lambda p: write_parquet(df, p, to.single_file, to.crs)),
        (to.geojson, lambda p: write_geojson(df, p, to.geojson_parts)),
        (to.gpkg, lambda p: write_gpkg(df, p)),
        (to.csv, lambda p: write_csv(df, p, to.csv_wkt, to.single_file)),
    ]
    done = []
    for path, job in jobs:
        if path is None:
            continue
        try:
            job(path)
            done.append(path)
        except Exception:
            log.exception("could not write %s", path)
    return done


