"""Directory tables from Parquet or GeoJSON, with WKB geometry."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from talus.schema import GEOMETRY, PAIR_KEY, RANGED
from talus.sources import files
from talus.sources.geojson import read as read_geojson


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """A directory table; the suffix ``.geojson`` in any case means GeoJSON, all else Parquet.

    Raises FileNotFoundError where there is nothing.
    """
    at = files.place(path)
    if not files.exists(at):
        raise FileNotFoundError(path)
    if at.suffix.lower() == ".geojson":
        return read_geojson(spark, files.spark_path(at))
    return spark.read.parquet(files.spark_path(at))


def write_bucketed(df: DataFrame, table: str, at: files.Place, buckets: int) -> DataFrame:
    """``df`` as a catalog table at a place, in buckets by run, sorted; returns it.

    Joins and groups by run (``praID, resultID``) over the table need no shuffle.
    """
    files.check_writable(at)
    writer = df.repartition(buckets, *PAIR_KEY).write.bucketBy(buckets, *PAIR_KEY).sortBy(*PAIR_KEY)
    writer.mode("overwrite").option("path", files.spark_path(at)).saveAsTable(table)
    return df.sparkSession.table(table)


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    """Only the columns that the diagnostic mode needs, in whatever case; the scan reads no others."""
    df = read_directory(spark, path)
    wanted = {c.lower() for c in RANGED}
    return df.select(*(f"`{c}`" for c in df.columns if c.lower() in wanted))


def _footer(at: files.Place) -> dict[str, str]:
    """The texts that a Parquet file's footer holds beside its schema."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(files.spark_path(at))
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        return dict(reader.getFooter().getFileMetaData().getKeyValueMetaData())
    finally:
        reader.close()


#: What a folder of Parquet files says of all of them.
COMMON = "_common_metadata"


def read_crs(path: object) -> object | None:
    """The coordinate system that a geo-parquet file names, or None; of a folder, what it says of all or its first file.

    Looks at one footer on the driver, on any file system.
    """
    at = files.place(path)
    if files.is_folder(at):
        common = at / COMMON
        below = [common] if files.exists(common) else files.listed(at, "*.parquet") or files.listed(at, "*", "*.parquet")
        if not below:
            return None
        at = below[0]
    elif not files.exists(at):
        return None
    geo = json.loads(_footer(at).get("geo") or "{}")
    return geo.get("columns", {}).get(geo.get("primary_column", GEOMETRY), {}).get("crs")
