"""A directory view over order lines: two rows for each, in expressions that Spark and DuckDB share."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talus.functions.geometry import encode
from talus.schema import GEOMETRY
from talus.shipping import with_package

_PPM = "(2 + (l_partkey % 7) % 4)"
_PEM = f"(1 + (l_linenumber - 1) % {_PPM})"

#: Column -> expression over ``lineitem`` and a ``kind`` of 0 (release) or 1 (runout).
COLUMNS = {
    "praID": "CAST(8800000 + l_partkey AS BIGINT)",
    "resultID": "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING))",
    "modType": "CASE WHEN kind = 0 THEN 'REL ' ELSE 'res' END",
    "LKGebietID": "CAST(70600 + (l_partkey % 13) % 5 AS STRING)",
    "LWDGebietID": "CASE (l_partkey % 11) % 4 WHEN 0 THEN 'IT-32-BZ-18-02' WHEN 1 THEN 'IT-32-TN-16' WHEN 2 THEN 'AT-07-22' ELSE 'AT-07-23-02' END",
    "subC": "CAST(500 + (l_partkey % 3) * 100 AS BIGINT)",
    "sector": "CASE l_partkey % 8 WHEN 0 THEN 'n' WHEN 1 THEN 'NE' WHEN 2 THEN ' E' WHEN 3 THEN 'SE' WHEN 4 THEN 'S' WHEN 5 THEN 'SW' WHEN 6 THEN 'w ' ELSE 'NW' END",
    "elevMin": "CAST(1000 + (l_partkey % 17) * 100 AS BIGINT)",
    "elevMax": "CAST(1200 + (l_partkey % 17) * 100 AS BIGINT)",
    "flow": "CASE WHEN l_returnflag = 'N' THEN ' Wet' ELSE 'DRY ' END",
    "PPM": f"CAST({_PPM} AS BIGINT)",
    "PEM": f"CAST({_PEM} AS BIGINT)",
    "rSize": f"CAST(CASE {_PPM} - {_PEM} WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE 1 END AS BIGINT)",
}

#: DuckDB text of the raw view.
RAW_SQL = (
    f"SELECT {', '.join(f'{e} AS {c}' for c, e in COLUMNS.items())} "
    "FROM lineitem CROSS JOIN (VALUES (0), (1)) AS kinds(kind)"
)


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw view, dirty letter case and blanks included."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    both = lines.selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "explode(array(0, 1)) AS kind"
    )
    return both.selectExpr(*(f"{e} AS {c}" for c, e in COLUMNS.items()))


def _square(pra: int, kind: str) -> bytes:
    x, y, side = 11.0 + pra % 997 / 1000, 46.0 + pra % 499 / 1000, 0.001 if kind == "rel" else 0.01
    ring = [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]
    if kind == "rel":
        return encode({"type": "Polygon", "coordinates": [ring]})
    return encode({"type": "MultiPolygon", "coordinates": [[ring], [[[-a, b] for a, b in ring]]]})


def with_geometry(df: DataFrame) -> DataFrame:
    """``df`` with a small polygon (release) or multipolygon (runout) for each row."""
    @F.pandas_udf("binary")
    def shape(pra: pd.Series, kind: pd.Series) -> pd.Series:
        return pd.Series([_square(int(p), k.strip().lower()) for p, k in zip(pra, kind)], dtype=object)

    return with_package(df).withColumn(GEOMETRY, shape("praID", "modType"))
