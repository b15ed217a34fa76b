"""Registered queries over the directory view of the order lines, each with its DuckDB SQL where SQL can say it."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talus import sinks
from talus.functions import viewer
from talus.functions.geometry import wkb_to_geojson, wkb_to_wkt
from talus.functions.normalize import normalize
from talus.operators import dedup, diagnostics, legend, matrix, predicates
from talus.operators.late import selected_late
from talus.plans.scenario import attribute_predicates, count_together, filter_scenario, filtered, master, run_together
from talus.schema import PAIR_KEY, POT, SIZE, VARIANT_KEY
from talus.shipping import with_package
from talus.sources.config import Scenario
from talus.sources.directory import read_directory, read_geojson, write_bucketed
from talus.sources.fixtures import RAW_SQL, directory, with_geometry

WINTER = Scenario(
    name="Winter",
    lk=("70601", "70602"),
    lwd=("IT-32-BZ-18-02", "IT-32-TN-16"),
    sub_catchments=(500,),
    sectors=("E", "N", "S", "W"),
    flows=("dry",),
    elev_min=1800,
    elev_max=5000,
    pots=("very high",),
    size=5,
)
SPRING = replace(WINTER, name="Spring", sectors=("E", "S", "W"), flows=("wet",), elev_max=2200, size=3)
WINTER_AND = replace(WINTER, name="Winter both regions", region_mode="and")
HIGH4 = replace(WINTER, name="High 4", pots=("high",), size=4)
LOW2 = replace(WINTER, name="Low 2", pots=("low",), size=2)
SIZE1 = replace(WINTER, name="Size 1", size=1)

# ---------------------------------------------------------------- DuckDB SQL

_NORM = """SELECT praID, resultID, lower(trim(modType)) AS modType, LKGebietID, LWDGebietID, subC, sector,
    CAST(elevMin AS DOUBLE) AS elevMin, CAST(elevMax AS DOUBLE) AS elevMax, lower(trim(flow)) AS flow, PPM, PEM, rSize FROM raw"""
_NORM = _NORM.replace("CAST(elevMin AS DOUBLE)", "elevMin").replace("CAST(elevMax AS DOUBLE)", "elevMax")
_VIEW = f"raw AS ({RAW_SQL}), dir AS ({_NORM})"


def _text(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _matrix_sql() -> str:
    rows = ", ".join(f"('{c.pot}', {c.size}, {c.ppm}, {c.pem}, {c.r_size}, '{c.mod_type}')" for c in matrix.cells())
    names = f"{POT}, {SIZE}, PPM, PEM, rSize, modType"
    longs = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in (SIZE, "PPM", "PEM", "rSize"))
    return f"SELECT {POT}, {longs}, modType FROM (VALUES {rows}) AS m({names})"


_MATRIX = f"mat AS ({_matrix_sql()}), kinds AS (SELECT {POT}, {SIZE}, PPM, PEM, rSize, unnest(string_split(modType, ' / ')) AS modType FROM mat)"


def _region_sql(s: Scenario) -> str:
    parts = [f"{c} IN ({_text(v)})" for c, v in (("LKGebietID", s.lk), ("LWDGebietID", s.lwd)) if v]
    return "(" + (" AND " if s.region_mode == "and" else " OR ").join(parts) + ")" if parts else "true"


def _filters_sql(s: Scenario) -> list[tuple[str, str]]:
    return [
        ("region", _region_sql(s)),
        ("subC", f"subC IN ({', '.join(map(str, s.sub_catchments))})"),
        ("sector", f"upper(trim(sector)) IN ({_text(s.sectors)})"),
        ("flow", f"flow IN ({_text(s.flows)})"),
        ("elevMin", f"elevMin >= {s.elev_min}"),
        ("elevMax", f"elevMax <= {s.elev_max}"),
    ]


def _filtered_sql(s: Scenario) -> str:
    where = " AND ".join(p for _, p in _filters_sql(s))
    return f"SELECT * REPLACE (upper(trim(sector)) AS sector) FROM dir WHERE {where}"


_KEY_SQL = ", ".join(
    c for c in VARIANT_KEY if c in ("praID", "LKGebietID", "LWDGebietID", "modType", "subC", "sector", "elevMin", "elevMax", "flow")
)
_SINGLE = f"row_number() OVER (PARTITION BY {_KEY_SQL} ORDER BY rSize DESC NULLS LAST, resultID, PEM, PPM) = 1"
_AREA = "row_number() OVER (PARTITION BY praID ORDER BY PEM ASC NULLS LAST, rSize DESC NULLS LAST, resultID) = 1"


def _joined_sql(s: Scenario, source: str) -> str:
    wanted = f"SELECT DISTINCT PPM, PEM, rSize, modType FROM kinds WHERE {POT} IN ({_text(s.pots)}) AND {SIZE} = {s.size}"
    return f"SELECT * FROM {source} SEMI JOIN ({wanted}) k USING (PPM, PEM, rSize, modType)"


def _tags_sql(s: Scenario) -> str:
    return f"'{','.join(sorted(set(s.pots)))}' AS {POT}, CAST({s.size} AS BIGINT) AS {SIZE}"


def _scenario_sql(s: Scenario) -> str:
    return f"SELECT *, {_tags_sql(s)} FROM ({_joined_sql(s, f'({_filtered_sql(s)}) f')}) j QUALIFY {_SINGLE}"


def _with(body: str, ctes: str = f"{_VIEW}, {_MATRIX}") -> str:
    return f"WITH {ctes} {body}"


def _shape_sql(source: str, number: str, point: str, ring: str, polygon: str, multi: str) -> str:
    """A query's rows with the fixture's squares as text; the formats hold numbers, points, rings and shapes."""

    def rings(sign: str) -> str:
        corners = ("x", "y"), ("x + side", "y"), ("x + side", "y + side"), ("x", "y + side"), ("x", "y")
        points = (point.format(number.format(sign + f"({a})"), number.format(b)) for a, b in corners)
        return ring.format(" || ".join(points))

    shape = f"CASE modType WHEN 'rel' THEN {polygon.format(rings(''))} ELSE {multi.format(rings(''), rings('-'))} END"
    return f"""SELECT * EXCLUDE (x, y, side), {shape} AS geometry FROM (
        SELECT *, CAST(11 AS DOUBLE) + (praID % 997) / CAST(1000 AS DOUBLE) AS x, CAST(46 AS DOUBLE) + (praID % 499) / CAST(1000 AS DOUBLE) AS y,
        CASE modType WHEN 'rel' THEN CAST(0.001 AS DOUBLE) ELSE CAST(0.01 AS DOUBLE) END AS side FROM ({source}) w)"""


def _json_sql(s: Scenario) -> str:
    return _shape_sql(
        _scenario_sql(s),
        "CAST({} AS VARCHAR)",
        "'[' || {} || ',' || {} || '],'",
        "'[' || rtrim({}, ',') || ']'",
        "'{{\"type\":\"Polygon\",\"coordinates\":[' || {} || ']}}'",
        "'{{\"type\":\"MultiPolygon\",\"coordinates\":[[' || {} || '],[' || {} || ']]}}'",
    )


def _wkt_sql(s: Scenario) -> str:
    return _as_wkt_sql(_scenario_sql(s))


def _as_wkt_sql(source: str) -> str:
    return _shape_sql(
        source,
        "regexp_replace(CAST({} AS VARCHAR), '[.]0$', '')",
        "{} || ' ' || {} || ', '",
        "'(' || rtrim({}, ', ') || ')'",
        "'POLYGON (' || {} || ')'",
        "'MULTIPOLYGON ((' || {} || '), (' || {} || '))'",
    )


# ------------------------------------------------------------------- queries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


def _normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(directory(spark, sf_dir))


def _folder(spark: SparkSession) -> Path:
    """A new folder for a round trip, within the one that the cluster's machines share where there is one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or ""
    base = Path(shared.removeprefix("file://")) if shared.startswith(("/", "file:/")) else None
    if base is not None:
        base.mkdir(parents=True, exist_ok=True)
    elif not re.match(r"local(\[.*\])?$", spark.sparkContext.master):
        raise RuntimeError("sinks need a mounted folder that driver and executors share in spark.checkpoint.dir")
    return Path(tempfile.mkdtemp(prefix="talus-out-", dir=base))


@_register("scan_directory", _with("SELECT * FROM raw"))
def scan_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directory(spark, sf_dir)


@_register("scan_geojson", _with(_json_sql(WINTER)))
def scan_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark) / "winter.geojson"
    sinks.write_geojson(with_geometry(scenario_winter(spark, sf_dir)), path)
    df = read_geojson(spark, f"file://{path}")
    return df.withColumn("geometry", wkb_to_geojson("geometry"))


@_register("normalize_columns", _with("SELECT * FROM dir"))
def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal(spark, sf_dir)


@_register(
    "rsize_from",
    """SELECT CAST(p AS BIGINT) AS PPM, CAST(e AS BIGINT) AS PEM,
       CAST(CASE p - e WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE 1 END AS INTEGER) AS rSize
       FROM range(0, 8) a(p), range(0, 8) b(e)""",
)
def rsize_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spark.range(64).selectExpr("id div 8 AS PPM", "id % 8 AS PEM")
    return pairs.withColumn("rSize", matrix.r_size(F.col("PPM"), F.col("PEM")))


@_register("matrix", _with(f"SELECT *, '{matrix.SOURCE}' AS Source, '{matrix.VERSION}' AS Version FROM mat", _MATRIX))
def matrix_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.matrix(spark)


@_register("legend_select", _with(f"SELECT {POT}, {SIZE}, PPM, PEM, rSize, modType FROM mat WHERE {POT} = 'high' AND {SIZE} = 3", _MATRIX))
def legend_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.matrix(spark).where((F.col(POT) == "high") & (F.col(SIZE) == 3)).drop("Source", "Version")


@_register("legend_expand", _with("SELECT DISTINCT PPM, PEM, rSize, modType FROM kinds", _MATRIX))
def legend_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.expand(matrix.matrix(spark))


_MULTI = replace(WINTER, pots=("very high", "high"), size=4)


@_register("legend_multi_pot", _with(_joined_sql(_MULTI, f"({_filtered_sql(_MULTI)}) f")))
def legend_multi_pot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filtered(_normal(spark, sf_dir), _MULTI)
    return legend.admissible(rows, matrix.select(matrix.cells(), _MULTI.pots, _MULTI.size))


@_register("legend_alias", _with(f"SELECT DISTINCT PPM, PEM, rSize, modType FROM kinds WHERE {POT} = 'moderate' AND {SIZE} = 3", _MATRIX))
def legend_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.allowed(spark, matrix.select(matrix.cells(), ["moderat"], 3))


@_register(
    "max_size_for_pots",
    _with(
        f"""SELECT pot, max({SIZE}) AS max_size FROM (VALUES ('very high'), ('high'), ('moderate'), ('low'), ('none')) p(pot)
        LEFT JOIN mat ON mat.{POT} = pot GROUP BY pot""",
        _MATRIX,
    ),
)
def max_size_for_pots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.max_size_for_pots(matrix.matrix(spark), ["Very High", "high", "moderat", "low", "none"])


def _where(name: str, sql: str, pick: Callable[[DataFrame], list]) -> None:
    @_register(name, _with(f"SELECT * FROM dir WHERE {sql}"))
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _normal(spark, sf_dir)
        return predicates.where_all(df, pick(df))


_where("region_lk", _region_sql(replace(WINTER, lwd=())), lambda d: [predicates.region(d, lk=WINTER.lk)])
_where("region_lwd", _region_sql(replace(WINTER, lk=())), lambda d: [predicates.region(d, lwd=WINTER.lwd)])
_where("region_or", _region_sql(WINTER), lambda d: [predicates.region(d, WINTER.lk, WINTER.lwd, "OR")])
_where("region_and", _region_sql(WINTER_AND), lambda d: [predicates.region(d, WINTER.lk, WINTER.lwd, " And ")])
_where("filter_subc", "subC IN (500, 700)", lambda d: [predicates.sub_catchment(d, [500, 700])])
_where("filter_sector", "upper(trim(sector)) IN ('E', 'N')", lambda d: [predicates.sector(d, ["e", " N "])])
_where("filter_flow", "flow = 'wet'", lambda d: [predicates.flow(d, ["Wet"])])
_where("filter_elev", "elevMin >= 1800 AND elevMax <= 2200", lambda d: predicates.elevation(d, 1800, 2200))


@_register("legend_join", _with(_joined_sql(WINTER, "dir")))
def legend_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legend.admissible(_normal(spark, sf_dir), matrix.select(matrix.cells(), WINTER.pots, WINTER.size))


@_register("legend_empty", _with(f"SELECT 'low' AS pot, max({SIZE}) AS max_size, CAST(0 AS BIGINT) AS selected FROM mat WHERE {POT} = 'low'", _MATRIX))
def legend_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing = legend.apply(_normal(spark, sf_dir), ["low"], 5).select(F.lit("low").alias("pot"), F.lit(None).cast("long").alias("size"), F.lit(1).alias("n"))
    largest = diagnostics.max_size_for_pots(matrix.matrix(spark), ["low"]).select("pot", F.col("max_size").alias("size"), F.lit(0).alias("n"))
    return nothing.union(largest).groupBy("pot").agg(F.max("size").alias("max_size"), F.sum("n").cast("long").alias("selected"))


# The matrix over the directory's own rows.


@_register(
    "rsize_of_rows",
    _with(
        """SELECT praID, resultID, modType, PPM, PEM,
        CAST(CASE PPM - PEM WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE 1 END AS INTEGER) AS derived FROM dir"""
    ),
)
def rsize_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal(spark, sf_dir).select("praID", "resultID", "modType", "PPM", "PEM", matrix.r_size(F.col("PPM"), F.col("PEM")).alias("derived"))


def _kinds(cells: DataFrame) -> DataFrame:
    """Cells with a row for each kind that they admit."""
    return cells.withColumn("kind", F.explode(F.split("modType", " / ")))


def _key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal(spark, sf_dir).groupBy("PPM", "PEM", "rSize", F.col("modType").alias("kind")).agg(F.count("*").alias("n"))


@_register(
    "matrix_use",
    _with(
        f"""SELECT {POT}, {SIZE}, mat.PPM, mat.PEM, mat.rSize, mat.modType, count(d.praID) AS n_rows FROM mat
        LEFT JOIN dir d ON d.PPM = mat.PPM AND d.PEM = mat.PEM AND d.rSize = mat.rSize AND contains(mat.modType, d.modType) GROUP BY ALL"""
    ),
)
def matrix_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the directory's rows each cell of the matrix admits."""
    cells = _kinds(matrix.matrix(spark).drop("Source", "Version"))
    found = cells.join(F.broadcast(_key_counts(spark, sf_dir)), ["PPM", "PEM", "rSize", "kind"], "left")
    return found.groupBy(POT, SIZE, "PPM", "PEM", "rSize", "modType").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


@_register("legend_alias_rows", _with(_joined_sql(replace(WINTER, pots=("moderate",), size=3), "dir")))
def legend_alias_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legend.admissible(_normal(spark, sf_dir), matrix.select(matrix.cells(), ["moderat"], 3))


_LEVELS = ("very high", "high", "moderate", "low")
_EVERY_CELL = [Scenario(name=f"{p} {n}", pots=(p,), size=n, single_r_size=False) for p in _LEVELS for n in range(1, 6)]


@_register(
    "legend_coverage",
    _with(
        f"""SELECT pot, size, max_size, CASE WHEN has IS NULL THEN 0 WHEN size = 1 THEN areas ELSE coalesce(n, 0) END AS n_rows
        FROM (SELECT unnest([{_text(_LEVELS)}]) AS pot) p CROSS JOIN (SELECT CAST(unnest(range(1, 6)) AS BIGINT) AS size) s
        JOIN (SELECT {POT} AS pot, max({SIZE}) AS max_size FROM mat GROUP BY 1) m USING (pot)
        LEFT JOIN (SELECT DISTINCT {POT} AS pot, {SIZE} AS size, true AS has FROM mat) h USING (pot, size)
        LEFT JOIN (
          SELECT k.{POT} AS pot, k.{SIZE} AS size, count(*) AS n
          FROM (SELECT DISTINCT * FROM kinds) k JOIN dir USING (PPM, PEM, rSize, modType) GROUP BY 1, 2
        ) c USING (pot, size)
        CROSS JOIN (SELECT count(DISTINCT praID) AS areas FROM dir WHERE modType = 'rel')"""
    ),
)
def legend_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each level and size of the matrix selects of the directory, those without a cell included."""
    chosen = count_together(directory(spark, sf_dir), _EVERY_CELL)
    asked = spark.createDataFrame([(i, s.pots[0], s.size) for i, s in enumerate(_EVERY_CELL)], "of int, pot string, size long")
    largest = diagnostics.max_size_for_pots(matrix.matrix(spark), _LEVELS)
    counted = F.broadcast(asked).join(chosen, F.col("of") == F.col("scenario"), "left").join(largest, "pot")
    return counted.select("pot", "size", "max_size", F.coalesce("n", F.lit(0)).alias("n_rows"))


@_register(
    "max_size_in_rows",
    _with(
        f"""SELECT pot, max(k.{SIZE}) AS max_size FROM (SELECT unnest([{_text((*_LEVELS, 'none'))}]) AS pot) p
        LEFT JOIN (SELECT * FROM kinds SEMI JOIN dir USING (PPM, PEM, rSize, modType)) k ON k.{POT} = pot GROUP BY pot"""
    ),
)
def max_size_in_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest size of each level that the directory has a row for."""
    there = _kinds(matrix.matrix(spark)).join(F.broadcast(_key_counts(spark, sf_dir)), ["PPM", "PEM", "rSize", "kind"], "left_semi")
    return diagnostics.max_size_for_pots(there, ["Very High", "high", "moderat", "low", "none"])


@_register("tag_scenario", _with(f"SELECT *, {_tags_sql(_MULTI)} FROM dir"))
def tag_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legend.tag(_normal(spark, sf_dir), _MULTI.pots, _MULTI.size)


@_register(
    "size1_rel_only",
    _with(
        f"""SELECT *, {_tags_sql(SIZE1)} FROM (SELECT * FROM ({_filtered_sql(SIZE1)}) f WHERE modType = 'rel' QUALIFY {_AREA}) a
        QUALIFY {_SINGLE}"""
    ),
)
def size1_rel_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_scenario(directory(spark, sf_dir), SIZE1)


@_register("single_rsize", _with(f"SELECT * FROM dir QUALIFY {_SINGLE}"))
def single_rsize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.single_r_size(_normal(spark, sf_dir))


@_register("single_rsize_late", _with(_as_wkt_sql(f"SELECT * FROM (SELECT * FROM dir WHERE {_region_sql(WINTER_AND)}) d QUALIFY {_SINGLE}")))
def single_rsize_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The choice among variants over files with geometry, which is read for the chosen alone."""
    df = directory(spark, sf_dir)
    path = f"file://{_folder(spark)}/rows.parquet"
    with_geometry(df.where(predicates.region(df, WINTER_AND.lk, WINTER_AND.lwd, "and"))).write.parquet(path)
    chosen = selected_late(spark.read.parquet(path), lambda d: dedup.single_r_size(normalize(d)))
    return sinks.attributes(chosen, with_wkt=True)


def _scenario(name: str, s: Scenario) -> Query:
    @_register(name, _with(_scenario_sql(s)))
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return filter_scenario(directory(spark, sf_dir), s)

    return query


scenario_winter = _scenario("scenario_winter", WINTER)
scenario_spring = _scenario("scenario_spring", SPRING)
scenario_winter_and = _scenario("scenario_winter_and", WINTER_AND)
scenario_high4 = _scenario("scenario_high4", HIGH4)
scenario_low2 = _scenario("scenario_low2", LOW2)

_MASTER = f"({_scenario_sql(WINTER)}) UNION ALL ({_scenario_sql(SPRING)})"


@_register("master_union", _with(_MASTER))
def master_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master([scenario_winter(spark, sf_dir), scenario_spring(spark, sf_dir)])


_ALL = [WINTER, SPRING, WINTER_AND, HIGH4, LOW2]


@_register(
    "scenarios_one_pass",
    _with(" UNION ALL ".join(f"(SELECT *, CAST({i} AS INTEGER) AS scenario FROM ({_scenario_sql(s)}) s{i})" for i, s in enumerate(_ALL))),
)
def scenarios_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_together(directory(spark, sf_dir), _ALL)


#: All kinds: of the matrix, of size 1, without a matrix stage, and one that keeps all variants.
FREE = replace(WINTER, name="Free", pots=(), size=None, sub_catchments=(600,))
EVERY = replace(WINTER, name="Every variant", pots=("high",), size=3, single_r_size=False)
_MIXED = [WINTER, SIZE1, FREE, EVERY]


def _kind_sql(s: Scenario) -> str:
    untagged = f"CAST(NULL AS VARCHAR) AS {POT}, CAST(NULL AS BIGINT) AS {SIZE}"
    if not s.uses_matrix:
        return f"SELECT *, {untagged} FROM ({_filtered_sql(s)}) f QUALIFY {_SINGLE}"
    if s.size == 1:
        return f"SELECT *, {_tags_sql(s)} FROM (SELECT * FROM ({_filtered_sql(s)}) f WHERE modType = 'rel') a QUALIFY {_AREA}"
    return _scenario_sql(s) if s.single_r_size else f"SELECT *, {_tags_sql(s)} FROM ({_joined_sql(s, f'({_filtered_sql(s)}) f')}) j"


@_register(
    "scenarios_mixed",
    _with(" UNION ALL ".join(f"(SELECT *, CAST({i} AS INTEGER) AS scenario FROM ({_kind_sql(s)}) s{i})" for i, s in enumerate(_MIXED))),
)
def scenarios_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_together(directory(spark, sf_dir), _MIXED)


@_register(
    "scenario_summary",
    _with(
        f"""SELECT count(*) AS total, count(*) FILTER (modType = 'res') AS n_res, count(*) FILTER (modType = 'rel') AS n_rel,
        count(DISTINCT praID) AS n_areas FROM ({_scenario_sql(WINTER)}) w"""
    ),
)
def scenario_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.scenario_summary(scenario_winter(spark, sf_dir))


@_register(
    "available_options",
    _with(
        " UNION ALL ".join(
            f"SELECT '{c}' AS attribute, CAST(min(CAST({c} AS DOUBLE)) AS DOUBLE) AS low, CAST(max(CAST({c} AS DOUBLE)) AS DOUBLE) AS high FROM dir"
            for c in ("LKGebietID", "subC", "elevMin", "elevMax", "PPM", "PEM", "rSize")
        )
    ),
)
def available_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.available_options(_normal(spark, sf_dir))


def _profile_sql(name: str, source: str) -> str:
    lists = ", ".join(f"string_agg(DISTINCT CAST({c} AS STRING), ',' ORDER BY CAST({c} AS STRING)) AS {c}_values" for c in ("subC", "flow", "sector"))
    ranges = ", ".join(f"CAST({f}({c}) AS DOUBLE) AS {c}_{f}" for c in ("elevMin", "elevMax") for f in ("min", "max"))
    return f"SELECT '{name}' AS stage, count(*) AS n, {lists}, {ranges} FROM {source}"


@_register("stage_profile", _with(f"{_profile_sql('start', 'dir')} UNION ALL {_profile_sql('scenario', f'({_filtered_sql(WINTER)}) f')}"))
def stage_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _normal(spark, sf_dir)
    return diagnostics.stage_profile([("start", df), ("scenario", filtered(df, WINTER))])


@_register(
    "join_key_topn",
    _with("SELECT PPM, PEM, rSize, modType, count(*) AS n_rows FROM dir GROUP BY ALL ORDER BY n_rows DESC, PPM, PEM, rSize, modType LIMIT 12"),
)
def join_key_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.join_key_topn(directory(spark, sf_dir))


def _funnel_sql() -> str:
    steps, out = _filters_sql(WINTER), ["SELECT 'start' AS step, CAST(0 AS BIGINT) AS n_step, count(*) AS kept FROM dir"]
    for i in range(1, len(steps) + 1):
        where = " AND ".join(p for _, p in steps[:i])
        out.append(f"SELECT '{steps[i - 1][0]}', CAST({i} AS BIGINT), count(*) FROM dir WHERE {where}")
    return " UNION ALL ".join(out)


@_register("filter_funnel", _with(_funnel_sql()))
def filter_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _normal(spark, sf_dir)
    return diagnostics.funnel(df, attribute_predicates(df, WINTER))


@_register("check_input", _with("SELECT '' AS missing, count(*) = 0 AS empty, count(*) > 0 AS ok FROM dir"))
def check_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.check_input(_normal(spark, sf_dir))


@_register(
    "rel_res_pairs",
    _with(
        """SELECT praID, resultID, count(*) FILTER (modType = 'rel') AS n_rel, count(*) FILTER (modType = 'res') AS n_res,
        count(*) FILTER (modType = 'rel') = 1 AND count(*) FILTER (modType = 'res') = 1 AS paired FROM dir GROUP BY praID, resultID"""
    ),
)
def rel_res_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.rel_res_pairs(directory(spark, sf_dir))


_SIDE = "SELECT praID, resultID, sector AS {0}_sector, rSize AS {0}_rSize, geometry AS {0}_geometry FROM s WHERE modType = '{0}'"
_SHAPED = _as_wkt_sql(f"SELECT * FROM dir WHERE {_region_sql(WINTER_AND)}")


@_register(
    "rel_res_joined",
    _with(f"SELECT * FROM ({_SIDE.format('rel')}) a JOIN ({_SIDE.format('res')}) b USING (praID, resultID)", f"{_VIEW}, s AS ({_SHAPED})"),
)
def rel_res_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both geometries of each run, over a bucketed copy of some regions."""
    df = _normal(spark, sf_dir)
    rows = with_geometry(df.where(predicates.region(df, WINTER_AND.lk, WINTER_AND.lwd, "and")))
    folder = _folder(spark) / "runs"
    table = f"talus_{folder.parent.name.replace('-', '_').lower()}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = write_bucketed(rows.select(*PAIR_KEY, "modType", "sector", "rSize", "geometry"), table, folder, buckets)
    both = diagnostics.rel_res_joined(runs)
    return with_package(both).withColumns({f"{k}_geometry": wkb_to_wkt(f"{k}_geometry") for k in ("rel", "res")})


@_register("sink_parquet_folder", _with(_wkt_sql(WINTER)))
def sink_parquet_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark) / "winter.parquet"
    sinks.write_parquet(with_geometry(scenario_winter(spark, sf_dir)), path, single_file=False)
    return sinks.attributes(read_directory(spark, f"file://{path}"), with_wkt=True)


@_register("sink_parquet", _with(_scenario_sql(WINTER)))
def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark) / "winter.parquet"
    sinks.write_parquet(scenario_winter(spark, sf_dir), path)
    return read_directory(spark, f"file://{path}")


def _csv(spark: SparkSession, path: Path, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).option("header", True).option("multiLine", True).csv(f"file://{path}")


@_register("csv_attributes", _with(_scenario_sql(WINTER)))
def csv_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = with_geometry(scenario_winter(spark, sf_dir)), _folder(spark) / "winter.csv"
    sinks.write_csv(rows, path)
    return _csv(spark, path, sinks.attributes(rows))


@_register("csv_wkt", _with(_wkt_sql(WINTER)))
def csv_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = with_geometry(scenario_winter(spark, sf_dir)), _folder(spark) / "winter.csv"
    sinks.write_csv(rows, path, with_wkt=True)
    return _csv(spark, path, sinks.attributes(rows, with_wkt=True))


@_register("sink_geojson", _with(_wkt_sql(WINTER)))
def sink_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark) / "winter.geojson"
    sinks.write_geojson(with_geometry(scenario_winter(spark, sf_dir)), path)
    return sinks.attributes(read_directory(spark, f"file://{path}"), with_wkt=True)


@_register("sink_gpkg", _with(_wkt_sql(WINTER)))
def sink_gpkg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = with_geometry(scenario_winter(spark, sf_dir)), _folder(spark) / "winter.gpkg"
    sinks.write_gpkg(rows, path)
    return sinks.attributes(sinks.scan_gpkg(spark, path, rows.schema), with_wkt=True)


@_register("viewer_visible", _with("SELECT praID, resultID, modType, modType = 'rel' AS viewer_visible FROM dir"))
def viewer_visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _normal(spark, sf_dir).select("praID", "resultID", "modType")
    return df.withColumn("viewer_visible", viewer.visible(F.col("modType")))


@_register(
    "viewer_style",
    _with(
        f"""SELECT praID, resultID, modType, rSize, CASE modType WHEN 'rel' THEN '{viewer.REL_COLOR}' ELSE '{viewer.RES_COLOR}' END AS hex_relRes,
        CASE rSize {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(viewer.SIZE_COLORS[:4], 1))} ELSE '' END AS hex_size,
        CASE rSize {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(viewer.SIZE_COLORS[:4], 1))} ELSE '{viewer.FALLBACK}' END AS viewer_hex,
        modType = 'rel' AS viewer_visible FROM dir"""
    ),
)
def viewer_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _normal(spark, sf_dir).select("praID", "resultID", "modType", "rSize")
    # Size 5 without a colour of its own, to see the fallback.
    by_size = F.when(F.col("rSize") < 5, viewer.size_color(F.col("rSize"))).otherwise("")
    df = df.withColumns({"hex_relRes": viewer.kind_color(F.col("modType")), "hex_size": by_size})
    return viewer.styled(df, by_size=True)


@_register("viewer_popup", _with("SELECT LWDGebietID, praID, resultID, modType, sector, flow, rSize, PPM, PEM FROM dir"))
def viewer_popup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viewer.popup(_normal(spark, sf_dir))


_RAMP_CASES = " ".join(
    f"WHEN v <= {b} THEN [{', '.join(f'{lo} + (v - {a}) / {b - a} * {hi - lo}' for lo, hi in zip(x, y))}]"
    for a, b, x, y in zip(
        viewer.RAMP,
        viewer.RAMP[1:],
        *(lambda rgb: (rgb, rgb[1:]))([[int(c[i : i + 2], 16) for i in (1, 3, 5)] for c in viewer.SIZE_COLORS]),
    )
)


@_register(
    "size_color_ramp",
    f"""WITH s AS (SELECT CAST(i AS DOUBLE) / 8 AS v FROM range(4, 37) r(i)),
        c AS (SELECT v, CASE {_RAMP_CASES} END AS rgb FROM s)
        SELECT v AS value, '#' || lower(array_to_string(list_transform(rgb, lambda x: printf('%02x', CAST(floor(x + 0.5) AS INTEGER))), '')) AS color FROM c""",
)
def size_color_ramp(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = spark.range(4, 37).selectExpr("CAST(id AS DOUBLE) / 8 AS value")
    return steps.withColumn("color", viewer.ramp_color(F.col("value")))


_PLACED = "rSize + (praID % 9 - 4) / CAST(8 AS DOUBLE)"


@_register(
    "viewer_ramp",
    _with(
        f"""SELECT praID, resultID, modType, v AS value, '#' || lower(array_to_string(list_transform(
            CASE {_RAMP_CASES} ELSE [{', '.join(str(int(viewer.SIZE_COLORS[-1][i : i + 2], 16)) for i in (1, 3, 5))}] END,
            lambda x: printf('%02x', CAST(floor(x + 0.5) AS INTEGER))), '')) AS color
        FROM (SELECT *, {_PLACED} AS v FROM dir)"""
    ),
)
def viewer_ramp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The colour of each row by its size, moved by up to half a class so that it lies between two."""
    df = _normal(spark, sf_dir).selectExpr("praID", "resultID", "modType", f"{_PLACED} AS value")
    return df.withColumn("color", viewer.ramp_color(F.col("value")))
