"""What users look at before and after a run. Each is one aggregate, run on demand."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.functions.normalize import normalize
from talus.operators import matrix
from talus.schema import MATRIX_KEY, PAIR_KEY, POT, RANGED, REQUIRED, SIZE


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in REQUIRED if c not in df.columns]


def check_input(df: DataFrame) -> DataFrame:
    """One row: ``missing`` (comma-joined), ``empty``, ``ok``."""
    missing = missing_columns(df)
    empty = df.limit(1).agg((F.count("*") == 0).alias("empty"))
    return empty.select(F.lit(",".join(missing)).alias("missing"), "empty", (~F.col("empty") & F.lit(not missing)).alias("ok"))


def available_options(df: DataFrame) -> DataFrame:
    """``attribute, low, high`` of the ranged columns that have a value; other columns aren't read."""
    present = [c for c in RANGED if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "attribute string, low double, high double")

    def number(c: str) -> Column:
        value = F.col(c).try_cast("double") if isinstance(df.schema[c].dataType, T.StringType) else F.col(c).cast("double")
        return F.when(~F.isnan(value), value)

    one = df.agg(*(F.struct(F.min(number(c)).alias("low"), F.max(number(c)).alias("high")).alias(c) for c in present))
    rows = F.array(*(F.struct(F.lit(c).alias("attribute"), F.col(f"{c}.low"), F.col(f"{c}.high")) for c in present))
    return one.select(F.inline(rows)).where("low is not null")


def scenario_summary(df: DataFrame) -> DataFrame:
    """One row: ``total, n_res, n_rel, n_areas`` (distinct ``praID``, nulls not counted)."""
    kind = F.lower(F.col("modType"))
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(kind == "res").alias("n_res"),
        F.count_if(kind == "rel").alias("n_rel"),
        F.count_distinct("praID").alias("n_areas"),
    )


#: Columns that a stage's profile shows the first values of, and how many.
SHOWN = {"subC": 8, "flow": 8, "sector": 12}
BANDS = ("elevMin", "elevMax")


def _profile(name: str, df: DataFrame) -> DataFrame:
    """One row of :func:`stage_profile`, from one pass.

    Rows become an entry for each shown column and one for the row itself;
    entries are counted by value, which tasks do before they meet, and of a
    column's values a task passes on one more than are shown. So no task holds
    a column's values, however many there are.
    """
    entry = lambda c: F.struct(F.lit(c).alias("c"), (F.col(c).cast("string") if c else F.lit(None).cast("string")).alias("v"))
    ranges = [f(F.col(c).cast("double")).alias(f"{c}_{f.__name__}") for c in BANDS for f in (F.min, F.max)]
    entries = df.select(*BANDS, F.inline(F.array(*map(entry, ("", *SHOWN)))))
    counted = entries.groupBy("c", "v").agg(F.count("*").alias("n"), *ranges).where("c = '' OR v IS NOT NULL")
    nth = F.row_number().over(Window.partitionBy("c").orderBy("v"))
    first = counted.withColumn("nth", nth).where(F.col("nth") <= max(SHOWN.values()) + 1)

    def values(c: str) -> Column:
        found = F.array_sort(F.collect_list(F.when(F.col("c") == c, F.col("v"))))
        more = F.when(F.size(found) > SHOWN[c], ",...").otherwise("")
        return F.concat(F.array_join(F.slice(found, 1, SHOWN[c]), ","), more).alias(f"{c}_values")

    own = [F.max(F.when(F.col("c") == "", F.col(r))).alias(r) for c in BANDS for r in (f"{c}_min", f"{c}_max")]
    n = F.coalesce(F.max(F.when(F.col("c") == "", F.col("n"))), F.lit(0)).alias("n")
    return first.agg(F.lit(name).alias("stage"), n, *map(values, SHOWN), *own)


def stage_profile(stages: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """For each named stage its rows, the first values of some columns, and the elevation ranges."""
    profiles = [_profile(name, df) for name, df in stages]
    if not profiles:
        raise ValueError("no stages")
    return reduce(DataFrame.unionByName, profiles)


def join_key_topn(df: DataFrame, n: int = 12) -> DataFrame:
    """The most frequent matrix keys, nulls counted; ties in key order."""
    keyed = normalize(df).withColumns({c: F.col(c).cast("long") for c in MATRIX_KEY[:3]})
    counted = keyed.groupBy(*MATRIX_KEY).agg(F.count("*").alias("n_rows"))
    return counted.orderBy(F.desc("n_rows"), *(F.asc_nulls_first(c) for c in MATRIX_KEY)).limit(n)


def max_size_for_pots(legend: DataFrame, pots: Iterable[str]) -> DataFrame:
    """``pot, max_size`` for each asked level; null for one that the matrix lacks."""
    asked = legend.sparkSession.createDataFrame([(p,) for p in matrix.canonical(pots)], "pot string")
    level = F.lower(F.trim(POT))
    largest = legend.groupBy(level.alias("of")).agg(F.max(F.col(SIZE).cast("long")).alias("max_size"))
    return asked.join(largest, F.col("pot") == F.col("of"), "left").select("pot", "max_size")


def _kept(steps: Iterable[tuple[str, Column | None]], prefix: str = "kept_") -> list[Column]:
    """Rows left after each of the steps, from all rows on, as aggregates named by their place."""
    passed, counts = F.lit(True), [F.count(F.lit(1)).alias(f"{prefix}0")]
    for i, (_, p) in enumerate(steps, 1):
        passed = passed if p is None else passed & p
        counts.append(F.count_if(passed).alias(f"{prefix}{i}"))
    return counts


def funnel(df: DataFrame, steps: Iterable[tuple[str, Column | None]]) -> DataFrame:
    """``step, n_step, kept``: rows left after each predicate, all in one pass over the data."""
    steps = list(steps)
    names = ["start", *(name for name, _ in steps)]
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("step"), F.lit(i).cast("long").alias("n_step"), F.col(f"kept_{i}").alias("kept"))
            for i, name in enumerate(names)
        )
    )
    return df.agg(*_kept(steps)).select(F.inline(rows))


def step_counts(scenarios: Iterable[Iterable[tuple[str, Column | None]]]) -> list[Column]:
    """The aggregates of :func:`funnel` for several scenarios' steps, to be observed on rows that pass by."""
    return [c for i, steps in enumerate(scenarios) for c in _kept(steps, f"s{i}_")]


def steps_of(observed: Mapping[str, int], position: int, names: Iterable[str]) -> dict[str, int]:
    """What :func:`step_counts` found for the scenario at a position: rows left by step."""
    return {name: observed[f"s{position}_{i}"] for i, name in enumerate(["start", *names])}


def rel_res_pairs(df: DataFrame) -> DataFrame:
    """``praID, resultID, n_rel, n_res, paired``: whether each run has its release and its runout row."""
    kind = F.lower(F.trim("modType"))
    return (
        df.groupBy(*PAIR_KEY)
        .agg(F.count_if(kind == "rel").alias("n_rel"), F.count_if(kind == "res").alias("n_res"))
        .withColumn("paired", (F.col("n_rel") == 1) & (F.col("n_res") == 1))
    )


def rel_res_joined(df: DataFrame) -> DataFrame:
    """Each run's release row with its runout: ``praID, resultID``, and ``rel_`` and ``res_`` columns of all else.

    A run without one of the two gives no row, one with several of a kind each
    combination of them. Over a table of :func:`directory.write_bucketed` the
    join moves no row.
    """
    kind = F.lower(F.trim("modType"))
    own = [c for c in df.columns if c not in (*PAIR_KEY, "modType")]

    def side(of: str) -> DataFrame:
        return df.where(kind == of).select(*PAIR_KEY, *(F.col(c).alias(f"{of}_{c}") for c in own))

    return side("rel").join(side("res"), list(PAIR_KEY))
