"""One row for each release area: windows under a total order, one shuffle each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talus.schema import GEOMETRY, VARIANT_KEY


def _first(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each group.

    Groups meet before they are sorted: a task's rows sorted where they lie, to
    leave the losers out, spill once they outgrow its memory. Rows with geometry
    are dearer to move than to sort, and only their tasks' winners are moved.
    """
    nth = "__nth"
    named = {f"__key{i}": k for i, k in enumerate(keys) if isinstance(k, Column)}
    keys = [f"__key{i}" if isinstance(k, Column) else k for i, k in enumerate(keys)]
    rows = df.withColumns(named) if named else df
    if GEOMETRY not in df.columns:
        rows = rows.repartition(*keys)
    ranked = rows.withColumn(nth, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(nth) == 1).drop(nth, *named)


def single_r_size(df: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """The largest relative size among the variants of a release area; without ``rSize`` all rows.

    Nulls in the key are equal. Ties go to the smallest ``resultID``, so the
    release and runout rows that stay come from one run where there is one,
    then ``PEM`` and ``PPM``.
    """
    if "rSize" not in df.columns:
        return df
    keys = [c for c in (*extra_keys, *VARIANT_KEY) if c in df.columns]
    ties = [F.col(c) for c in ("resultID", "PEM", "PPM") if c in df.columns]
    return _first(df, keys, [F.desc_nulls_last("rSize"), *ties])


def one_per_area(df: DataFrame) -> DataFrame:
    """The smallest ``PEM``, then the largest ``rSize``, of each ``praID``; without one all rows."""
    if "praID" not in df.columns:
        return df
    order = [F.asc_nulls_last("PEM")] if "PEM" in df.columns else []
    order += [F.desc_nulls_last("rSize")] if "rSize" in df.columns else []
    order += [F.col("resultID")] if "resultID" in df.columns else []
    return _first(df, ["praID"], order or [F.lit(0)])


def of_columns(df: DataFrame, areas: list[bool], singles: list[bool]) -> tuple[list[bool], list[bool]]:
    """Which scenarios each rule applies to, given a table's columns; none has both."""
    areas = [a and "praID" in df.columns for a in areas]
    return areas, [s and not a and "rSize" in df.columns for a, s in zip(areas, singles)]


def ranked_together(df: DataFrame, of: Callable[[list], Column], areas: list[bool], singles: list[bool]) -> DataFrame:
    """The rows that each scenario of a joint table keeps, by one window whatever their kinds.

    ``of`` gives a scenario's constant. Scenarios in ``areas`` keep a row for
    each ``praID`` as :func:`one_per_area` does, which leaves nothing for the
    other rule; those in ``singles`` one for each group of variants as
    :func:`single_r_size` does; all others every row.
    """
    areas, singles = of_columns(df, areas, singles)
    if all(singles):
        return single_r_size(df, ("scenario",))
    if not any(areas) and not any(singles):
        return df
    area, single = of(areas), of(singles)
    alone, of_area = "__alone", "__of_area"
    # A row that isn't ranked is a group of its own.
    rows = df.withColumns({alone: F.when(~(area | single), F.monotonically_increasing_id()), of_area: area})
    keys = ["scenario", alone, "praID"] if "praID" in df.columns else ["scenario", alone]
    keys += [F.when(~F.col(of_area), F.col(c)) for c in VARIANT_KEY if c in df.columns and c != "praID"]
    have = [c for c in ("PEM", "PPM") if c in df.columns]
    order = [F.asc_nulls_last(F.when(F.col(of_area), F.col("PEM")))] if "PEM" in have else []
    order += [F.desc_nulls_last("rSize")] if "rSize" in df.columns else []
    order += [F.col("resultID")] if "resultID" in df.columns else []
    order += [F.when(~F.col(of_area), F.col(c)) for c in have]
    return _first(rows, keys, order or [F.lit(0)]).drop(alone, of_area)


#: How many rows a row of :func:`alike` stands for.
ALIKE = "__alike"


def alike(df: DataFrame, columns: list[str], of_group: Column, variants: bool) -> DataFrame:
    """``df`` with one row for all that agree in ``scenario``, ``columns`` and the keys of the groups they may be in.

    Rows not ``of_group`` are in none; ``variants`` says whether groups are those
    of :func:`single_r_size` too.
    """
    keys = [c for c in VARIANT_KEY if c in df.columns and c not in columns and (variants or c == "praID")]
    grouped = df.groupBy("scenario", *columns, *(F.when(of_group, F.col(c)).alias(c) for c in keys))
    return grouped.agg(F.count("*").alias(ALIKE))


def counted_together(df: DataFrame, of: Callable[[list], Column], areas: list[bool], singles: list[bool]) -> DataFrame:
    """``scenario, n``: how many rows :func:`ranked_together` would keep of those that rows of :func:`alike` stand for.

    A rule keeps one row of each group, so its groups are counted, and rows
    where there is no rule. Tasks do so before they meet: no row is sorted, and
    of a group's rows each task passes on its keys once.
    """
    areas, singles = of_columns(df, areas, singles)
    area, single = of(areas), of(singles)
    keys = [F.when(area | single, F.col("praID")).alias("__praID")] if "praID" in df.columns else []
    if any(singles):
        keys += [F.when(single, F.col(c)).alias(f"__{c}") for c in VARIANT_KEY if c in df.columns and c != "praID"]
    groups = df.groupBy("scenario", *keys).agg(F.sum(ALIKE).alias("n"))
    return groups.groupBy("scenario").agg(F.sum(F.when(area | single, 1).otherwise(F.col("n"))).alias("n"))
