"""Scenario selection: region, attributes, hazard matrix, one row for each release area."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from talus.functions.normalize import normalize
from talus.operators import dedup, diagnostics, legend, matrix, predicates
from talus.schema import MATRIX_KEY, POT, SIZE
from talus.sources.config import Scenario

log = logging.getLogger(__name__)


#: The predicates of a scenario, in their order.
STEPS = ("region", "subC", "sector", "flow", "elevMin", "elevMax")


def attribute_predicates(df: DataFrame, s: Scenario) -> list[tuple[str, Column | None]]:
    """The named predicates of a scenario, in their order, over a normalised frame."""
    low = predicates.elevation(df, low=s.elev_min)
    high = predicates.elevation(df, high=s.elev_max)
    found = (
        predicates.region(df, s.lk, s.lwd, s.region_mode),
        predicates.sub_catchment(df, s.sub_catchments),
        predicates.sector(df, s.sectors),
        predicates.flow(df, s.flows),
        low[0] if low else None,
        high[0] if high else None,
    )
    return list(zip(STEPS, found))


def filtered(df: DataFrame, s: Scenario) -> DataFrame:
    """Region and attribute filters over a normalised frame. A sector filter leaves sectors in upper case."""
    out = predicates.where_all(df, (p for _, p in attribute_predicates(df, s)))
    if s.sectors and "sector" in df.columns:
        out = out.withColumn("sector", predicates.uppered(F.col("sector")))
    return out


def filter_scenario(df: DataFrame, s: Scenario, rows: list[matrix.Cell] | None = None, eager: bool = True) -> DataFrame:
    """The scenario's rows of a directory table.

    ``rows`` is another hazard matrix. Raises UnusableKeys where a surviving
    row's matrix key isn't whole; with ``eager`` unset no look is taken at the
    data here, and the query that meets such a row fails.
    """
    out = filtered(normalize(predicates.pushable_elevation(df, s.elev_min, s.elev_max)), s)
    if s.debug_keys and set(MATRIX_KEY) <= set(out.columns):
        for r in diagnostics.join_key_topn(out).collect():
            log.info("matrix key %s", r.asDict())
    if s.uses_matrix:
        out = legend.apply(out, s.pots, s.size, rows, eager)
    return dedup.single_r_size(out) if s.single_r_size else out


def master(results: Iterable[DataFrame]) -> DataFrame:
    """All scenarios' rows by column name; a column that a result lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)


def run_together(
    df: DataFrame, scenarios: list[Scenario], rows: list[matrix.Cell] | None = None, counts: Observation | None = None
) -> DataFrame:
    """All scenarios' rows in one scan of the data and one shuffle, with a column ``scenario`` (position, from 0).

    Equal to :func:`filter_scenario` for each, whatever mix of kinds they are,
    with the tags null where a scenario has no matrix stage. Each row is tested
    against all predicates at once, and only matches go on. A cell of another
    matrix with a null in its key matches no row; a key that isn't whole fails
    the query. ``counts`` receives how many rows each step of each scenario
    leaves (:func:`diagnostics.steps_of`): then all rows are read, since a
    predicate that reached the scan would leave its rows uncounted.
    """
    return dedup.ranked_together(*_matched_together(df, scenarios, rows, counts))


def count_together(df: DataFrame, scenarios: list[Scenario], rows: list[matrix.Cell] | None = None) -> DataFrame:
    """``scenario, n``: how many rows :func:`run_together` gives each scenario; one without rows isn't there."""
    return dedup.counted_together(*_matched_together(df, scenarios, rows, alike=True))


def _matched_together(
    df: DataFrame, scenarios: list[Scenario], rows: list[matrix.Cell] | None = None, counts: Observation | None = None, alike: bool = False
) -> tuple[DataFrame, Callable, list[bool], list[bool]]:
    """Each scenario's rows before one of several is chosen, and what that choice needs; see :func:`run_together`.

    With ``alike`` rows that no scenario tells apart are one, with their number
    as :data:`dedup.ALIKE`, and have only the columns that a count needs.
    """
    rows = matrix.cells() if rows is None else rows
    if counts is None:
        asked = [predicates.pushable(df, s.lk, s.lwd, s.region_mode, s.sub_catchments, s.elev_min, s.elev_max) for s in scenarios]
        if all(a is not None for a in asked):
            df = df.where(reduce(lambda a, b: a | b, asked))
    base = normalize(df)
    steps = [attribute_predicates(base, s) for s in scenarios]
    if counts is not None:
        base = base.observe(counts, *diagnostics.step_counts(steps))
    tests = []
    for s, own in zip(scenarios, steps):
        if s.uses_matrix and not matrix.select(rows, s.pots, s.size):
            legend.warn_of_no_cell(s.pots, s.size, rows)
        test = reduce(lambda a, b: a & b, (p for _, p in own if p is not None), F.lit(True))
        tests.append(test & (F.col("modType") == "rel") if s.uses_matrix and s.size == 1 else test)
    matching = F.array(*(F.when(test, F.lit(i)) for i, test in enumerate(tests)))
    taken = base.where(reduce(lambda a, b: a | b, tests)).withColumn("scenario", F.array_compact(matching))
    areas, singles = [s.uses_matrix and s.size == 1 for s in scenarios], [s.single_r_size for s in scenarios]
    if alike:
        of_area, of_single = dedup.of_columns(base, areas, singles)
        of_group = reduce(lambda a, b: a | b, (t for t, a, s in zip(tests, of_area, of_single) if a or s), F.lit(False))
        taken = dedup.alike(taken, [c for c in MATRIX_KEY if c in base.columns], of_group, any(of_single))
    hit = taken.withColumn("scenario", F.explode("scenario"))

    def of(value) -> Column:
        """A scenario's constant, looked up by position."""
        return F.get(F.array(*map(F.lit, value)), F.col("scenario"))

    tags = {
        POT: of([",".join(sorted(set(matrix.canonical(s.pots)))) if s.uses_matrix else None for s in scenarios]).cast("string"),
        SIZE: of([s.size if s.uses_matrix else None for s in scenarios]).cast("long"),
    }
    if "sector" in hit.columns:
        tags["sector"] = F.when(of([bool(s.sectors) for s in scenarios]), predicates.uppered(F.col("sector"))).otherwise(F.col("sector"))
    tagged = hit.withColumns(tags)
    # A scenario without a matrix stage, or of size 1 with a cell, takes any key.
    free = [not s.uses_matrix or (s.size == 1 and bool(matrix.select(rows, s.pots, 1))) for s in scenarios]
    every = tagged if all(free) else _of_cells(tagged, scenarios, rows, of, free)
    return every, of, areas, singles


def _of_cells(tagged: DataFrame, scenarios: list[Scenario], rows: list[matrix.Cell], of: Callable, free: list[bool]) -> DataFrame:
    """Rows whose key is among the cells that their scenario selects, and all rows of free scenarios."""
    keys = {
        (i, c.ppm, c.pem, c.r_size, kind)
        for i, s in enumerate(scenarios)
        if s.uses_matrix and s.size != 1
        for c in matrix.select(rows, s.pots, s.size)
        if None not in (c.ppm, c.pem, c.r_size)
        for kind in c.mod_type.split(" / ")
    }
    names = [f"__{c}" for c in MATRIX_KEY[:3]]
    schema = f"scenario int, {', '.join(f'{n} long' for n in names)}, modType string"
    cells = tagged.sparkSession.createDataFrame(sorted(keys, key=repr), schema)
    if len(keys) <= legend.BROADCAST_CELLS:
        cells = F.broadcast(cells)
    bound = F.lit(True) if not any(free) else ~of(free)
    checked = {n: legend.whole_key(tagged, c, bound & (F.col(SIZE) > 1)) for n, c in zip(names, MATRIX_KEY)}
    keyed, on = tagged.withColumns(checked), ["scenario", *names, "modType"]
    if not any(free):
        found = keyed.join(cells, on, "left_semi")
        whole = {c: F.col(n) for n, c in zip(names, MATRIX_KEY)}
        return found.withColumns(whole).select("scenario", *MATRIX_KEY, *(c for c in tagged.columns if c not in ("scenario", *MATRIX_KEY)))
    listed = cells.withColumn("__listed", F.lit(True))
    found = keyed.join(listed, on, "left").where(of(free) | F.col("__listed"))
    return found.select("scenario", *MATRIX_KEY, *(c for c in tagged.columns if c not in ("scenario", *MATRIX_KEY)))


def one_of(together: DataFrame, s: Scenario, position: int) -> DataFrame:
    """A scenario's own rows of :func:`run_together`, with the columns that :func:`filter_scenario` gives it.

    The order is that of the joint table, which puts the matrix key first.
    """
    rows = together.where(F.col("scenario") == position).drop("scenario")
    return rows if s.uses_matrix else rows.drop(POT, SIZE)
