"""The matrix stage: tags, key check, and the semi join with admissible cells."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.operators import dedup, matrix
from talus.schema import MATRIX_KEY, POT, SIZE

log = logging.getLogger(__name__)

#: A matrix with no more cells than this is broadcast; the built-in one has 86 at most.
BROADCAST_CELLS = 10_000


class UnusableKeys(ValueError):
    """A join key isn't a whole number."""


def check_keys(df: DataFrame) -> None:
    """Raise where a row's PPM, PEM or rSize isn't whole: a cast would silently cut it.

    Whole types need no look at the data.
    """
    loose = [c for c in MATRIX_KEY[:3] if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType, T.DecimalType))]
    if not loose:
        return
    inf = float("inf")
    bad = df.agg(*(F.count_if((F.col(c) != F.floor(c)) | F.col(c).isin(inf, -inf)).alias(c) for c in loose)).first()
    wrong = {c: bad[c] for c in loose if bad[c]}
    if wrong:
        raise UnusableKeys(f"rows whose key is not a whole number: {wrong}")


def whole_key(df: DataFrame, name: str, bound: Column) -> Column:
    """A key column as whole numbers; where ``bound``, a number that isn't whole fails the query that meets it.

    So a run needs no look at the data before its own. Other rows' keys that
    aren't whole become null.
    """
    value, dtype = F.col(name), df.schema[name].dataType
    if not isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return value.cast("long")
    inf = float("inf")
    loose = (value != F.floor(value)) | value.cast("double").isin(inf, -inf)
    said = F.concat(F.lit(f"UnusableKeys: {name} is not a whole number: "), value.cast("string"))
    return F.when(~F.coalesce(loose, F.lit(False)), value.try_cast("long")).when(bound, F.raise_error(said).cast("long"))


def warn_of_no_cell(pots: Iterable[str], size: int | None, rows: list[matrix.Cell]) -> None:
    log.warning("no cell for %s, size %s; largest sizes: %s", list(pots), size, matrix.max_sizes(rows, pots))


def tag(df: DataFrame, pots: Iterable[str], size: int) -> DataFrame:
    """The scenario's levels and size as constant columns, over any of that name."""
    return df.withColumn(POT, F.lit(",".join(sorted(set(matrix.canonical(pots)))))).withColumn(
        SIZE, F.lit(size).cast("long")
    )


def admissible(df: DataFrame, selection: list[matrix.Cell], eager: bool = True) -> DataFrame:
    """Rows whose key is among the selected cells; zero rows if a key column is missing.

    Keys are checked here, or with ``eager`` unset by the query itself.
    """
    if not set(MATRIX_KEY) <= set(df.columns):
        log.warning("the matrix join needs the columns %s", ", ".join(MATRIX_KEY))
        return df.where(F.lit(False))
    if eager:
        check_keys(df)
        keyed = df.withColumns({c: F.col(c).cast("long") for c in MATRIX_KEY[:3]})
    else:
        keyed = df.withColumns({c: whole_key(df, c, F.lit(True)) for c in MATRIX_KEY[:3]})
    keys = matrix.allowed(df.sparkSession, selection)
    if len(selection) <= BROADCAST_CELLS:
        keys = F.broadcast(keys)
    return keyed.join(keys, list(MATRIX_KEY), "left_semi")


def apply(
    df: DataFrame, pots: Iterable[str], size: int, rows: list[matrix.Cell] | None = None, eager: bool = True
) -> DataFrame:
    """The whole stage. No cell for the levels and size: zero rows, untagged.

    Size 1 asks only for release areas, one for each ``praID``; the cells'
    mobility classes don't apply to it.
    """
    rows = matrix.cells() if rows is None else rows
    pots = list(pots)
    selection = matrix.select(rows, pots, size)
    if not selection:
        warn_of_no_cell(pots, size, rows)
        return df.where(F.lit(False))
    df = tag(df, pots, size)
    if size != 1:
        return admissible(df, selection, eager)
    if "modType" not in df.columns:
        log.error("size 1 needs the column modType")
        return df.where(F.lit(False))
    return dedup.one_per_area(df.where(F.col("modType") == "rel"))
