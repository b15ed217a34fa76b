"""Scenario predicates as columns, for Catalyst to combine and push down.

They expect a normalised frame. A predicate whose column is missing is left out
with a warning; one that isn't asked for is None.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.functions.normalize import id_text, uppered

log = logging.getLogger(__name__)


def _has(df: DataFrame, column: str, what: str) -> bool:
    if column in df.columns:
        return True
    log.warning("%s asked for, but there is no column %s", what, column)
    return False


def _ids(df: DataFrame, column: str, ids: Iterable[str], what: str) -> Column | None:
    wanted = sorted({str(i) for i in ids})
    if not wanted or not _has(df, column, what):
        return None
    return id_text(F.col(column), df.schema[column].dataType).isin(wanted)


def region(df: DataFrame, lk: Iterable[str] = (), lwd: Iterable[str] = (), mode: str = "or") -> Column | None:
    """Rows of the listed regions; two lists combine by ``and`` if the mode says so, else by or."""
    parts = [
        p
        for p in (_ids(df, "LKGebietID", lk, "LK region filter"), _ids(df, "LWDGebietID", lwd, "LWD region filter"))
        if p is not None
    ]
    if not parts:
        return None
    both = mode.strip().lower() == "and"
    return reduce(lambda a, b: a & b if both else a | b, parts)


def sub_catchment(df: DataFrame, values: Iterable[int]) -> Column | None:
    wanted = list(values)
    return F.col("subC").isin(wanted) if wanted and _has(df, "subC", "subC filter") else None


def sector(df: DataFrame, values: Iterable[str]) -> Column | None:
    """Exact compass points: ``E`` isn't ``NE``."""
    wanted = sorted({str(v).strip().upper() for v in values})
    return uppered(F.col("sector")).isin(wanted) if wanted and _has(df, "sector", "sector filter") else None


def flow(df: DataFrame, values: Iterable[str]) -> Column | None:
    wanted = sorted({str(v).strip().lower() for v in values})
    return F.col("flow").isin(wanted) if wanted and _has(df, "flow", "flow filter") else None


def elevation(df: DataFrame, low: float | None = None, high: float | None = None) -> list[Column]:
    """The row's band lies within the asked one, ends included; rows without a bound don't."""
    out = []
    if low is not None and _has(df, "elevMin", "elevMin filter"):
        out.append(F.col("elevMin") >= float(low))
    if high is not None and _has(df, "elevMax", "elevMax filter"):
        out.append(F.col("elevMax") <= float(high))
    return out


def pushable_elevation(df: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """A raw frame without rows that :func:`elevation` is bound to drop, in a form that reaches the scan.

    Normalised doubles hide behind the test for NaN; the raw comparison doesn't
    and lets no more than NaN through.
    """
    for name, bound, test in (("elevMin", low, Column.__ge__), ("elevMax", high, Column.__le__)):
        if bound is not None and name in df.columns and isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            df = df.where(test(F.col(name), float(bound)))
    return df


def pushable(
    df: DataFrame,
    lk: Iterable[str] = (),
    lwd: Iterable[str] = (),
    mode: str = "or",
    sub_catchments: Iterable[int] = (),
    low: float | None = None,
    high: float | None = None,
) -> Column | None:
    """A weaker form of the other predicates on a raw frame's own columns, all of it fit for the scan; None without one.

    Where several scenarios are tested together, a disjunction reaches the scan
    only if each of its parts does in whole.
    """

    def typed(name: str, *kinds: type) -> bool:
        return name in df.columns and isinstance(df.schema[name].dataType, kinds)

    parts = []
    asked = [name for name, ids in (("LKGebietID", lk), ("LWDGebietID", lwd)) if ids]
    if asked and all(typed(name, T.StringType) for name in asked):
        parts.append(region(df, lk, lwd, mode))
    if sub_catchments and typed("subC", T.IntegralType):
        parts.append(F.col("subC").isin(list(sub_catchments)))
    # Whole columns take whole bounds: a cast of the column would hide it from the scan.
    for name, bound, test, rounded in (("elevMin", low, Column.__ge__, math.ceil), ("elevMax", high, Column.__le__, math.floor)):
        if bound is not None and math.isfinite(bound):
            if typed(name, T.IntegralType):
                parts.append(test(F.col(name), rounded(bound)))
            elif typed(name, T.FloatType, T.DoubleType):
                parts.append(test(F.col(name), float(bound)))
    return reduce(lambda a, b: a & b, parts) if parts else None


def where_all(df: DataFrame, predicates: Iterable[Column | None]) -> DataFrame:
    for p in predicates:
        if p is not None:
            df = df.where(p)
    return df
