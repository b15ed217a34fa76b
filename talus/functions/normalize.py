"""Normalisation of directory columns. Every function maps columns to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.schema import LOWERED, NUMERIC

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def strip(c: Column) -> Column:
    """Without white space of any kind at either end; ``trim`` knows only blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def lowered(c: Column) -> Column:
    return F.lower(strip(c.cast("string")))


def uppered(c: Column) -> Column:
    return F.upper(strip(c.cast("string")))


def numeric(c: Column, dtype: T.DataType) -> Column:
    """A number or null: whole types become long, all others double.

    What doesn't parse is null, and so is NaN, which would pass ``>=``. Text
    such as ``1d`` is no number, though a cast would take it.
    """
    if isinstance(dtype, _WHOLE):
        return c.cast("long")
    if isinstance(dtype, T.StringType):
        text = strip(c)
        c = F.when(~F.rlike(text, F.lit(r"(?i)[0-9.][df]$")), text)
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def id_text(c: Column, dtype: T.DataType) -> Column:
    """An id as text, to compare with ids from a configuration; whole floats lose their ``.0``."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def fix_case(df: DataFrame) -> DataFrame:
    """Rename columns that are ``PPM`` or ``PEM`` but for their case.

    Raises ValueError where that would give two columns one name.
    """
    renames: dict[str, str] = {}
    for name in ("PPM", "PEM"):
        found = [c for c in df.columns if c.upper() == name]
        if len(found) > 1:
            raise ValueError(f"columns {', '.join(found)} differ only in case; keep one")
        if found and found[0] != name:
            renames[found[0]] = name
    return df.withColumnsRenamed(renames) if renames else df


def normalize(df: DataFrame) -> DataFrame:
    """Column case, numbers, and lower-case text, for those columns that are present. Idempotent."""
    df = fix_case(df)
    changed = {c: numeric(F.col(c), df.schema[c].dataType) for c in NUMERIC if c in df.columns}
    changed |= {c: lowered(F.col(c)) for c in LOWERED if c in df.columns}
    return df.withColumns(changed) if changed else df
