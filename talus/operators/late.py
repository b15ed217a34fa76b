"""Late geometry: choose rows by their narrow columns, then read the wide ones of those alone.

A row's address is its file and its place there. What a selection keeps becomes
bitmaps, one for each 32,768 rows of a file, which the second read looks its rows
up in by a broadcast join: rows that lose meet neither a sort nor a shuffle with
their geometry, and those that stay only with each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.schema import GEOMETRY

FILE, ROW = "__file", "__row"
#: Rows that a bitmap of 4 KB speaks for, and bitmaps that are broadcast at most: 64 MB, for 5 * 10^8 rows.
BITMAP_ROWS = 32_768
MOST_BITMAPS = 16_384


def addressed(df: DataFrame) -> DataFrame:
    """A table as read from Parquet files, with each row's address."""
    return df.withColumns({FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")})


def bitmaps(kept: DataFrame) -> DataFrame:
    """``file, bucket, bits`` of the addresses in ``kept``, which may repeat."""
    place = F.col(ROW) + 1  # buckets count from 1
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    return kept.groupBy(F.col(FILE).alias("file"), F.bitmap_bucket_number(place).alias("bucket")).agg(bits)


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def only(df: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of an addressed table that :func:`bitmaps` has."""
    place = F.col(ROW) + 1
    joined = df.join(F.broadcast(found), (F.col(FILE) == F.col("file")) & (F.bitmap_bucket_number(place) == F.col("bucket")))
    return joined.where(_is_set(F.col("bits"), F.bitmap_bit_position(place))).select(*df.columns)


def selected_late(df: DataFrame, select: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``select(df)``, with the geometry read only for rows that it keeps.

    ``df`` is a table as read from Parquet files and ``select`` keeps some of
    its rows whatever others are left out that it doesn't keep, as scenarios and
    the choice among variants do; it must pass on columns that it doesn't know.
    It runs twice: over the narrow columns of all rows, then over all columns of
    those it kept. A table without geometry, or too long for the bitmaps, is
    selected from at once.
    """
    if GEOMETRY not in df.columns:
        return select(df)
    # Footers tell a table's rows; each of its files may end within a bitmap.
    n_files = len(df.inputFiles())
    if df.count() // BITMAP_ROWS + n_files > MOST_BITMAPS:
        return select(df)
    rows = addressed(df)
    kept = select(rows.drop(GEOMETRY)).select(FILE, ROW)
    return select(only(rows, bitmaps(kept)).drop(FILE, ROW))
