"""Columns that the map viewer draws from: visibility, colours, popup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.schema import POPUP

#: Colours of the two geometry kinds, of the size classes 1 to 5, and the fallback.
REL_COLOR = "#ff00ff"
RES_COLOR = "#1e00ff"
SIZE_COLORS = ("#09a2ff", "#66ff31", "#fff300", "#ff0000", "#5b0069")
FALLBACK = "#808080"
#: Where on the scale each size colour stands.
RAMP = (0.5, 1.5, 2.5, 3.5, 4.5)
#: Columns that may hold a ready colour, the first that isn't empty wins.
SIZE_HEX = ("hex_size", "hexSize", "hexsize", "size_hex", "__size_hex")
KIND_HEX = ("hex_relRes", "hex_relres", "hexRelRes", "hexrelres", "hex_rel")


def visible(mod_type: Column, show_rel: bool = True, show_res: bool = False) -> Column:
    """Whether a feature is drawn; one without a kind isn't."""
    kind = F.lower(F.coalesce(mod_type, F.lit("")))
    return ((kind == "rel") & F.lit(show_rel)) | ((kind == "res") & F.lit(show_res))


def kind_color(mod_type: Column) -> Column:
    kind = F.lower(mod_type)
    return F.when(kind == "rel", REL_COLOR).when(kind == "res", RES_COLOR)


def size_color(size: Column) -> Column:
    """The colour of a size class; null outside 1 to 5."""
    classes = F.array(*map(F.lit, SIZE_COLORS))
    return F.when(size.between(1, 5), F.get(classes, size.cast("int") - 1))


def picked_hex(df: DataFrame, by_size: bool = False) -> Column:
    """The first colour column that is present and not empty, else the fallback."""
    names = SIZE_HEX if by_size else KIND_HEX
    return F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in names if c in df.columns), F.lit(FALLBACK))


def styled(df: DataFrame, by_size: bool = False, show_rel: bool = True, show_res: bool = False) -> DataFrame:
    """``df`` with ``viewer_visible`` and ``viewer_hex``."""
    return df.withColumns(
        {"viewer_visible": visible(F.col("modType"), show_rel, show_res), "viewer_hex": picked_hex(df, by_size)}
    )


def popup(df: DataFrame) -> DataFrame:
    """The popup's attributes, in its order, as far as present."""
    return df.select(*(c for c in POPUP if c in df.columns))


def ramp_color(value: Column) -> Column:
    """``#rrggbb`` on the piecewise linear size ramp; the end colours hold beyond it."""
    rgb = [tuple(int(c[i : i + 2], 16) for i in (1, 3, 5)) for c in SIZE_COLORS]

    def channel(k: int) -> Column:
        out = F.when(value <= RAMP[0], float(rgb[0][k]))
        for a, b, lo, hi in zip(RAMP, RAMP[1:], rgb, rgb[1:]):
            out = out.when(value <= b, lo[k] + (value - a) / (b - a) * (hi[k] - lo[k]))
        return F.floor(out.otherwise(float(rgb[-1][k])) + 0.5).cast("long")

    parts = [F.lpad(F.lower(F.hex(channel(k))), 2, "0") for k in range(3)]
    return F.when(value.isNotNull(), F.concat(F.lit("#"), *parts))
