"""The hazard matrix: which mobility classes a hazard level and size admit."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talus.schema import MATRIX_KEY, POT, SIZE

SOURCE = "hazard matrix"
VERSION = "2025-11"
BOTH = "res / rel"
REL = "rel"
ALIASES = {"moderat": "moderate"}

#: Hazard level, size, PPM, PEM and the geometries that the cell admits.
CELLS = (
    ("very high", 5, 5, 5, BOTH),
    ("very high", 5, 4, 4, BOTH),
    ("very high", 5, 3, 3, BOTH),
    ("very high", 5, 2, 2, BOTH),
    ("very high", 4, 5, 4, BOTH),
    ("very high", 4, 4, 4, BOTH),
    ("very high", 4, 3, 3, BOTH),
    ("very high", 4, 2, 2, BOTH),
    ("very high", 3, 5, 3, BOTH),
    ("very high", 3, 4, 3, BOTH),
    ("very high", 3, 3, 3, BOTH),
    ("very high", 3, 2, 2, BOTH),
    ("very high", 2, 5, 2, BOTH),
    ("very high", 2, 4, 2, BOTH),
    ("very high", 2, 3, 2, BOTH),
    ("very high", 2, 2, 2, BOTH),
    ("very high", 1, 5, 1, REL),
    ("very high", 1, 4, 1, REL),
    ("very high", 1, 3, 1, REL),
    ("very high", 1, 2, 1, REL),
    ("high", 4, 5, 4, BOTH),
    ("high", 4, 4, 3, BOTH),
    ("high", 4, 3, 2, BOTH),
    ("high", 4, 2, 1, REL),
    ("high", 3, 5, 3, BOTH),
    ("high", 3, 4, 3, BOTH),
    ("high", 3, 3, 2, BOTH),
    ("high", 3, 2, 1, REL),
    ("high", 2, 5, 2, BOTH),
    ("high", 2, 4, 2, BOTH),
    ("high", 2, 3, 2, BOTH),
    ("high", 2, 2, 1, REL),
    ("high", 1, 5, 1, REL),
    ("high", 1, 4, 1, REL),
    ("high", 1, 3, 1, REL),
    ("high", 1, 2, 1, REL),
    ("moderate", 3, 5, 3, BOTH),
    ("moderate", 3, 4, 2, BOTH),
    ("moderate", 3, 3, 1, REL),
    ("moderate", 3, 2, 1, REL),
    ("moderate", 2, 5, 2, BOTH),
    ("moderate", 2, 4, 2, BOTH),
    ("moderate", 2, 3, 1, REL),
    ("moderate", 2, 2, 1, REL),
    ("moderate", 1, 5, 1, REL),
    ("moderate", 1, 4, 1, REL),
    ("moderate", 1, 3, 1, REL),
    ("moderate", 1, 2, 1, REL),
    ("low", 2, 5, 2, BOTH),
    ("low", 2, 4, 1, REL),
    ("low", 2, 3, 1, REL),
    ("low", 2, 2, 1, REL),
    ("low", 1, 5, 1, REL),
    ("low", 1, 4, 1, REL),
    ("low", 1, 3, 1, REL),
    ("low", 1, 2, 1, REL),
)

SCHEMA = f"{POT} string, {SIZE} long, PPM long, PEM long, rSize long, modType string, Source string, Version string"


class Cell(NamedTuple):
    pot: str
    size: int
    ppm: int
    pem: int
    r_size: int
    mod_type: str


def r_size_of(ppm: int, pem: int) -> int:
    return {0: 5, 1: 4, 2: 3, 3: 2}.get(ppm - pem, 1)


def r_size(ppm: Column, pem: Column) -> Column:
    """Relative size: 5 down to 2 for a difference of 0 to 3, else 1."""
    gap = ppm - pem
    return F.when(gap == 0, 5).when(gap == 1, 4).when(gap == 2, 3).when(gap == 3, 2).otherwise(1)


def cells() -> list[Cell]:
    """All rows of the built-in matrix."""
    return [Cell(pot, size, ppm, pem, r_size_of(ppm, pem), mod_type) for pot, size, ppm, pem, mod_type in CELLS]


def matrix(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*c, SOURCE, VERSION) for c in cells()], SCHEMA)


def from_frame(legend: DataFrame) -> list[Cell]:
    """Rows of a matrix given as a DataFrame; a matrix is configuration, and small.

    Levels and geometry kinds are compared in lower case without blanks.
    """
    rows = legend.select(POT, SIZE, "PPM", "PEM", "rSize", "modType").collect()

    def low(x: object) -> str:
        return str(x).strip().lower()

    return [Cell(low(r[0]), *(None if v is None else int(v) for v in r[1:5]), low(r[5])) for r in rows]


def canonical(pots: Iterable[str]) -> list[str]:
    """Hazard levels in lower case without blanks, with aliases resolved."""
    low = [str(p).strip().lower() for p in pots]
    return [ALIASES.get(p, p) for p in low]


def select(rows: Iterable[Cell], pots: Iterable[str], size: int) -> list[Cell]:
    wanted = set(canonical(pots))
    return [c for c in rows if c.pot in wanted and c.size == size]


def max_sizes(rows: Iterable[Cell], pots: Iterable[str]) -> dict[str, int | None]:
    """The largest size that the matrix has for each level; None for an unknown level."""
    rows = list(rows)
    return {p: max((c.size for c in rows if c.pot == p and c.size is not None), default=None) for p in canonical(pots)}


def expand(legend: DataFrame) -> DataFrame:
    """Distinct join keys, a row for each geometry kind that a cell names."""
    kinds = F.explode(F.split(F.lower(F.trim("modType")), " / "))
    return legend.select("PPM", "PEM", "rSize", kinds.alias("modType")).distinct()


def allowed(spark: SparkSession, selection: Iterable[Cell]) -> DataFrame:
    """The distinct join keys of selected cells."""
    keys = {(c.ppm, c.pem, c.r_size, kind) for c in selection for kind in c.mod_type.split(" / ")}
    return spark.createDataFrame(sorted(keys, key=repr), ", ".join(f"{c} {'string' if c == 'modType' else 'long'}" for c in MATRIX_KEY))
