"""Configuration files, path rules and scenario sections. All on the driver."""

from __future__ import annotations

import configparser
import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from talus.sources import files
from talus.sources.files import Place

log = logging.getLogger(__name__)

#: Names in the folder tree that runs share with other steps.
INPUT_DIR, INPUT_FILE = "12_avaDirectory", "avaDirectoryResults.parquet"
OUTPUT_DIR = "13_avaScenMaps"
RASTER_DIR, RASTER_GLOB, RASTER_FILE = "00_input", "10DTM_*.tif", "refDTM.tif"


def read_config(path: str | Path) -> configparser.ConfigParser:
    """The file at ``path``, overridden key by key by a sibling named ``local_<name>``."""
    path = Path(path)
    if not path.is_file():
        raise FileNotFoundError(path)
    cfg = configparser.ConfigParser()
    with path.open(encoding="utf-8") as f:
        cfg.read_file(f)
    local = path.with_name(f"local_{path.name}")
    if local.is_file():
        cfg.read(local, encoding="utf-8")
    return cfg


@dataclass(frozen=True)
class Paths:
    base: Place
    directory: Place
    output: Place
    raster: Place


def resolve_paths(cfg: configparser.ConfigParser) -> Paths:
    """Input and output of a run, and the output folder made.

    Places may be on any file system that Spark knows. In the mode
    ``customPaths`` they are given. Otherwise they lie under the base folder,
    where the input may be one level deeper: one such file wins over one
    directly in the folder, several raise RuntimeError.
    """
    given = dict(cfg["PATHS"]) if cfg.has_section("PATHS") else {}

    def place(key: str, default: object = "") -> Place:
        return files.place(given.get(key.lower(), default))

    base = place("baseDir", Path.cwd())
    if cfg.get("WORKFLOW", "mapperPathMode", fallback="").strip().lower() == "custompaths":
        lacking = [key for key in ("avaDirectoryResults", "avaScenMapsDir") if key.lower() not in given]
        if lacking:
            raise KeyError(f"customPaths mode needs {' and '.join(lacking)} in [PATHS]")
        paths = Paths(base, place("avaDirectoryResults"), place("avaScenMapsDir"), place("refTif"))
    else:
        paths = Paths(
            base,
            _only_one(files.listed(base / INPUT_DIR, "*", INPUT_FILE), base / INPUT_DIR / INPUT_FILE),
            base / OUTPUT_DIR,
            min(files.listed(base / RASTER_DIR, RASTER_GLOB), default=base / RASTER_DIR / RASTER_FILE),
        )
    files.make_folder(paths.output)
    return paths


def _only_one(found: Iterable[Place], otherwise: Place) -> Place:
    """The one place found, ``otherwise`` if there is none."""
    first, *more = sorted(found) or [otherwise]
    if more:
        raise RuntimeError(f"several inputs, name one in customPaths mode: {', '.join(map(str, (first, *more)))}")
    return first


def as_list(value: Any) -> list:
    """None is empty, text splits at commas without blanks and empty parts, all else is a list already."""
    if value is None:
        return []
    if isinstance(value, str):
        return [part.strip() for part in value.split(",") if part.strip()]
    return list(value)


@dataclass(frozen=True)
class Scenario:
    """What a scenario selects. ``pots`` without entries or no ``size``: no matrix stage."""

    name: str = "unnamed"
    lk: tuple[str, ...] = ()
    lwd: tuple[str, ...] = ()
    region_mode: str = "or"
    sub_catchments: tuple[int, ...] = ()
    sectors: tuple[str, ...] = ()
    flows: tuple[str, ...] = ()
    elev_min: float | None = None
    elev_max: float | None = None
    pots: tuple[str, ...] = ()
    size: int | None = None
    single_r_size: bool = True
    debug_keys: bool = False
    #: Levels were asked for, even if only blanks: the matrix stage runs and finds nothing.
    pots_given: bool = field(default=False)

    @property
    def uses_matrix(self) -> bool:
        return (bool(self.pots) or self.pots_given) and self.size is not None

    @property
    def stem(self) -> str:
        """The name as a file stem: letters, digits, ``-`` and ``_``."""
        return "".join(c for c in self.name if c.isalnum() or c in "-_") or "unnamed"

    @classmethod
    def from_criteria(cls, crit: Mapping[str, Any]) -> Scenario:
        """From a mapping of criteria, with numbers as numbers and lists as lists or comma-separated text."""
        return cls(**_fields(crit, _CRITERIA))


def _texts(value: Any) -> tuple[str, ...]:
    return tuple(str(part) for part in as_list(value) if str(part).strip())


def _whole(value: Any) -> int | None:
    """A whole number; None for nothing, and with a warning for other text."""
    if isinstance(value, str):
        if not value.strip():
            return None
        try:
            return int(value)
        except ValueError:
            log.warning("%r is not a whole number; it is left out", value)
            return None
    return None if value is None else int(value)


def _flag(value: Any) -> bool:
    if isinstance(value, str):
        try:
            return configparser.ConfigParser.BOOLEAN_STATES[value.strip().lower()]
        except KeyError:
            raise ValueError(f"not a yes or no: {value!r}") from None
    return bool(value)


def _one_whole(value: Any) -> tuple[int, ...]:
    number = _whole(value)
    return () if number is None else (number,)


#: What a scenario may say, with the field that it fills and how its value is read.
_COMMON = {
    "name": ("name", str),
    "LKRegionID": ("lk", _texts),
    "LwdRegionID": ("lwd", _texts),
    "regionMode": ("region_mode", lambda v: str(v).strip() or "or"),
    "AvaDistributionPotential": ("pots", _texts),
    "AvaSizePotential": ("size", _whole),
    "applySingleRsizeRule": ("single_r_size", _flag),
}
#: The further keys of a section of the configuration.
_SECTION = _COMMON | {
    "subC": ("sub_catchments", _one_whole),
    "sector": ("sectors", _texts),
    "flow": ("flows", _texts),
    "elevMin": ("elev_min", _whole),
    "elevMax": ("elev_max", _whole),
}
#: The further keys of a mapping of criteria.
_CRITERIA = _COMMON | {
    "subCs": ("sub_catchments", lambda v: tuple(int(x) for x in as_list(v))),
    "sectors": ("sectors", lambda v: tuple(as_list(v))),
    "flows": ("flows", lambda v: tuple(as_list(v))),
    "elevMin": ("elev_min", lambda v: v),
    "elevMax": ("elev_max", lambda v: v),
    "debugJoinKeys": ("debug_keys", _flag),
}


def _fields(given: Mapping[str, Any], table: Mapping[str, tuple[str, Callable]]) -> dict[str, Any]:
    """The fields of a :class:`Scenario` that the given keys fill; a key without a value fills none."""
    found = {field: read(given[key]) for key, (field, read) in table.items() if given.get(key) is not None}
    return found | {"pots_given": bool(given.get("AvaDistributionPotential"))}


def scenarios(cfg: configparser.ConfigParser) -> list[Scenario]:
    """The listed scenarios in order; a listed one without a section is left out with a warning."""
    out = []
    for short in as_list(cfg.get("FILTER", "filters", fallback=None)):
        if not cfg.has_section(f"FILTER.{short}"):
            log.warning("there is no section [FILTER.%s]", short)
            continue
        fields = _fields(cfg[f"FILTER.{short}"], _SECTION)
        # In a file, levels of blanks alone are no levels.
        out.append(Scenario(**({"name": short} | fields | {"pots_given": bool(fields.get("pots"))})))
    return out


def scenarios_from_bulletin(source: str | None) -> list[Scenario]:
    """Scenarios from a forecast bulletin: not offered, as in the engine this one stands in for; always empty."""
    log.warning("scenarios from a bulletin (%s) are not available", source)
    return []
