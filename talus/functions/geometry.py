"""WKB geometries: decoding, and their WKT and GeoJSON forms.

Geometry stays WKB while Spark works on rows. Encodings for exports run as
Arrow-batched UDFs over that one column.
"""

from __future__ import annotations

import json
import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAMES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}
_CODES = {v: k for k, v in NAMES.items()}
_PARTS = {4: "Point", 5: "LineString", 6: "Polygon"}


class _Reader:
    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def take(self, order: str, kind: str, n: int = 1) -> tuple:
        fmt = f"{order}{n}{kind}"
        out = struct.unpack_from(fmt, self.data, self.at)
        self.at += struct.calcsize(fmt)
        return out


def _decode(r: _Reader) -> dict:
    order = "<" if r.take("<", "B")[0] else ">"
    (code,) = r.take(order, "I")
    extra = 0
    if code & 0xE0000000:  # flags of the extended form
        extra = bool(code & 0x80000000) + bool(code & 0x40000000)
        if code & 0x20000000:
            r.take(order, "I")
        code &= 0x0FFFFFFF
    extra += {0: 0, 1: 1, 2: 1, 3: 2}[code // 1000]
    kind = code % 1000
    width = 2 + extra

    def points() -> list[list[float]]:
        (n,) = r.take(order, "I")
        flat = r.take(order, "d", n * width)
        return [list(flat[i : i + width]) for i in range(0, n * width, width)]

    if kind not in NAMES:
        raise ValueError(f"WKB geometry type {code} is not known")
    if kind == 1:
        value = list(r.take(order, "d", width))
        return {"type": "Point", "coordinates": [] if value[0] != value[0] else value}
    if kind == 2:
        return {"type": "LineString", "coordinates": points()}
    if kind == 3:
        (n,) = r.take(order, "I")
        return {"type": "Polygon", "coordinates": [points() for _ in range(n)]}
    (n,) = r.take(order, "I")
    parts = [_decode(r) for _ in range(n)]
    if kind == 7:
        return {"type": NAMES[kind], "geometries": parts}
    return {"type": NAMES[kind], "coordinates": [p["coordinates"] for p in parts]}


def decode(wkb: bytes | None) -> dict | None:
    """A GeoJSON geometry from (extended) WKB of either byte order; null stays null."""
    return None if wkb is None else _decode(_Reader(bytes(wkb)))


def bounds(wkb: bytes | None) -> tuple[float, float, float, float] | None:
    """Least x and y, greatest x and y of a geometry; None for a null or an empty one."""
    if wkb is None:
        return None

    def points(part: dict) -> list:
        if part["type"] == "GeometryCollection":
            return [p for g in part["geometries"] for p in points(g)]
        level = [part["coordinates"]] if part["type"] == "Point" else part["coordinates"]
        while level and level[0] and isinstance(level[0][0], list):
            level = [p for below in level for p in below]
        return [p for p in level if p]

    found = points(decode(wkb))
    return (*map(min, zip(*(p[:2] for p in found))), *map(max, zip(*(p[:2] for p in found)))) if found else None


def encode(geometry: dict | None) -> bytes | None:
    """Little-endian WKB of a GeoJSON geometry; the inverse of :func:`decode`."""
    if geometry is None:
        return None
    kind = _CODES[geometry["type"]]
    items = geometry["geometries"] if kind == 7 else geometry["coordinates"]

    def depth(x: list) -> int:
        while x and isinstance(x[0], list):
            x = x[0]
        return len(x)

    width = 2 if kind == 7 else max(2, depth(items))
    head = struct.pack("<BI", 1, kind + (1000 if width == 3 else 3000 if width == 4 else 0))

    def points(p: list) -> bytes:
        return struct.pack("<I", len(p)) + b"".join(struct.pack(f"<{width}d", *xy) for xy in p)

    if kind == 1:
        return head + struct.pack(f"<{width}d", *(items or [float("nan")] * width))
    if kind == 2:
        return head + points(items)
    if kind == 3:
        return head + struct.pack("<I", len(items)) + b"".join(map(points, items))
    parts = items if kind == 7 else [{"type": _PARTS[kind], "coordinates": c} for c in items]
    return head + struct.pack("<I", len(parts)) + b"".join(map(encode, parts))


def _number(x: float) -> str:
    return repr(int(x)) if x == int(x) and abs(x) < 1e15 else repr(x)


def wkt(wkb: bytes | None) -> str | None:
    """Well-known text of a WKB geometry."""
    if wkb is None:
        return None

    def body(kind: str, c: list) -> str:
        if not c:
            return "EMPTY"
        if kind == "Point":
            return f"({' '.join(map(_number, c))})"
        if kind in ("LineString", "MultiPoint"):
            return f"({', '.join(' '.join(map(_number, p)) for p in c)})"
        inner = {"Polygon": "LineString", "MultiLineString": "LineString", "MultiPolygon": "Polygon"}[kind]
        return f"({', '.join(body(inner, p) for p in c)})"

    def text(g: dict) -> str:
        if g["type"] == "GeometryCollection":
            parts = ", ".join(map(text, g["geometries"]))
            return f"GEOMETRYCOLLECTION ({parts})" if parts else "GEOMETRYCOLLECTION EMPTY"
        point, z = g["coordinates"], ""
        while point and isinstance(point[0], list):
            point = point[0]
        z = {3: "Z ", 4: "ZM "}.get(len(point), "")
        return f"{g['type'].upper()} {z}{body(g['type'], g['coordinates'])}"

    return text(_decode(_Reader(bytes(wkb))))


@F.pandas_udf(T.StringType())
def wkb_to_wkt(wkb: pd.Series) -> pd.Series:
    return wkb.map(wkt, na_action="ignore")


@F.pandas_udf(T.StringType())
def wkb_to_geojson(wkb: pd.Series) -> pd.Series:
    return wkb.map(lambda b: json.dumps(decode(b), separators=(",", ":")), na_action="ignore")


@F.pandas_udf(T.BinaryType())
def geojson_to_wkb(text: pd.Series) -> pd.Series:
    return text.map(lambda t: encode(json.loads(t)), na_action="ignore")
