"""GeoJSON read by as many tasks as its bytes ask for, wherever they cut it.

Spark's text source splits a file anywhere, and with ``}`` as the line separator
its records are what lies between closing braces: short, and never within an
escape. Whether a task's first record lies within a string, and how deep, only
the bytes before it tell. So a first pass has each split say what it does to
both states, in a text and out of one (a few numbers a split); going through
these in order gives each split the state it begins in. A second pass cuts the
features out. The rest of a feature that a split leaves open is the next split's
head, which another read finds without going on to that split's end.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.functions.geometry import geojson_to_wkb
from talus.schema import GEOMETRY
from talus.shipping import with_package

END = "}"

#: A key's colon and the bracket after it, at the beginning of what follows a text.
_OPENS = re.compile(r"\s*:\s*([\[{])")
_REST_OF_TEXT = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*("?)', re.S)
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*("?)|[\[\]{]', re.S)


def _unescaped(record: str) -> str:
    """A record without escaped backslashes and quotes, so that each quote left ends or begins a text."""
    return record.replace("\\\\", "").replace('\\"', "") if "\\" in record else record


@dataclass
class Effect:
    """What records do to a state: depth by brackets, texts open or not.

    ``member`` has, for each depth at which a member's bracket opened last,
    whether it was the array ``features``; ``lowest`` is the least depth that a
    closing brace led to.
    """

    in_text: bool
    depth: int = 0
    lowest: int | None = None
    member: dict[int, bool] = field(default_factory=dict)

    def feed(self, records: Iterable[str]) -> Effect:
        for record in records:
            parts = _unescaped(record).split('"')
            first = int(self.in_text)
            for i in range(first, len(parts), 2):
                outside = parts[i]
                if i and (opened := _OPENS.match(outside)):
                    # The first part of a record may be the end of a longer key.
                    self.member[self.depth] = opened[1] == "[" and parts[i - 1] == "features" and i > first
                self.depth += outside.count("{") + outside.count("[") - outside.count("]")
            self.in_text ^= len(parts) % 2 == 0
            if not self.in_text:
                self.depth -= 1
                self.lowest = self.depth if self.lowest is None else min(self.lowest, self.depth)
        return self


@dataclass(frozen=True)
class Start:
    """The state a split begins in, and the split that its first feature began in, if it is open."""

    in_text: bool = False
    depth: int = 0
    in_features: bool = False
    owner: int | None = None

    @property
    def is_open(self) -> bool:
        return self.in_features and self.depth > 2


def starts(effects: Iterable[tuple[int, Effect, Effect]]) -> dict[int, Start]:
    """The states of a file's splits, from ``place, effect out of a text, effect in a text`` of each in order."""
    out: dict[int, Start] = {}
    now = Start()
    for at, outside, inside in effects:
        out[at] = now
        done = inside if now.in_text else outside
        depth = now.depth + done.depth
        # A member of the root opens at depth 1.
        in_features = done.member.get(1 - now.depth, now.in_features) and depth > 1
        ended = done.lowest is not None and now.depth + done.lowest <= 2
        owner = now.owner if now.is_open and not ended else at
        now = Start(done.in_text, depth, in_features, owner if in_features and depth > 2 else None)
    return out


def _to_feature(record: str, now: Start) -> tuple[int | None, Start]:
    """Where in a record outside all features the first one begins, or None and the state at its end."""
    at, key, key_end = 0, None, 0
    depth, in_features = now.depth, now.in_features
    if now.in_text:
        rest = _REST_OF_TEXT.match(record)
        if not rest[1]:
            return None, now
        at, key, key_end = rest.end(), None, rest.end()
    for token in _TOKEN.finditer(record, at):
        sign = token[0][0]
        if sign == '"':
            if not token[1]:
                return None, Start(True, depth, in_features)
            key, key_end = token[0][1:-1], token.end()
        elif sign == "]":
            depth -= 1
        elif depth == 2 and in_features and sign == "{":
            return token.start(), Start(False, depth, True)
        else:
            if depth == 1:
                in_features = sign == "[" and key == "features" and record[key_end : token.start()].strip() == ":"
            depth += 1
    return None, Start(False, depth, in_features)


def cut(records: Iterable[str], now: Start) -> Iterator[tuple[bool, bool, str]]:
    """``begun, ended, text`` of the features, or parts of one, that the records hold."""
    is_open, begun, piece = now.is_open, False, []
    in_text, depth = now.in_text, now.depth
    for record in records:
        if not is_open:
            begins, now = _to_feature(record, Start(in_text, depth, now.in_features))
            in_text, depth = now.in_text, now.depth
            if begins is None:
                depth -= not in_text
                continue
            is_open, begun, record = True, True, record[begins:]
        parts = _unescaped(record).split('"')
        for outside in parts[int(in_text) :: 2]:
            depth += outside.count("{") + outside.count("[") - outside.count("]")
        in_text ^= len(parts) % 2 == 0
        piece += (record, END)
        if not in_text:
            depth -= 1
            if depth == 2:
                yield begun, True, "".join(piece)
                is_open, begun, piece = False, False, []
    if piece:
        yield begun, False, "".join(piece)


def _records(spark: SparkSession, path: str) -> DataFrame:
    """``file, at, value``: records in order, with their file and where its split begins."""
    lines = spark.read.option("lineSep", END).text(path)
    file, at = F.xxhash64("_metadata.file_path"), F.col("_metadata.file_block_start")
    return with_package(lines).select(file.alias("file"), at.alias("at"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[str]]]:
    """Each split of a task with its records, which may be left unread."""
    rows = ((key, value) for batch in batches for key, value in zip(zip(*(batch.column(c).to_pylist() for c in ("file", "at"))), batch.column("value").to_pylist()))
    following = next(rows, None)
    while following is not None:
        key = following[0]

        def own() -> Iterator[str]:
            nonlocal following
            while following is not None and following[0] == key:
                value = following[1]
                following = next(rows, None)
                yield value

        values = own()
        yield key, values
        for _ in values:
            pass


def _starts(records: DataFrame) -> dict[tuple[int, int], Start]:
    """The state that each split begins in; the driver sees some numbers of each."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, at), values in _runs(batches):
            effects = Effect(False), Effect(True)
            for value in values:
                for e in effects:
                    e.feed((value,))
            rows = [
                {"file": file, "at": at, "in_text": bool(i), "ends_in_text": e.in_text, "depth": e.depth, "lowest": e.lowest, "member": list(e.member.items())}
                for i, e in enumerate(effects)
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=told)

    told = pa.schema(
        [
            ("file", pa.int64()), ("at", pa.int64()), ("in_text", pa.bool_()), ("ends_in_text", pa.bool_()), ("depth", pa.int64()),
            ("lowest", pa.int64()), ("member", pa.map_(pa.int64(), pa.bool_())),
        ]
    )
    schema = "file long, at long, in_text boolean, ends_in_text boolean, depth long, lowest long, member map<long, boolean>"
    by_file: dict[int, dict[int, dict[bool, Effect]]] = {}
    for r in records.mapInArrow(tell, schema).collect():
        effect = Effect(r["ends_in_text"], r["depth"], r["lowest"], dict(r["member"]))
        by_file.setdefault(r["file"], {}).setdefault(r["at"], {})[r["in_text"]] = effect
    return {
        (file, at): start
        for file, splits in by_file.items()
        for at, start in starts((at, splits[at][False], splits[at][True]) for at in sorted(splits)).items()
    }


def features(spark: SparkSession, path: str) -> DataFrame:
    """``feature``: the text of each feature of the FeatureCollections at ``path``, a file or a folder of them.

    As many partitions as the text source makes of the bytes. A feature's parts
    meet by a broadcast of what lies beyond the split that it begins in: the
    rest of one feature for each split.
    """
    records = _records(spark, path)
    states = spark.sparkContext.broadcast(_starts(records))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, at), values in _runs(batches):
            start = states.value[file, at]
            if start.is_open:
                _, _, text = next(cut(values, start))
                yield pa.RecordBatch.from_pydict({"file": [file], "owner": [start.owner], "at": [at], "text": [text]})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, at), values in _runs(batches):
            found: list[tuple[int | None, str]] = []
            for begun, ended, text in cut(values, states.value[file, at]):
                if begun:
                    found.append((None if ended else at, text))
                if len(found) >= 1000:
                    yield batch(file, found)
                    found = []
            if found:
                yield batch(file, found)

    def batch(file: int, found: list[tuple[int | None, str]]) -> pa.RecordBatch:
        owners, texts = zip(*found)
        names = ["file", "owner", "text"]
        return pa.RecordBatch.from_arrays([pa.array([file] * len(found)), pa.array(owners, pa.int64()), pa.array(texts, pa.string())], names=names)

    open_ends = any(start.is_open for start in states.value.values())
    begun = records.mapInArrow(whole, "file long, owner long, text string")
    if not open_ends:
        return begun.select(F.col("text").alias("feature"))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda p: p["text"])
    rest = records.mapInArrow(heads, "file long, owner long, at long, text string").groupBy("file", "owner").agg(F.array_join(pieces, "").alias("rest"))
    joined = begun.join(F.broadcast(rest), ["file", "owner"], "left")
    return joined.select(F.concat("text", F.coalesce("rest", F.lit(""))).alias("feature"))


def properties_of(found: DataFrame) -> T.StructType:
    """The properties' types, from all features."""
    spark = found.sparkSession
    texts = getattr(found._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    schema = T.StructType.fromJson(json.loads(spark._jsparkSession.read().json(texts).schema().json()))
    kind = next((f.dataType for f in schema if f.name == "properties"), None)
    return kind if isinstance(kind, T.StructType) else T.StructType()


def read(spark: SparkSession, path: str, properties: T.StructType | None = None) -> DataFrame:
    """The features of a FeatureCollection: properties as columns, geometry as WKB.

    Geometries are read as text, since inference degrades mixed types; the
    properties' types are inferred, by a pass over all features, where no schema
    is given.
    """
    found = features(spark, path)
    if properties is None:
        properties = properties_of(found)
    feature = T.StructType().add("properties", properties).add(GEOMETRY, T.StringType())
    rows = found.select(F.from_json("feature", feature).alias("f"))
    columns = [F.col(f"f.properties.`{c}`") for c in properties.names]
    return rows.select(*columns, geojson_to_wkb(F.col(f"f.{GEOMETRY}")).alias(GEOMETRY))
