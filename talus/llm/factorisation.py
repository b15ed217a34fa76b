"""Quality of documents by a factorisation machine.

A document is a sparse row: its words, hashed to buckets, weighed by how often
they come and scaled to length 1; a bin of each structure statistic of the whole
text; and a bin of each metadata column. The model has a weight and a short
vector for each place, and two places that come together add the product of
their vectors. All pairs cost one pass over the row, since with ``s`` the sum of
the row's vectors, pair by pair, ``sum = (s*s - sum of squares) / 2``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.shipping import with_package

from .common import fold, materialise, to_workers
from .samples import labelled

#: Labelled rows of the sample, and hashed words in all of them, at most.
SAMPLE, ENTRIES = 16_000, 8_000_000
#: Buckets of words, bins of a statistic, numbers in a place's vector.
BUCKETS, BINS, RANK = 1 << 14, 16, 8
#: Training: passes, rows of a step, step sizes of weights and vectors, and the pull to 0.
PASSES, STEP, RATE, VECTOR_RATE, DECAY = 8, 256, 0.1, 0.05, 1e-4
#: Words that a worker remembers the bucket of, each up to so many characters.
REMEMBERED, LONG = 300_000, 64
THRESHOLD = 0.3
METADATA = ("n_chars",)

STATISTICS = (
    "words", "word_length", "symbols", "bangs", "capitals", "shouted", "punctuation", "digits", "bars", "distinct",
    "commonest", "stutters", "repeated_lines", "line_length",
)

_LETTERS = re.compile(r"[^\W\d_]+")


class Reader:
    """What the model sees of a text: buckets with weights, and statistics."""

    def __init__(self) -> None:
        self._buckets: dict[str, int] = {}

    def _bucket(self, word: str) -> int:
        bucket = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % BUCKETS
        if len(word) <= LONG:
            if len(self._buckets) >= REMEMBERED:
                self._buckets.clear()
            self._buckets[word] = bucket
        return bucket

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
        """Distinct buckets, their weights (of length 1 together), and the statistics; nothing and zeros for no word."""
        text = text or ""
        found = text.split()
        counts = Counter(found)
        known = self._buckets.get
        where = np.fromiter((self._bucket(w) if (b := known(w)) is None else b for w in counts), np.int32, len(counts))
        often = np.fromiter(counts.values(), np.float64, len(counts))
        buckets, at = np.unique(where, return_inverse=True)
        weights = 1 + np.log(np.bincount(at, often)) if len(buckets) else np.zeros(0)
        weights /= max(1e-9, np.sqrt((weights * weights).sum()))
        n, letters = max(1, len(found)), max(1, sum(map(len, _LETTERS.findall(text))))
        lines = [line for line in text.split("\n") if line and not line.isspace()]
        stutters = sum(a == b for a, b in zip(found, found[1:]))
        of = text.count
        statistics = [
            np.log1p(len(found)),
            sum(map(len, found)) / n,
            sum(map(of, "#*$%&|<>")) / n,
            (of("!") + of("?")) / n,
            sum(map(str.isupper, text)) / letters,
            sum(c for w, c in counts.items() if w.isupper()) / n,
            sum(map(of, ".,;:\"'()-")) / n,
            sum(map(of, "0123456789")) / n,
            of("|") / n,
            len(counts) / n,
            (max(counts.values()) if counts else 0) / n,
            stutters / n,
            1 - len(set(lines)) / len(lines) if lines else 0.0,
            np.log1p(len(found) / max(1, len(lines))),
        ]
        return buckets, weights.astype(np.float32), [float(s) for s in statistics]


@dataclass
class Rows:
    """Sparse rows one after another: row ``i`` ends before ``starts[i + 1]``."""

    places: np.ndarray
    values: np.ndarray
    starts: np.ndarray

    def some(self, which: np.ndarray) -> Rows:
        sizes = np.diff(self.starts)[which]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(starts[-1]) + np.repeat(self.starts[which] - starts[:-1], sizes)
        return Rows(self.places[at], self.values[at], starts)

    @property
    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


@dataclass
class Model:
    """``edges`` has the bins of each statistic, then of each metadata column, whose last bin is for nulls."""

    metadata: tuple[str, ...]
    edges: list[np.ndarray] = field(default_factory=list)
    bias: float = 0.0
    weights: np.ndarray | None = None
    vectors: np.ndarray | None = None
    prior: float = 0.5

    def rows(self, buckets: list[np.ndarray], weights: list[np.ndarray], numbers: np.ndarray) -> Rows:
        """Sparse rows of documents; ``numbers`` has their statistics and metadata, NaN for null."""
        bins = np.empty(numbers.shape, dtype=np.int64)
        first = BUCKETS
        for c, edges in enumerate(self.edges):
            own = np.searchsorted(edges, numbers[:, c], "right")
            bins[:, c] = first + np.where(np.isnan(numbers[:, c]), len(edges) + 1, own)
            first += len(edges) + 2
        sizes = np.array([len(b) for b in buckets], dtype=np.int64) + bins.shape[1]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        places, values = np.empty(starts[-1], dtype=np.int64), np.ones(starts[-1])
        for i, (b, w) in enumerate(zip(buckets, weights)):
            places[starts[i] : starts[i] + len(b)], values[starts[i] : starts[i] + len(b)] = b, w
            places[starts[i] + len(b) : starts[i + 1]] = bins[i]
        return Rows(places, values, starts)

    @property
    def size(self) -> int:
        return BUCKETS + sum(len(e) + 2 for e in self.edges)

    def _sums(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Each row's margin and the sum of its vectors, in one pass over its places."""
        scaled = self.vectors[rows.places] * rows.values[:, None]
        ends = rows.starts[:-1]
        sums, squares = np.add.reduceat(scaled, ends), np.add.reduceat(scaled * scaled, ends)
        linear = np.add.reduceat(self.weights[rows.places] * rows.values, ends)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(1), sums

    def scores(self, rows: Rows) -> np.ndarray:
        n = len(rows.starts) - 1
        if self.vectors is None or not n:
            return np.full(n, self.prior)
        return 1 / (1 + np.exp(-np.clip(self._sums(rows)[0], -40, 40)))

    def train(self, rows: Rows, y: np.ndarray) -> Model:
        """Steps over the rows, in an order of their own each pass, scaled by each number's past gradients."""
        rng = np.random.default_rng(0)
        n, size = len(y), self.size
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(rate / (1 - rate)))
        self.weights, self.vectors = np.zeros(size), rng.normal(0, 0.05, (size, RANK))
        past_w, past_v, past_b = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
        for _ in range(PASSES):
            order = rng.permutation(n)
            for at in range(0, n, STEP):
                which = order[at : at + STEP]
                part = rows.some(which)
                margin, sums = self._sums(part)
                error = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y[which]) / len(which)
                own = part.owners
                push = part.values * error[own]
                used, place = np.unique(part.places, return_inverse=True)
                g = np.bincount(place, push, len(used)) + DECAY * self.weights[used] / n
                past_w[used] += g * g
                self.weights[used] -= RATE * g / np.sqrt(past_w[used])
                inner = push[:, None] * (sums[own] - part.values[:, None] * self.vectors[part.places])
                gv = np.stack([np.bincount(place, inner[:, f], len(used)) for f in range(RANK)], axis=1)
                gv += DECAY * self.vectors[used]
                past_v[used] += gv * gv
                self.vectors[used] -= VECTOR_RATE * gv / np.sqrt(past_v[used])
                gb = error.sum()
                past_b += gb * gb
                self.bias -= RATE * gb / np.sqrt(past_b)
        return self


def _read(sample: DataFrame, metadata: Sequence[str]) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            found = [reader(t.as_py()) for t in batch.column("text")]
            numbers = [[*f[2], *(batch.column(m)[i].as_py() for m in metadata)] for i, f in enumerate(found)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("h"),
                    batch.column("y"),
                    pa.array([f[0] for f in found], pa.list_(pa.int32())),
                    pa.array([f[1] for f in found], pa.list_(pa.float32())),
                    pa.array(numbers, pa.list_(pa.float64())),
                ],
                names=["h", "y", "buckets", "weights", "numbers"],
            )

    return to_workers(sample).mapInArrow(read, "h long, y int, buckets array<int>, weights array<float>, numbers array<double>")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    label: str = "quality",
    train: Column | None = None,
    metadata: Sequence[str] = METADATA,
    sample: int = SAMPLE,
    entries: int = ENTRIES,
) -> Model:
    """A model from labelled rows whose id meets ``train`` (all by default).

    At most ``sample`` rows are learned from, in the order of their hashes, and
    only as many as have ``entries`` hashed words together: what the driver holds
    is so bounded for texts of any length. Null texts count as empty, rows with
    the same id and content once; null ids and ids without a label teach
    nothing. Columns of ``metadata`` that ``docs`` lacks are left out. Labels of
    one class only give their rate as every score, no label at all 0.5.
    """
    metadata = tuple(m for m in metadata if m in docs.columns)
    names = [f"m{i}" for i in range(len(metadata))]
    columns = {"text": F.col(text).cast("string")} | {n: F.col(m).try_cast("double") for n, m in zip(names, metadata)}
    picked = labelled(docs, labels, columns, id_col, label, F.lit(True) if train is None else train, sample)
    read = materialise(_read(picked, names), "read")
    sizes = read.select("h", F.size("buckets").alias("n")).orderBy("h").toPandas()
    fits = sizes["h"][sizes["n"].cumsum() <= entries]
    model = Model(metadata)
    if not len(fits):
        return model
    rows = read.where(F.col("h") <= int(fits.iloc[-1])).toArrow().sort_by("h")
    y = rows.column("y").to_numpy().astype(float)
    model.prior = float(y.mean())
    if y.min() == y.max():
        return model
    numbers = np.array(rows.column("numbers").to_pylist(), dtype=float)
    for column in numbers.T:
        there = column[~np.isnan(column)]
        model.edges.append(np.unique(np.quantile(there, np.linspace(0, 1, BINS + 1)[1:-1])) if len(there) else np.zeros(0))
    lists = ([v.values.to_numpy() for v in rows.column(c)] for c in ("buckets", "weights"))
    return model.train(model.rows(*lists, numbers), y)


def score(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, score, predicted`` for each row of ``docs``.

    Null and empty texts are rows without words and are scored as such. Null ids
    and repeated rows each get a row; columns but the model's metadata aren't
    read, and one that isn't there counts as null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    metadata_of = len(model.metadata)

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        reader, model = Reader(), shared.value
        for batch in batches:
            texts, *metadata = batch if metadata_of else (batch,)
            found = [reader(t) for t in texts]
            if model.vectors is None or not found:
                yield pd.Series(np.full(len(found), model.prior))
                continue
            numbers = np.column_stack([np.array([f[2] for f in found]), *(m.to_numpy(float) for m in metadata)])
            yield pd.Series(model.scores(model.rows([f[0] for f in found], [f[1] for f in found], numbers)))

    metadata = (F.col(m).try_cast("double") if m in docs.columns else F.lit(None).cast("double") for m in model.metadata)
    out = with_package(to_workers(docs)).select(F.col(id_col).alias("doc_id"), scored(F.col(text).cast("string"), *metadata).alias("score"))
    return out.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def rate(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", folds: int = 5, held_out: int = 0) -> DataFrame:
    """Fit on all folds but ``held_out``, then score every row: ``doc_id, held_out, score, predicted``."""

    def out(c: Column) -> Column:
        return F.coalesce(fold(c, folds) == held_out, F.lit(False))

    model = fit(docs, labels, text, id_col, train=~out(F.col(id_col)))
    return score(docs, model, text, id_col).select("doc_id", out(F.col("doc_id")).alias("held_out"), "score", "predicted")
