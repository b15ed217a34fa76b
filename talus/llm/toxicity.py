"""Toxicity: gradient-boosted trees over dense features, calibrated isotonically.

Labelled training documents, a bounded sample, teach three things in turn, each
from a part of its own: a lexicon of words and word beginnings that toxic
documents have and clean ones lack; trees over lexicon densities, second-person
proximity, capitals, punctuation and obfuscation rates; and the isotonic map
from the trees' margin to a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.shipping import with_package

from .common import fold
from .samples import labelled

#: Labelled rows of the sample, at most, and its parts for lexicon, trees and calibration.
SAMPLE = 24_000
PARTS = (0.6, 0.85)
#: Lexicon: entries at most; toxic documents that have an entry, at least, and its precision.
LEXICON = 20_000
LEAST_DOCS = 4
LEAST_PRECISION = 0.8
#: Entries that a task counts before it passes their counts on.
COUNTED = 500_000
#: Lengths of word beginnings that the lexicon may hold.
STEMS = (4, 5, 6, 7, 8)
#: Words around a lexicon word that second-person words are looked for in.
NEAR = 4
THRESHOLD = 0.3

#: Second-person words of some languages: fixed values.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "usted ustedes ti tuyo vosotros os".split()
)
#: Characters that stand for letters: fixed values.
LEET = str.maketrans("013457@$!|", "oieastasil")

_WORD = re.compile(r"[^\W_]+(?:[@$!|*_.\-][^\W_]+)*")
_MARKED = re.compile(r"[\d@$!|*_.\-]")
FEATURES = (
    "word_density", "stem_density", "words_hit", "stems_hit", "near_you", "you_density",
    "capitals", "shouted", "bangs", "punctuation", "obfuscated", "repeated_letters", "masked_hits",
)


def _plain(word: str) -> str:
    """A word lower-cased, with letters for the signs that stand for them and no separators."""
    return re.sub(r"[*_.\-]", "", word.lower().translate(LEET))


def _entries(word: str) -> list[str]:
    """The lexicon entries a word could match: itself, and ``=`` with each of its beginnings."""
    return [word, *("=" + word[:n] for n in STEMS if len(word) >= n)]


def document_entries(text: str | None) -> set[str]:
    out: set[str] = set()
    for word in set(_WORD.findall(text or "")):
        out.update(_entries(_plain(word) if _MARKED.search(word) else word.lower()))
    return out


class Featurizer:
    """Dense features of whole texts under a lexicon."""

    def __init__(self, lexicon: set[str], remembered: int = 300_000) -> None:
        self.lexicon = lexicon
        self.remembered = remembered
        self._known: dict[str, int] = {}

    def _kind(self, word: str) -> int:
        """Bits: 1 lexicon word, 2 lexicon stem, 4 second person, 8 obfuscated, 16 repeated letters, 32 a hit only unmasked."""
        low = word.lower()
        kind = 4 * (low in SECOND_PERSON)
        plain = low
        if _MARKED.search(low) and any(c.isalpha() for c in low):
            plain = _plain(low)
            kind |= 8
        entries = _entries(plain)
        hit = (plain in self.lexicon) + 2 * any(e in self.lexicon for e in entries[1:])
        if re.search(r"([^\W\d_])\1\1", low):
            kind |= 16
            if not hit:
                squeezed = re.sub(r"([^\W\d_])\1{2,}", r"\1", plain)
                hit = (squeezed in self.lexicon) + 2 * any(e in self.lexicon for e in _entries(squeezed)[1:])
        if hit and plain != low:
            kind |= 32
        if len(word) <= 64:
            if len(self._known) >= self.remembered:
                self._known.clear()
            self._known[word] = kind | hit
        return kind | hit

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        found = _WORD.findall(text)
        known = self._known.get
        kinds = np.fromiter((self._kind(w) if (k := known(w)) is None else k for w in found), np.int64, len(found))
        n = max(1, len(found))
        hits = np.flatnonzero(kinds & 3)
        near = 0
        if len(hits):
            you = np.flatnonzero(kinds & 4)
            near = np.count_nonzero(np.searchsorted(you, hits + NEAR, "right") > np.searchsorted(you, hits - NEAR)) if len(you) else 0
        letters = max(1, len(text))
        upper = sum(map(str.isupper, found))
        words_hit, stems_hit = np.count_nonzero(kinds & 1), np.count_nonzero(kinds & 2)
        bangs = text.count("!") + text.count("?")
        signs = bangs + sum(map(text.count, ".,;:\"'*#$%&"))
        return [
            words_hit / n,
            stems_hit / n,
            float(min(words_hit, 50)),
            float(min(stems_hit, 50)),
            near / n,
            np.count_nonzero(kinds & 4) / n,
            sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) / letters,
            upper / n,
            bangs / n,
            signs / n,
            np.count_nonzero(kinds & 8) / n,
            np.count_nonzero(kinds & 16) / n,
            float(min(np.count_nonzero(kinds & 32), 50)),
        ]


@dataclass
class Boosted:
    """Binary log-loss boosting with depth-wise trees over quantile bins."""

    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    penalty: float = 2.0
    bias: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    forest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        # Rare values above all quantiles still need an edge below them.
        self.edges = [np.unique(np.append(e, (c[c > 0].min() / 2,) if (c > 0).any() else ())) for e, c in zip(self.edges, x.T)]
        binned = self._bin(x)
        mean = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.bias = float(np.log(mean / (1 - mean)))
        margin = np.full(len(y), self.bias)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(binned, p - y, p * (1 - p))
            self.forest.append(tree)
            margin += self._apply(tree, binned)
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)], axis=1)

    def _grow(self, binned: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = 2**self.depth - 1
        feature, cut, value = np.zeros(inner, int), np.full(inner, 1 << 30), np.zeros(2 * inner + 1)
        at = np.zeros(len(grad), int)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            g, h = grad[rows].sum(), hess[rows].sum()
            best = 1e-6
            for f, edges in enumerate(self.edges):
                left_g = np.bincount(binned[rows, f], grad[rows], len(edges) + 1).cumsum()[:-1]
                left_h = np.bincount(binned[rows, f], hess[rows], len(edges) + 1).cumsum()[:-1]
                gain = (
                    left_g**2 / (left_h + self.penalty)
                    + (g - left_g) ** 2 / (h - left_h + self.penalty)
                    - g**2 / (h + self.penalty)
                )
                if len(gain) and gain.max() > best:
                    best, feature[node], cut[node] = gain.max(), f, int(gain.argmax())
            at[rows] = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
        leaves = range(inner, 2 * inner + 1)
        value[inner:] = [-self.rate * grad[at == n].sum() / (hess[at == n].sum() + self.penalty) for n in leaves]
        return feature, cut, value

    def _apply(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], binned: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        at, rows = np.zeros(len(binned), int), np.arange(len(binned))
        for _ in range(self.depth):
            at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
        return value[at]

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._bin(x)
        return self.bias + sum((self._apply(t, binned) for t in self.forest), np.zeros(len(x)))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of the best non-decreasing fit."""
    places, which = np.unique(x, return_inverse=True)
    sums, weights = np.bincount(which, y), np.bincount(which).astype(float)
    pools: list[list[float]] = []  # sum of y, weight, first x, last x
    for at, total, weight in zip(places, sums, weights):
        pools.append([total, weight, at, at])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            total, weight, _, last = pools.pop()
            pools[-1][0] += total
            pools[-1][1] += weight
            pools[-1][3] = last
    knots = [(at, s / w) for s, w, first, last in pools for at in dict.fromkeys((first, last))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


@dataclass
class ToxicityModel:
    lexicon: set[str]
    trees: Boosted | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None
    prior: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or self.knots is None:
            return np.full(len(x), self.prior)
        return np.interp(self.trees.margin(x), *self.knots)


def _lexicon(rows: DataFrame) -> set[str]:
    """Entries that mark toxic documents, from document counts; ``LEXICON`` at most, the best first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: Counter = Counter()
        seen: Counter = Counter()

        def counted() -> pa.RecordBatch:
            # All of them: an entry's clean documents may be spread over tasks one by one.
            names = list(seen)
            columns = {"entry": names, "toxic": [toxic[e] for e in names], "docs": [seen[e] for e in names]}
            toxic.clear()
            seen.clear()
            return pa.RecordBatch.from_pydict(columns, schema=pa.schema([("entry", pa.string()), ("toxic", pa.int64()), ("docs", pa.int64())]))

        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("y")):
                entries = document_entries(text.as_py())
                seen.update(entries)
                if y.as_py():
                    toxic.update(entries)
                if len(seen) >= COUNTED:
                    yield counted()
        yield counted()

    counts = with_package(rows).select("text", "y").mapInArrow(count, "entry string, toxic long, docs long")
    best = (
        counts.groupBy("entry")
        .agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"))
        .where((F.col("toxic") >= LEAST_DOCS) & (F.col("toxic") >= LEAST_PRECISION * F.col("docs")))
        .orderBy(F.desc(F.col("toxic") / (F.col("docs") + 5)), "entry")
        .limit(LEXICON)
    )
    return {r["entry"] for r in best.collect()}


def _features(rows: DataFrame, lexicon: set[str]) -> pd.DataFrame:
    """Features of sampled rows on the driver: SAMPLE rows of a dozen numbers at most."""

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Featurizer(lexicon)
        for batch in batches:
            x = [of(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part").cast(pa.int32()), batch.column("y").cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))],
                names=["part", "y", "x"],
            )

    return with_package(rows).mapInArrow(featurize, "part int, y int, x array<double>").toPandas()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    label: str = "toxic",
    train: Column | None = None,
    sample: int = SAMPLE,
) -> ToxicityModel:
    """A model from labelled rows whose id meets ``train`` (all by default), ``sample`` of them at most.

    An id is toxic if half its labels are or more. Rows with the same id and text
    count once, null texts as empty; null ids and ids without a label teach
    nothing. Without rows of both classes in each part the score is the rate of
    toxic labels, 0 if there is none.
    """
    picked = labelled(docs, labels, {"text": F.col(text).cast("string")}, id_col, label, F.lit(True) if train is None else train, sample)
    u = F.pmod(F.xxhash64("of", F.lit(7)), F.lit(10_000)) / 10_000
    picked = picked.select(F.when(u < PARTS[0], 0).when(u < PARTS[1], 1).otherwise(2).alias("part"), "text", "y")
    lexicon = _lexicon(picked.where("part = 0"))
    rows = _features(picked.where("part > 0"), lexicon)
    model = ToxicityModel(lexicon, prior=float(rows["y"].mean()) if len(rows) else 0.0)
    parts = [rows[rows["part"] == p] for p in (1, 2)]
    if any(p["y"].nunique() < 2 for p in parts):
        parts = [rows, rows]  # too few for parts of their own
    if len(rows) and rows["y"].nunique() == 2:
        (x, y), (cx, cy) = ((np.array(p["x"].tolist()), p["y"].to_numpy(float)) for p in parts)
        # In an order that doesn't depend on how the rows came.
        order, c_order = np.lexsort((*x.T, y)), np.lexsort((*cx.T, cy))
        model.trees = Boosted().fit(x[order], y[order])
        model.knots = isotonic(model.trees.margin(cx[c_order]), cy[c_order])
    return model


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, score, predicted`` for each row of ``docs``.

    A score is the value of the isotonic map, so documents that it doesn't tell
    apart have the same. Null and empty texts have all features 0 and are scored
    so; null ids and repeated rows each get a row. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Featurizer(shared.value.lexicon)
        for texts in batches:
            yield pd.Series(shared.value.scores(np.array([of(t) for t in texts]).reshape(len(texts), len(FEATURES))))

    out = with_package(docs).select(F.col(id_col).alias("doc_id"), scored(F.col(text).cast("string")).alias("score"))
    return out.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def rate(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", held_out: int = 2) -> DataFrame:
    """Fit on all folds but ``held_out``, then score every row: ``doc_id, held_out, score, predicted``.

    Null ids are held out of nothing and teach nothing; see :func:`fit` and :func:`score`.
    """
    model = fit(docs, labels, text, id_col, train=F.coalesce(fold(F.col(id_col)) != held_out, F.lit(False)))
    return score(docs, model, text, id_col).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == held_out, F.lit(False)).alias("held_out"), "score", "predicted"
    )
