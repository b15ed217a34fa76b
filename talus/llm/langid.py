"""Language identification with n-gram filters of language bitmasks.

Every table slot holds a bitmask with a bit for each language: a Bloom filter
for each language, laid out bit-sliced. One look at an n-gram's slots, ANDed,
returns all languages that contain it. For each language the n-grams of a text
that it contains are counted, the count is corrected for the filter's false
positives, and the highest decides.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.shipping import with_package

from .common import fold, materialise

#: Character n-grams, over lower-cased letters with each other run as one space.
GRAMS = (2, 3, 4)
#: Slots of a table for each n-gram that it holds, rounded up to a power of two within these bounds;
#: the upper one is 32 MB for up to 64 languages. Slots that each n-gram takes.
SLOTS_PER_GRAM = 16
MIN_SLOTS, MAX_SLOTS = 1 << 12, 1 << 22
HASHES = 2
#: Documents of the training sample, at most.
SAMPLE = 12_000
#: A language contains an n-gram that so many documents have, and this part as frequently as in any language.
LEAST_DOCS = 2
LEAST_SHARE = 0.75
#: Characters hashed together: a bound on memory for very long texts.
BLOCK = 1 << 18

UNDETERMINED = "und"


_PLAINLY_OTHER = re.compile(r"[\W\d_]+")


@cache
def _other() -> tuple[frozenset[str], re.Pattern]:
    """Marks and numbers, and runs of anything but letters and the marks that stand on them."""
    marks = "".join(chr(c) for c in range(0x300, 0x1E900) if unicodedata.category(chr(c))[0] == "M")
    numbers = "".join(chr(c) for c in range(0xB2, 0x1FC00) if unicodedata.category(chr(c)) in ("No", "Nl"))
    return frozenset(marks + numbers), re.compile(rf"(?:[^\w{re.escape(marks)}]|[\d_{re.escape(numbers)}])+")


def _plain(text: str) -> str:
    low = text.lower()
    odd, other = _other()
    # Without marks and such numbers the plain class says the same, much faster.
    return f" {(_PLAINLY_OTHER if odd.isdisjoint(low) else other).sub(' ', low).strip()} "


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def grams(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of all n-grams of a plain text, in blocks that overlap by an n-gram."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    most = max(GRAMS) - 1
    for start in range(0, max(1, len(points) - most), BLOCK):
        part = points[start : start + BLOCK + most]
        last = start + BLOCK + most >= len(points)
        rolled = np.zeros(len(part), dtype=np.uint64)
        for n in range(1, most + 2):
            size = len(part) - n + 1
            if size <= 0:
                break
            rolled = rolled[:size] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1 :]
            if n in GRAMS:
                # Shorter n-grams past the block's own places belong to the next block.
                mixed = rolled if last else rolled[:BLOCK]
                mixed = (mixed + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)
                yield mixed ^ (mixed >> np.uint64(31))


def _slots(hashes: np.ndarray, k: int, slots: int) -> np.ndarray:
    """The ``k``-th slot of each hash, from bits of its own."""
    return (hashes >> np.uint64(k * 32)) & np.uint64(slots - 1)


def slots_for(n_grams: int) -> int:
    """A table size, a power of two, for so many n-grams."""
    return min(MAX_SLOTS, max(MIN_SLOTS, 1 << (max(1, n_grams * SLOTS_PER_GRAM) - 1).bit_length()))


class LanguageFilters:
    """Bit-sliced Bloom filters: ``masks[word, slot]`` has a bit for each of up to 64 languages a word."""

    def __init__(self, languages: list[str], slots: int = MIN_SLOTS) -> None:
        if slots & (slots - 1) or slots > 1 << 32:
            raise ValueError("slots must be a power of two, 2^32 at most")
        self.languages = languages
        self.slots = slots
        self.masks = np.zeros((max(1, -(-len(languages) // 64)), slots), dtype=np.uint64)
        self.false_rate = np.zeros(len(languages))

    def add(self, language: int, hashes: np.ndarray) -> None:
        word, bit = divmod(language, 64)
        for k in range(HASHES):
            self.masks[word, _slots(hashes, k, self.slots)] |= np.uint64(1 << bit)

    def seal(self) -> LanguageFilters:
        """Measure each slice: a false positive finds all of its slots set by others."""
        for i in range(len(self.languages)):
            word, bit = divmod(i, 64)
            share = np.count_nonzero(self.masks[word] & np.uint64(1 << bit)) / self.slots
            self.false_rate[i] = share**HASHES
        return self

    def languages_of(self, hashes: np.ndarray) -> np.ndarray:
        """``[word, n-gram]``: the bitmasks of all languages that contain each n-gram."""
        found = self.masks[:, _slots(hashes, 0, self.slots)]
        for k in range(1, HASHES):
            found &= self.masks[:, _slots(hashes, k, self.slots)]
        return found

    def decide(self, text: str | None) -> tuple[str, float]:
        """The language of a whole text, and its part of the corrected counts.

        A text that is null or has no letter is undetermined. Ties, and texts
        with no known n-gram (score 0), go to the language first in the list.
        """
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        plain = _plain(text)
        counts, total = np.zeros(len(self.languages)), 0
        for hashes in grams(plain):
            total += len(hashes)
            found = self.languages_of(hashes)
            for i in range(len(self.languages)):
                word, bit = divmod(i, 64)
                counts[i] += np.count_nonzero(found[word] & np.uint64(1 << bit))
        true = np.clip((counts - total * self.false_rate) / np.maximum(1e-9, 1 - self.false_rate), 0, None)
        best = int(true.argmax())
        return self.languages[best], float(true[best] / true.sum()) if true[best] > 0 else 0.0


def _sample(docs: DataFrame, text: str, lang: str, id_col: str, train: Column, size: int) -> DataFrame:
    """At most ``size`` training rows, the same in every run: those with the least hashes.

    Rows with one hash are equal in id, text and language, so any of them will do.
    """
    rows = docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(id_col), F.col(text).cast("string"), F.col(lang).cast("string")).alias("h"),
    )
    least = materialise(rows.select("h").orderBy("h").limit(size), "least")
    last = least.agg(F.max("h").alias("h")).first()["h"]
    if last is None:
        return rows.where("false").drop("h")
    at_last = least.where(F.col("h") == last).count()
    picked = rows.where(F.col("h") < last).unionByName(rows.where(F.col("h") == last).limit(at_last))
    return picked.drop("h")


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    id_col: str = "doc_id",
    train: Column | None = None,
    sample: int = SAMPLE,
) -> LanguageFilters:
    """Filters learned from ``train`` rows with a language (all by default), ``sample`` of them at most.

    N-grams are counted by language, and kept by their part of all n-grams of
    the language. Languages are listed by the number of sampled documents, then
    by name. Tables have slots for the n-grams kept, up to ``MAX_SLOTS``; fuller
    ones have more false positives, which the counts are corrected for.
    """
    picked = _sample(docs, text, lang, id_col, F.lit(True) if train is None else train, sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for language, texts in frame.groupby("lang")["text"]:
                each = [np.unique(np.concatenate(list(grams(_plain(t)))), return_counts=True) for t in texts]
                values, which, docs_with = np.unique(
                    np.concatenate([v for v, _ in each]), return_inverse=True, return_counts=True
                )
                times = np.bincount(which, np.concatenate([n for _, n in each])).astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([language] * len(values), pa.string()),
                        "gram": pa.array(values.view(np.int64)),
                        "docs": pa.array(docs_with.astype(np.int64)),
                        "n": pa.array(times),
                    }
                )

    sizes = {r["lang"]: r["n"] for r in picked.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes, key=lambda name: (-sizes[name], name))
    if not sizes:
        return LanguageFilters([])
    counted = with_package(picked).mapInArrow(count, "lang string, gram long, docs long, n long")
    counts = materialise(
        counted.groupBy("lang", "gram").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")), "grams"
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()
    total = F.element_at(F.create_map(*(F.lit(x) for r in totals for x in (r["lang"], r["total"]))), F.col("lang"))
    place = F.element_at(F.create_map(*(F.lit(x) for i, name in enumerate(languages) for x in (name, i))), F.col("lang"))
    shares = counts.select("gram", place.alias("place"), "docs", (F.col("n") / total).alias("share"))
    most = shares.groupBy("gram").agg(F.max("share").alias("most"))
    kept = shares.join(most, "gram").where((F.col("docs") >= LEAST_DOCS) & (F.col("share") >= LEAST_SHARE * F.col("most")))
    kept = materialise(kept.select("gram", "place"), "kept")
    filters = LanguageFilters(languages, slots_for(kept.select("gram").distinct().count()))
    # Folded into masks by slot, so that the driver gets a row for each slot at most, however long the texts.
    slots = F.array(*(F.shiftrightunsigned("gram", 32 * k).bitwiseAND(F.lit(filters.slots - 1)) for k in range(HASHES)))
    bit = kept.select(F.explode(slots).alias("slot"), F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, place & 63)").alias("bit"))
    for word in range(len(filters.masks)):
        found = bit.where(F.col("word") == word).groupBy("slot").agg(F.bit_or("bit").alias("mask")).toPandas()
        filters.masks[word, found["slot"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(np.uint64)
    return filters.seal()


def predict(docs: DataFrame, filters: LanguageFilters, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, lang_pred, score`` for each row of ``docs``; see :meth:`LanguageFilters.decide`.

    Null ids and repeated rows each get a row; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("lang_pred string, score double")
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        decider = shared.value
        for texts in batches:
            yield pd.DataFrame([decider.decide(t) for t in texts], columns=["lang_pred", "score"])

    return with_package(docs).select(F.col(id_col).alias("doc_id"), decide(F.col(text).cast("string")).alias("p")).select("doc_id", "p.*")


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", held_out: int = 2) -> DataFrame:
    """Fit on all folds but ``held_out``, then predict every row: ``doc_id, held_out, lang_pred, score``.

    Rows without a text or a language teach nothing, null ids are held out of
    nothing, and repeated rows count as often as they are there; without any row
    to learn from every text is undetermined. See :func:`predict`.
    """
    is_out = F.coalesce(fold(F.col(id_col)) == held_out, F.lit(False))
    filters = fit(docs, text, lang, id_col, ~is_out)
    return predict(docs, filters, text, id_col).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
