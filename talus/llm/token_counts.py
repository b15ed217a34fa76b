"""Token counts from an exact histogram of encoded lengths.

One scan encodes every document and counts documents by length. The histogram
has a row for each length that occurs, and suffix sums over it answer totals,
quantiles and truncated totals for every context limit, without another look at
the documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talus.shipping import with_package

from .common import materialise
from .encode import encoder, word_vocabulary

#: Lengths that share a window; suffix sums run within it and over the windows' totals.
SPAN = 1024


def lengths(docs: DataFrame, vocabulary: str | None = None, text: str = "text") -> DataFrame:
    """``length, docs``: how many documents encode to each number of tokens.

    Null and blank texts have length 0. Each task sends a row for each length it met.
    """
    path = vocabulary or word_vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        seen: Counter = Counter()
        for batch in batches:
            seen.update(len(words.encode(value.as_py())) // 4 for value in batch.column(0))
        words.forget()
        yield pa.RecordBatch.from_pydict(
            {"length": pa.array(list(seen), pa.int64()), "docs": pa.array(list(seen.values()), pa.int64())}
        )

    counted = with_package(docs).select(F.col(text).cast("string").alias("text")).mapInArrow(count, "length long, docs long")
    return counted.groupBy("length").agg(F.sum("docs").alias("docs"))


def histogram(docs: DataFrame, vocabulary: str | None = None, text: str = "text") -> DataFrame:
    """The histogram with its suffix sums, a row for each length that occurs.

    Columns: ``length, docs, tokens``; ``docs_from, tokens_from``, of this length
    and longer; ``share_below``, the share of documents shorter than this one;
    ``truncated``, all tokens when documents are cut at this length. Repeated
    rows count each time; an empty table gives no rows.
    """
    counts = materialise(lengths(docs, vocabulary, text).withColumn("span", F.floor(F.col("length") / SPAN)), "lengths")
    counts = counts.withColumn("tokens", F.col("length") * F.col("docs"))
    spans = counts.groupBy("span").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = spans.select(
        "span",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(every).alias("all_docs"),
        F.sum("t").over(every).alias("all_tokens"),
    )
    within = Window.partitionBy("span").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = counts.join(after, "span")
    docs_from = F.sum("docs").over(within) + F.col("docs_after")
    tokens_from = F.sum("tokens").over(within) + F.col("tokens_after")
    summed = joined.withColumn("docs_from", docs_from).withColumn("tokens_from", tokens_from)
    return summed.select(
        "length",
        "docs",
        "tokens",
        "docs_from",
        "tokens_from",
        (1 - F.col("docs_from") / F.col("all_docs")).alias("share_below"),
        (F.col("all_tokens") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("truncated"),
    )


def truncated_total(hist: DataFrame, limit: int) -> DataFrame:
    """``limit, truncated``: all tokens when documents are cut at any ``limit``, as one row."""
    cut = F.sum(F.col("docs") * F.least(F.col("length"), F.lit(limit)))
    return hist.agg(F.lit(limit).cast("long").alias("limit"), F.coalesce(cut, F.lit(0)).alias("truncated"))


def quantile(hist: DataFrame, share: float) -> DataFrame:
    """``share, length``: the least length with ``share`` of the documents at or below it (null if there are none)."""
    at_or_below = F.col("share_below") + F.col("docs") / (F.col("docs_from") / (1 - F.col("share_below")))
    return hist.where(at_or_below >= share - 1e-12).agg(F.lit(share).alias("share"), F.min("length").alias("length"))
