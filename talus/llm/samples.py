"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise


def labelled(
    docs: DataFrame, labels: DataFrame, columns: dict[str, Column], id_col: str, label: str, train: Column, size: int
) -> DataFrame:
    """``of, y, h`` and the given columns of at most ``size`` labelled rows, the same in every run, as a table.

    The ids are those of ``labels`` with the least hashes, ``size`` at most, so
    that they may go to the documents by broadcast. Rows with the same id and the
    same ``columns`` count once; of an id's different rows all are taken as far
    as ``size`` goes. An id is positive if half its labels are or more. No text
    meets a shuffle but those of the sample.
    """
    ids = (
        labels.where(train & F.col(label).isNotNull())
        .groupBy(F.col(id_col).alias("of"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("y"))
        .where(F.col("of").isNotNull())
        .orderBy(F.xxhash64("of"), "of")
        .limit(size)
    )
    known = F.broadcast(materialise(ids, "labelled"))
    own, *names = fresh(docs, "id", *columns)
    read = docs.select(F.col(id_col).alias(own), *(c.alias(n) for c, n in zip(columns.values(), names)))
    rows = read.join(known, F.col(own) == F.col("of")).select("of", "y", *(F.col(n).alias(c) for c, n in zip(columns, names)))
    rows = rows.withColumn("h", F.xxhash64("of", *columns))
    pairs = materialise(rows.select("of", "h").distinct().orderBy(F.xxhash64("of", "h"), "of", "h").limit(size), "picked")
    picked = rows.join(F.broadcast(pairs), ["of", "h"], "left_semi").dropDuplicates(["of", "h"])
    return materialise(picked.select("of", "y", "h", *columns), "sample")
