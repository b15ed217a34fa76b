"""A corpus pipeline: five stages over ``documents``, each writing what the next one reads.

``STAGES`` lists them in order. Each takes ``(spark, docs, sf_dir)`` and returns
a DataFrame; all but the last return the columns of ``documents``. Null ids,
empty texts, repeated rows and extra columns go through every stage as the
operators' docstrings say; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talus.llm import exact_dedup, mixing, packing, quality, simhash
from talus.llm.common import materialise, read


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the list learned from ``labels``; see :func:`quality.keep_good`."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, A-Z lower-cased: that with the largest id; see :func:`exact_dedup.drop_copies`."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, five-word similarity 0.8 or more: that with the smallest id.

    Null ids stay; see :func:`simhash.drop_near_copies`.
    """
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, from none to three times; see :func:`mixing.take_mix`."""
    return mixing.take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of 2,048 tokens; see :func:`packing.packed`."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("mix_sources", mix_sources),
    ("packing", pack),
]

#: Learned rules, fingerprints and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
