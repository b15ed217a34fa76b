"""Figures of the learned operators and of the near-copy search: ``python -m talus.llm.figures SF_DIR``.

Settings are compared on the folds that training may see; the rows whose id falls into the
held-out fold are looked at last, with the settings as they are.
"""

from __future__ import annotations

import sys
from collections import Counter, defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import factorisation, langid, quality, simhash, toxicity
from .common import fold, read

TRAIN, HELD_OUT = (0, 1, 3), 2


def _found(rows: DataFrame, truth: str, found: str) -> dict[str, float]:
    """Precision and recall of the boolean ``found`` for ``truth``."""
    n = rows.agg(
        F.count_if(F.col(truth) & F.col(found)).alias("both"), F.count_if(found).alias("found"), F.count_if(truth).alias("there")
    ).first()
    return {
        "precision": round(n["both"] / max(1, n["found"]), 3),
        "recall": round(n["both"] / max(1, n["there"]), 3),
        "there": n["there"],
    }


def _in(*folds: int) -> Column:
    return F.coalesce(fold(F.col("doc_id")).isin(*folds), F.lit(False))


def toxic(docs: DataFrame, labels: DataFrame) -> dict[str, dict[str, float]]:
    """Each training fold by a model of the other two, then the held-out fold by one of all three."""

    def of(train: tuple[int, ...], tested: int) -> DataFrame:
        model = toxicity.fit(docs, labels, train=_in(*train))
        scored = toxicity.score(docs.where(_in(tested)), model).join(labels.where("toxic IS NOT NULL"), "doc_id")
        return scored.select((F.col("toxic") == 1).alias("truth"), (F.col("predicted") == 1).alias("found"))

    folds = None
    for f in TRAIN:
        part = of(tuple(x for x in TRAIN if x != f), f)
        folds = part if folds is None else folds.union(part)
    return {"folds": _found(folds, "truth", "found"), "held out": _found(of(TRAIN, HELD_OUT), "truth", "found")}


def low_quality(docs: DataFrame, labels: DataFrame) -> dict[str, object]:
    """The list learned from the training folds, on labels that it has not seen and the base rules pass."""
    rules = quality.learn_rules(docs.where(_in(*TRAIN)), labels)
    s = quality.statistics(F.col("text"))
    tested = docs.where(_in(HELD_OUT)).join(labels.where("quality IS NOT NULL"), "doc_id").select("quality", s.alias("s"))
    rows = tested.where(~quality.base_failed(F.col("s"))).select(
        (F.col("quality") == 0).alias("truth"), (quality.verdict(F.col("s"), rules) > 0).alias("found")
    )
    return {"rules": [str(r) for r in rules], "held out": _found(rows, "truth", "found")}


def classified(docs: DataFrame, labels: DataFrame) -> dict[str, dict[str, float]]:
    """Each training fold of five by a model of the other three, then the held-out fold by one of all four; bad documents found."""
    known = labels.where("quality IS NOT NULL")

    def among(*folds: int) -> Column:
        return F.coalesce(fold(F.col("doc_id"), 5).isin(*folds), F.lit(False))

    def of(train: tuple[int, ...], tested: int) -> DataFrame:
        model = factorisation.fit(docs, labels, train=among(*train))
        scored = factorisation.score(docs.where(among(tested)), model).join(known, "doc_id")
        return scored.select((F.col("quality") == 0).alias("truth"), (F.col("predicted") == 0).alias("found"))

    train = (1, 2, 3, 4)
    folds = reduce(DataFrame.union, (of(tuple(x for x in train if x != f), f) for f in train))
    return {"folds": _found(folds, "truth", "found"), "held out": _found(of(train, 0), "truth", "found")}


def languages(docs: DataFrame) -> dict[str, float]:
    rows = langid.identify(docs).where("held_out").join(docs.where("lang IS NOT NULL").select("doc_id", "lang"), "doc_id")
    n = rows.agg(F.count("*").alias("n"), F.count_if(F.col("lang") == F.col("lang_pred")).alias("right")).first()
    return {"held out": round(n["right"] / max(1, n["n"]), 4), "there": n["n"]}


def near_copies(docs: DataFrame) -> dict[str, int]:
    """Documents that go by the rule, found on the driver over rare shingles (an exact join), and those that the search lets go.

    Both by the pipeline's search and by the fingerprint query's four bits. For small tables.
    """
    rows = [(r["doc_id"], r["text"]) for r in docs.where("doc_id IS NOT NULL").select("doc_id", "text").collect()]
    ids: dict[tuple, list[int]] = defaultdict(list)
    for i, t in rows:
        ids[tuple(simhash._wide(t, simhash.NEAR_WORDS, 0)[2].tolist())].append(i)
    sets = [frozenset(k) for k in ids]
    of = list(ids.values())
    often = Counter(h for s in sets for h in s)
    root = list(range(len(sets)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    seen: dict[int, list[int]] = defaultdict(list)
    for k in sorted(range(len(sets)), key=lambda k: len(sets[k])):
        s = sets[k]
        first = sorted(s, key=lambda h: (often[h], h))[: len(s) - -(-len(s) * 4 // 5) + 1]
        for j in {j for h in first for j in seen[h]}:
            both = len(s & sets[j])
            if both >= simhash.SIMILARITY * (len(s) + len(sets[j]) - both):
                root[find(j)] = find(k)
        for h in first:
            seen[h].append(k)
    group: dict[int, list[int]] = defaultdict(list)
    for k, own in enumerate(of):
        group[find(k)] += own
    go = {i for own in group.values() for i in own if i != min(own)}
    found = {r["doc_id"] for r in simhash.similar_groups(docs).where("doc_id <> keep_id").collect()}
    by_bits = {r["doc_id"] for r in simhash.near_groups(docs).where("doc_id <> component_id").collect()}
    return {"texts": len(rows), "go": len(go), "found": len(go & found), "found besides": len(found - go), "found by four bits": len(go & by_bits)}


def main(sf_dir: str) -> None:
    spark = SparkSession.builder.config("spark.ui.showConsoleProgress", "false").getOrCreate()
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    print("quality rules", low_quality(docs, labels))
    print("toxicity", toxic(docs, labels))
    print("quality classifier", classified(docs, labels))
    print("languages", languages(docs))
    print("near copies", near_copies(docs.where(F.size(F.split("text", " ")) >= 20).dropDuplicates(["text"])))


if __name__ == "__main__":
    main(sys.argv[1])
