"""Quality rules: a learned, ordered decision list over text statistics.

Sequential covering learns what low-quality labelled documents have in common:
a rule grows one threshold condition at a time by FOIL gain on the grow fold,
is pruned from its end on the prune fold, and is accepted if it is precise
there; the documents it covers leave, and the next rule grows on the rest. The
counts behind every step are Spark aggregates over a contingency table of all
labelled documents. The list is applied as one ordered CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import BlockedBloom
from .common import NOT_SPACE, fold, fresh, let, materialise, words

#: Window of the repetition count, in words.
WINDOW = 8
#: Base rules: fewer words, or a larger share of words in repeated windows, fail.
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
SYMBOLS = r"[#*$%&|<>]"

#: The statistics that the base rules' contract names.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: What the learned conditions may test, from the statistics in ``s``.
FEATURES = {
    "mean_word_chars": "s.word_chars / s.n_words",
    "symbols_per_word": "s.n_symbols / s.n_words",
    "dup_line_share": "s.n_dup_lines / s.n_lines",
    "repeat_word_share": "s.n_repeat_words / s.n_words",
    "upper_share": "s.n_upper / s.word_chars",
    "digit_share": "s.n_digits / s.word_chars",
    "bangs_per_word": "s.n_bangs / s.n_words",
}


def _covered(hashes: Column, n: int) -> Column:
    """Words in windows of ``n`` whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

    def starts(sorted_pairs: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            return F.coalesce(F.get(sorted_pairs, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                F.get(sorted_pairs, i + 1)["h"] == x["h"], F.lit(False)
            )

        return F.sort_array(F.transform(F.filter(sorted_pairs, twin), lambda x: x["p"]))

    def length(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(n), F.coalesce(F.get(at, i + 1) - p, F.lit(n))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    return let(pairs, lambda s: let(starts(s), length))


def repeated_words(found: Column, n: int = WINDOW) -> Column:
    """Words of the array ``found`` in ``n``-word windows that occur twice or more, first included.

    Windows compare by 64-bit hash, within one document only. ``found`` must be
    a column or lambda variable: it is used for every window.
    """
    windows = F.transform(F.sequence(F.lit(1), F.size(found) - (n - 1)), lambda i: F.xxhash64(F.slice(found, i, n)))
    zero = F.lit(0).cast("long")
    counted = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(_covered(h, n)))
    return F.when(F.size(found) > n, counted).otherwise(zero)


def statistics(text: Column, n: int = WINDOW) -> Column:
    """A struct of long counts over a whole text; a null text counts as empty."""

    def count(t: Column, pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern)).cast("long")

    def lines_of(t: Column) -> Column:
        return F.filter(F.split(t, "\n"), lambda line: F.rlike(line, F.lit(NOT_SPACE)))

    return let(
        F.coalesce(text.cast("string"), F.lit("")),
        lambda t: let(
            F.struct(words(t).alias("w"), lines_of(t).alias("l")),
            lambda x: F.struct(
                F.size(x["w"]).cast("long").alias("n_words"),
                F.char_length(F.array_join(x["w"], "")).cast("long").alias("word_chars"),
                count(t, SYMBOLS).alias("n_symbols"),
                (F.size(x["l"]) - F.size(F.array_distinct(x["l"]))).cast("long").alias("n_dup_lines"),
                let(x["w"], lambda w: repeated_words(w, n)).alias("n_repeat_words"),
                F.size(x["l"]).cast("long").alias("n_lines"),
                count(t, "[A-Z]").alias("n_upper"),
                count(t, "[0-9]").alias("n_digits"),
                count(t, "!").alias("n_bangs"),
            ),
        ),
    )


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEATED_PERCENT * s["n_words"])


def _feature(name: str, s: Column) -> Column:
    over, under = (s[part.strip().removeprefix("s.")] for part in FEATURES[name].split("/"))
    return F.when(under > 0, over / under).otherwise(0.0)


def _bin(value: Column, thresholds: list[float]) -> Column:
    """How many of the thresholds are ``value`` or less."""
    return F.size(F.filter(F.array(*map(F.lit, thresholds)), lambda t: t <= value))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, s: Column) -> Column:
        value = _feature(self.feature, s)
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass(frozen=True)
class Learner:
    """Bounds of the search.

    ``quantiles`` thresholds per feature and class, rules of ``max_conditions``
    at most. A rule is accepted if on the prune fold, a quarter of the labelled
    rows, ``min_precision`` of the rows it covers are bad and ``min_cover`` at
    least. A rule's own ``precision`` is that share, Laplace-corrected.
    """

    quantiles: int = 16
    max_rules: int = 12
    max_conditions: int = 4
    min_precision: float = 0.9
    min_cover: int = 3

    def fit(self, labelled: DataFrame) -> list[Rule]:
        """Rules that find ``bad`` rows of ``labelled`` (``doc_id, s, bad``).

        One class alone, or no rows, give no rules.
        """
        thresholds = self._thresholds(labelled)
        if thresholds is None:
            return []
        names = list(FEATURES)
        bins = [_bin(F.col(f), thresholds[f]).alias(f) for f in names]
        values = labelled.select("doc_id", "bad", *(_feature(f, F.col("s")).alias(f) for f in names))
        table = values.select("bad", (fold(F.col("doc_id")) == 3).alias("prune"), *bins)
        table = materialise(table.groupBy("prune", "bad", *names).agg(F.count("*").alias("n")), "contingency")
        rules: list[Rule] = []
        left = F.lit(True)
        while len(rules) < self.max_rules:
            grown = self._grow(table.where(~F.col("prune") & left), thresholds)
            rule = self._pruned(table.where(F.col("prune") & left), grown, thresholds)
            if rule is None:
                break
            rules.append(rule)
            left = left & ~self._binned(rule.conditions, thresholds)
        return rules

    def _thresholds(self, labelled: DataFrame) -> dict[str, list[float]] | None:
        at = F.array(*(F.lit((i + 0.5) / self.quantiles) for i in range(self.quantiles)))
        asked = [
            F.percentile_approx(F.when(F.col("bad") == bad, _feature(f, F.col("s"))), at, 2000).alias(f"{f}_{int(bad)}")
            for f in FEATURES
            for bad in (False, True)
        ]
        row = labelled.agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"), *asked).first()
        if not row["bad"] or not row["good"]:
            return None
        return {f: sorted({float(v) for k in (0, 1) for v in row[f"{f}_{k}"]}) for f in FEATURES}

    @staticmethod
    def _binned(conditions: tuple[Condition, ...], thresholds: dict[str, list[float]]) -> Column:
        """The conditions over the contingency table's bins: bin b holds values from thresholds[b-1] up."""
        out = F.lit(True)
        for c in conditions:
            nth = thresholds[c.feature].index(c.threshold)
            out = out & (F.col(c.feature) > nth if c.above else F.col(c.feature) <= nth)
        return out

    def _grow(self, rows: DataFrame, thresholds: dict[str, list[float]]) -> tuple[Condition, ...]:
        chosen: tuple[Condition, ...] = ()
        for _ in range(self.max_conditions):
            counts = self._histograms(rows.where(self._binned(chosen, thresholds)))
            bad, good = (sum(n for (f, _), n in counts[k].items() if f == next(iter(FEATURES))) for k in (True, False))
            if not bad or not good:
                break
            best, best_gain = None, 1e-9
            for feature, cuts in thresholds.items():
                for nth, threshold in enumerate(cuts):
                    above = [sum(n for (f, b), n in counts[k].items() if f == feature and b > nth) for k in (True, False)]
                    for up, (p, n) in ((True, above), (False, [bad - above[0], good - above[1]])):
                        if p >= self.min_cover:
                            gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                            # Of equal gains the later, that is the higher, "at least" and the first, that
                            # is the lower, "below": rules reach no further than what they have seen.
                            if gain > best_gain or up and best and gain == best_gain and best.feature == feature:
                                best, best_gain = Condition(feature, up, threshold), gain
            if best is None:
                break
            chosen += (best,)
        return chosen

    @staticmethod
    def _histograms(rows: DataFrame) -> dict[bool, dict[tuple[str, int], int]]:
        """Rows by class, feature and bin: at most 2 x features x (thresholds + 1) counts."""
        pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES))
        found = rows.select("bad", "n", F.inline(pairs)).groupBy("bad", "feature", "bin").agg(F.sum("n").alias("n"))
        out: dict[bool, dict[tuple[str, int], int]] = {True: {}, False: {}}
        for r in found.collect():
            out[r["bad"]][r["feature"], r["bin"]] = r["n"]
        return out

    def _pruned(self, rows: DataFrame, grown: tuple[Condition, ...], thresholds: dict[str, list[float]]) -> Rule | None:
        if not grown:
            return None
        asked = []
        for k in range(1, len(grown) + 1):
            hit = self._binned(grown[:k], thresholds)
            for bad in (True, False):
                asked.append(F.sum(F.when(hit & (F.col("bad") == bad), F.col("n")).otherwise(0)).alias(f"{k}_{bad}"))
        row = rows.agg(*asked).first()
        kept = []
        for k in range(1, len(grown) + 1):
            p, n = row[f"{k}_True"] or 0, row[f"{k}_False"] or 0
            precision = (p + 1) / (p + n + 2)
            if p >= self.min_cover and p / (p + n) >= self.min_precision:
                kept.append(((p - n) / (p + n), -k, Rule(grown[:k], precision)))
        return max(kept, key=lambda x: x[:2])[2] if kept else None


def verdict(s: Column, rules: list[Rule]) -> Column:
    """The number of the first rule that rejects, from 1; 0 if none does."""
    out = None
    for nth, rule in enumerate(rules, 1):
        hit = F.lit(True)
        for c in rule.conditions:
            hit = hit & c.holds(s)
        out = F.when(hit, F.lit(nth)) if out is None else out.when(hit, F.lit(nth))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def _measured(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    return materialise(
        docs.select(F.col(id_col).alias("doc_id"), statistics(F.col(text)).alias("s")), "statistics"
    )


def _labelled(measured: DataFrame, labels: DataFrame, label: str, id_col: str) -> DataFrame:
    """Labelled rows that pass the base rules; an id with several labels is bad if half of them or more say so."""
    bad = labels.where(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("of")).agg(F.avg(label).alias("mean"))
    passed = measured.where(~base_failed(F.col("s")))
    return passed.join(bad, F.col("doc_id") == F.col("of")).select(
        "doc_id", "s", (F.col("mean") <= 0.5).alias("bad")
    )


def learn_rules(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    label: str = "quality",
    learner: Learner | None = None,
) -> list[Rule]:
    """The decision list that labelled documents teach (``label`` 0: low quality).

    Only texts whose id passes a Bloom filter of the labelled ids are measured,
    where they are; the join with the labels sees their statistics alone. Null
    texts count as empty; null ids, and ids or labels without the other, teach
    nothing; repeated rows count as often as they are there; without labels of
    both classes there is no rule.
    """
    (hit,) = fresh(docs, "hit")
    known = BlockedBloom(labels.where(F.col(label).isNotNull()).select(id_col).distinct())
    measured = _measured(known.mark(docs, F.col(id_col), hit).where(hit), text, id_col)
    return (learner or Learner()).fit(materialise(_labelled(measured, labels, label, id_col), "labelled"))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    label: str = "quality",
    learner: Learner | None = None,
) -> DataFrame:
    """Statistics and verdict for each row of ``docs``.

    Returns ``doc_id``, the statistics, ``base_failed``, ``kept`` and ``rule``
    (the learned rule that rejects it, else 0). Null and empty texts have no
    words and fail the base rule; null ids have no label; repeated rows each get
    a row. Without labels of both classes no rule is learned and the base rules
    alone decide. Other columns of ``docs`` are not read.
    """
    measured = _measured(docs, text, id_col)
    rules = (learner or Learner()).fit(materialise(_labelled(measured, labels, label, id_col), "labelled"))
    s = F.col("s")
    return measured.select(
        "doc_id",
        "s.*",
        base_failed(s).alias("base_failed"),
        (~base_failed(s) & (verdict(s, rules) == 0)).alias("kept"),
        verdict(s, rules).alias("rule"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    label: str = "quality",
    learner: Learner | None = None,
) -> DataFrame:
    """``docs`` without the rows that the base rules or the learned list reject.

    The verdict is taken row by row where the text is, so no text is shuffled.
    Null, empty and blank texts have no words and go; null and repeated ids are
    judged by their texts like any other; all columns stay, whatever their names.
    Without labels of both classes the base rules alone decide.
    """
    rules = learn_rules(docs, labels, text, id_col, label, learner)
    kept = let(statistics(F.col(text)), lambda s: ~base_failed(s) & (verdict(s, rules) == 0))
    return docs.where(kept)
