import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talus.llm import quality

from ..conftest import DATA
from .rows import awkward

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, windows, covered = WORD.findall(text), defaultdict(list), set()
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    for starts in windows.values():
        if len(starts) > 1:
            covered.update(p for i in starts for p in range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    rows = df.select("i", quality.statistics(F.col("t")).alias("s")).orderBy("i").collect()
    return [tuple(r["s"][c] for c in COLUMNS) for r in rows]


word = st.sampled_from(["a", "b", "Ab!", "|", "é\U0001f600", "\x1c"])
text = st.lists(st.tuples(word, st.sampled_from([" ", "\n", "\t ", "\x0b"])), max_size=60).map(lambda ps: "".join(a + b for a, b in ps))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(text, min_size=1, max_size=20))
def test_statistics(spark, texts):
    assert statistics(spark, texts) == list(map(brute, texts))


def test_statistics_of_awkward_rows(spark):
    texts = [r["text"] for r in awkward(spark).collect()]
    assert statistics(spark, texts) == list(map(brute, texts))


def test_judged_table(spark):
    """The contract's columns on the whole table; rules find low quality and leave the rest alone."""
    docs, labels = (spark.read.parquet(str(DATA / "sf0.1" / f"{t}.parquet")) for t in ("documents", "labels"))
    docs = docs.where("doc_id < 4000")
    rows = quality.judge(docs, labels).collect()
    text_of = {r["doc_id"]: r["text"] for r in docs.collect()}
    label = {r["doc_id"]: r["quality"] for r in labels.collect()}
    kept = defaultdict(list)
    for r in rows:
        found = brute(text_of[r["doc_id"]])
        assert tuple(r[c] for c in COLUMNS) == found
        assert r["base_failed"] == (found[0] < 20 or 100 * found[4] > 30 * found[0])
        assert not (r["base_failed"] and r["kept"]) and r["kept"] == (not r["base_failed"] and r["rule"] == 0)
        if not r["base_failed"] and r["doc_id"] in label:
            kept[label[r["doc_id"]]].append(r["kept"])
    assert len(rows) == len(text_of)
    assert sum(kept[1]) > 0.99 * len(kept[1]) and sum(kept[0]) < 0.2 * len(kept[0])


def brute_values(text):
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = brute(text)
    text = text or ""
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]

    def share(over, under):
        return over / under if under else 0.0

    return {
        "mean_word_chars": share(word_chars, n_words),
        "symbols_per_word": share(n_symbols, n_words),
        "dup_line_share": share(n_dup_lines, len(lines)),
        "repeat_word_share": share(n_repeat_words, n_words),
        "upper_share": share(sum("A" <= c <= "Z" for c in text), word_chars),
        "digit_share": share(sum("0" <= c <= "9" for c in text), word_chars),
        "bangs_per_word": share(text.count("!"), n_words),
    }


def brute_rule(values, rules):
    """The number of the first rule whose conditions all hold."""
    for nth, rule in enumerate(rules, 1):
        if all((values[c.feature] >= c.threshold) == c.above for c in rule.conditions):
            return nth
    return 0


def test_verdicts_against_brute_force(spark):
    """The learned list and one with conjunctions, evaluated text by text."""
    docs, labels = (spark.read.parquet(str(DATA / "sf0.01" / f"{t}.parquet")) for t in ("documents", "labels"))
    rules = quality.learn_rules(docs, labels)
    made = [
        quality.Rule((quality.Condition("digit_share", True, 0.02), quality.Condition("upper_share", False, 0.05)), 1.0),
        quality.Rule((quality.Condition("bangs_per_word", True, 0.01), quality.Condition("mean_word_chars", True, 4.5), quality.Condition("dup_line_share", False, 0.5)), 1.0),
        quality.Rule((quality.Condition("repeat_word_share", True, 0.001),), 1.0),
    ]
    both = docs.select("doc_id", "text").union(awkward(spark).select("doc_id", "text")).collect()
    df = spark.createDataFrame([(i, r["text"]) for i, r in enumerate(both)], "doc_id long, text string")
    s = quality.statistics(F.col("text"))
    rows = df.select("text", quality.let(s, lambda s: F.struct(quality.verdict(s, rules).alias("a"), quality.verdict(s, made).alias("b"))).alias("v")).collect()
    for r in rows:
        values = brute_values(r["text"])
        assert (r["v"]["a"], r["v"]["b"]) == (brute_rule(values, rules), brute_rule(values, made))
    assert rules and len({r["v"]["b"] for r in rows}) == 4
    learned = {r["doc_id"]: (r["kept"], r["rule"]) for r in quality.judge(docs, labels).collect()}
    for r in docs.collect():
        n, *_, repeated = brute(r["text"])
        rule = brute_rule(brute_values(r["text"]), rules)
        assert learned[r["doc_id"]] == (n >= 20 and 100 * repeated <= 30 * n and rule == 0, rule)


def test_learning_reads_the_same_rows_as_judging(spark):
    """The Bloom filter of labelled ids leaves out no labelled text."""
    docs, labels = (spark.read.parquet(str(DATA / "sf0.1" / f"{t}.parquet")) for t in ("documents", "labels"))
    rules = quality.learn_rules(docs, labels)
    judged = quality.judge(docs, labels)
    kept = {r["doc_id"] for r in quality.keep_good(docs, labels).select("doc_id").collect()}
    assert rules and kept == {r["doc_id"] for r in judged.where("kept").collect()}


def test_no_labels_or_one_class_teach_nothing(spark):
    docs = awkward(spark)
    schema = "doc_id long, quality int, text string"
    for rows in ([], [(3, 1, ""), (7, 1, "")], [(None, 0, ""), (7, None, "")]):
        out = quality.judge(docs, spark.createDataFrame(rows, schema)).collect()
        assert len(out) == docs.count() and all(r["kept"] == (not r["base_failed"]) for r in out)
    assert quality.judge(awkward(spark, empty=True), spark.createDataFrame([], schema)).count() == 0


def test_learned_list_on_a_planted_rule(spark):
    """Two kinds of bad documents need two rules, in order; the emitted expression agrees with the rules."""
    rows = []
    for i in range(600):
        words = [f"w{(i * 7 + k * 13) % 501}" for k in range(40)]
        if i % 5 == 0:
            words = [w + "#" for w in words]
        elif i % 5 == 1:
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words), 0 if i % 5 < 2 else 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    rules = quality.learn_rules(df, df.select("doc_id", "quality"))
    assert {c.feature for r in rules for c in r.conditions} <= set(quality.FEATURES) and len(rules) >= 2
    left = quality.keep_good(df, df.select("doc_id", "quality"))
    assert left.columns == df.columns and [r["doc_id"] for r in left.orderBy("doc_id").collect()] == [i for i in range(600) if i % 5 > 1]
