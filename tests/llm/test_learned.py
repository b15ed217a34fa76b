"""Language identification and toxicity: held-out accuracy, the parts they are made of, and awkward rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talus.llm import langid, toxicity
from talus.llm.common import fold

from ..conftest import DATA
from .rows import awkward


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(str(DATA / "sf0.1" / "documents.parquet"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(str(DATA / "sf0.1" / "labels.parquet"))


def test_fold_is_crc32_of_the_id_text(spark):
    rows = spark.range(50).select("id", fold(F.col("id")).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 4 for r in rows)


def test_languages_of_held_out_documents(docs):
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    df = awkward(spark)
    rows = langid.identify(df).collect()
    assert len(rows) == df.count()
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    for r in rows:
        if r["doc_id"] is not None and not any(c.isalpha() for c in texts[r["doc_id"]] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert langid.identify(awkward(spark, empty=True)).count() == 0
    nothing = langid.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


@pytest.mark.parametrize("text", [None, "", " \t", "½ ²", "①②", "Ⅷ ⅻ", "12 345", "_ _", "\u0301", "٣ ৪", "!? 😀"])
def test_without_a_letter_no_language_is_determined(text):
    filters = langid.LanguageFilters(["a", "b"])
    filters.add(0, grams("½ ² ①② Ⅷ"))
    assert filters.seal().decide(text) == ("und", 0.0)


def test_marks_belong_to_words_and_numbers_do_not():
    assert langid._plain("हिन्दी में 12") == " हिन्दी में "
    assert langid._plain("x²y Ⅷz_q") == " x y z q "


def brute_languages(rows):
    """Sets of n-grams as text: those of two documents or more, as frequent as in any language but for a quarter."""
    of_docs, total, many = {}, {}, {}
    for lang, text in rows:
        plain = langid._plain(text)
        every = [plain[i : i + n] for n in langid.GRAMS for i in range(len(plain) - n + 1)]
        of_docs.setdefault(lang, Counter()).update(set(every))
        total.setdefault(lang, Counter()).update(every)
        many[lang] = many.get(lang, 0) + 1
    size = {lang: sum(c.values()) for lang, c in total.items()}
    order = sorted(many, key=lambda x: (-many[x], x))

    def kept(lang, gram):
        share = total[lang][gram] / size[lang]
        return of_docs[lang][gram] >= langid.LEAST_DOCS and share >= langid.LEAST_SHARE * max(total[x][gram] / size[x] for x in order)

    sets = {lang: {g for g in total[lang] if kept(lang, g)} for lang in order}

    def decide(text):
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        plain = langid._plain(text)
        every = [plain[i : i + n] for n in langid.GRAMS for i in range(len(plain) - n + 1)]
        counts = [sum(g in sets[lang] for g in every) for lang in order]
        best = max(range(len(order)), key=lambda i: (counts[i], -i))
        return order[best], counts[best] / sum(counts) if counts[best] else 0.0

    return decide


def test_decisions_against_plain_sets(spark):
    """The filters decide as sets of n-grams do, and their corrected scores are near."""
    df = spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet"))
    rows = df.collect()
    train = [(r["lang"], r["text"]) for r in rows if r["lang"] and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    decide = brute_languages(train)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(df).collect()}
    for r in rows:
        lang, share = decide(r["text"])
        assert got[r["doc_id"]] == (lang, pytest.approx(share, abs=0.05))


def test_a_sample_is_bounded_by_rows_not_ids(spark):
    rows = [(1, "same words", "en")] * 50 + [(1, f"other words {i}", "de") for i in range(50)] + [(None, "no id", "fr")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for size in (1, 30, 70, 149, 500):
        picked = langid._sample(df, "text", "lang", "doc_id", F.lit(True), size)
        assert picked.count() == min(size, 150)


def test_tables_grow_with_their_grams_up_to_a_bound():
    assert langid.slots_for(0) == langid.MIN_SLOTS and langid.slots_for(10**9) == langid.MAX_SLOTS
    assert 16 * 10**5 <= langid.slots_for(10**5) < 32 * 10**5


def grams(text):
    return np.concatenate(list(langid.grams(langid._plain(text))))


@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_grams_do_not_depend_on_blocks(text):
    plain = langid._plain(text)
    whole = np.sort(np.concatenate(list(langid.grams(plain))))
    saved, langid.BLOCK = langid.BLOCK, 7
    try:
        parts = np.sort(np.concatenate(list(langid.grams(plain))))
    finally:
        langid.BLOCK = saved
    assert np.array_equal(whole, parts)
    assert len(whole) == sum(max(0, len(plain) - n + 1) for n in langid.GRAMS)


def test_filters_hold_many_languages_and_correct_false_positives():
    names = [f"l{i}" for i in range(70)]
    filters = langid.LanguageFilters(names, slots=1 << 12)
    for i, name in enumerate(names):
        filters.add(i, grams(f"{name * 3} own{i} words{i}"))
    filters.seal()
    for i, name in enumerate(names):
        found = filters.languages_of(grams(f"own{i}"))
        assert all(found[i // 64] & np.uint64(1 << i % 64))  # no false negatives
    full = langid.LanguageFilters(["noise", "true"], slots=1 << 10)
    full.add(0, np.random.default_rng(1).integers(0, 2**63, 900).astype(np.uint64))  # most slots set
    full.add(1, grams("the quick brown fox"))
    assert full.seal().false_rate[0] > 0.3 > full.false_rate[1]
    assert full.decide("the quick brown fox")[0] == "true"
    assert full.decide("1 2 3 !") == ("und", 0.0) and full.decide(None) == ("und", 0.0)


def test_toxicity_of_held_out_documents(docs, labels):
    rows = toxicity.rate(docs, labels).join(labels, "doc_id").where("held_out").collect()
    score, y = np.array([r["score"] for r in rows]), np.array([r["toxic"] for r in rows])
    auc = np.mean(score[y == 1][:, None] > score[y == 0][None, :])
    hit = score >= toxicity.THRESHOLD
    assert auc > 0.93 and hit[y == 1].mean() > 0.85 and hit[y == 0].mean() < 0.03
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows) and score.min() >= 0 and score.max() <= 1


def test_the_lexicon_does_not_depend_on_partitions(spark):
    """Five toxic documents and four clean ones have "maybe": too many clean ones, wherever they are."""
    rows = [("surely maybe", 1)] * 5 + [("maybe fine", 0)] * 4 + [("fine", 0)] * 11
    df = spark.createDataFrame(rows, "text string, y int")
    for parts in (1, 4, 20):
        assert toxicity._lexicon(df.repartition(parts)) == {"surely", "=sure", "=surel", "=surely"}


def test_a_toxic_sample_is_bounded_by_rows(spark, monkeypatch):
    """One id with thousands of rows takes its place in the sample, not the driver's memory."""
    rows = [(1, f"you idiot {i}") for i in range(2000)] + [(i, f"fine words {i}") for i in range(2, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 40)], "doc_id long, toxic int")
    seen = []
    real = toxicity._features
    monkeypatch.setattr(toxicity, "_features", lambda rows, lexicon: seen.append(rows.count()) or real(rows, lexicon))
    toxicity.fit(df, labels, sample=10)
    assert seen[0] <= 10


def test_the_lexicon_does_not_depend_on_how_much_a_task_counts(spark, monkeypatch):
    df = spark.createDataFrame([("surely maybe", 1)] * 5 + [("maybe fine", 0)] * 4, "text string, y int")
    monkeypatch.setattr(toxicity, "COUNTED", 1)
    assert toxicity._lexicon(df.repartition(2)) == {"surely", "=sure", "=surel", "=surely"}


def brute_features(text, lexicon):
    """Word by word, without tables or arrays."""
    text = text or ""
    found = re.findall(r"[^\W_]+(?:[@$!|*_.\-][^\W_]+)*", text)
    n, letters = max(1, len(found)), max(1, len(text))
    signs = dict(zip("013457@$!|", "oieastasil"))

    def look_up(word):
        return word in lexicon, any("=" + word[:k] in lexicon for k in toxicity.STEMS if len(word) >= k)

    whole, stems, you, odd, long_, masked = [], [], [], [], [], []
    for i, word in enumerate(found):
        low = plain = word.lower()
        if low in toxicity.SECOND_PERSON:
            you.append(i)
        if any(c.isdecimal() or c in "@$!|*_.-" for c in low) and any(c.isalpha() for c in low):
            odd.append(i)
            plain = "".join(signs.get(c, c) for c in low if c not in "*_.-")
        hit, used = look_up(plain), plain
        if re.search(r"([^\W\d_])\1\1", low):
            long_.append(i)
            if not any(hit):
                used = re.sub(r"([^\W\d_])\1{2,}", r"\1", plain)
                hit = look_up(used)
        whole += [i] * hit[0]
        stems += [i] * hit[1]
        if any(hit) and plain != low:
            masked.append(i)
    hits = sorted({*whole, *stems})
    near = sum(any(abs(i - j) <= toxicity.NEAR for j in you) for i in hits)
    bangs = sum(c in "!?" for c in text)
    return [
        len(whole) / n, len(stems) / n, min(50.0, len(whole)), min(50.0, len(stems)), near / n, len(you) / n,
        sum("A" <= c <= "Z" for c in text) / letters, sum(w.isupper() for w in found) / n, bangs / n,
        (bangs + sum(c in ".,;:\"'*#$%&" for c in text)) / n, len(odd) / n, len(long_) / n, min(50.0, len(masked)),
    ]


def brute_score(model, x):
    """Each tree walked from its root, then the calibration's line between two knots."""
    trees = model.trees
    margin = trees.bias
    for feature, cut, value in trees.forest:
        node = 0
        while node < len(feature):
            f = feature[node]
            node = 2 * node + 1 + (sum(e <= x[f] for e in trees.edges[f]) > cut[node])
        margin += value[node]
    at, y = model.knots
    if margin <= at[0] or margin >= at[-1]:
        level = y[0] if margin <= at[0] else y[-1]
    else:
        k = max(i for i in range(len(at)) if at[i] <= margin)
        level = y[k] + (y[k + 1] - y[k]) * (margin - at[k]) / (at[k + 1] - at[k])
    return level


def test_features_and_scores_against_brute_force(spark, docs, labels):
    small = spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet"))
    model = toxicity.fit(docs, labels, train=fold(F.col("doc_id")) != 2)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(small, model).collect()}
    extra = ["You 1D1OT!!", "dir dir dummmm", "a.b-c you", "x@y ... $$ 9.9 IDIOT_idiot", "٣ you", "", None]
    of = toxicity.Featurizer(model.lexicon)
    for text in [*extra, *sorted(model.lexicon)[:300:7]]:
        assert of(text) == pytest.approx(brute_features(text, model.lexicon))
    for r in small.collect():
        x = brute_features(r["text"], model.lexicon)
        assert of(r["text"]) == pytest.approx(x)
        assert got[r["doc_id"]] == pytest.approx(brute_score(model, x), abs=1e-9)


def test_toxicity_of_awkward_rows(spark):
    clashing = {"part": F.lit(1), "y": F.lit("y"), "h": F.lit(2), "u": F.lit(3), "toxic": F.lit("no"), "_id": F.lit(4), "_text": F.lit(5)}
    df = awkward(spark).withColumns(clashing)
    schema = "doc_id long, toxic int, text string"
    for rows in ([], [(3, 0, ""), (7, 0, "")], [(3, 1, ""), (7, 0, ""), (5, 1, ""), (8, 0, ""), (11, 1, ""), (None, 1, ""), (3, 0, "")]):
        out = toxicity.rate(df, spark.createDataFrame(rows, schema)).collect()
        assert len(out) == df.count() and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.rate(awkward(spark, empty=True), spark.createDataFrame([], schema)).count() == 0


def test_hidden_words_are_seen():
    of = toxicity.Featurizer({"idiot", "=lowe"})
    at = toxicity.FEATURES.index
    for text in ("what an 1d10t", "what an i.d.i.o.t", "what an IDIOT", "what an idiooot", "das loweiung"):
        row = of(text)
        assert row[at("words_hit")] + row[at("stems_hit")] >= 1, text
    near, far = of("you idiot"), of("you " + "word " * 9 + "idiot")
    assert near[at("near_you")] > 0 == far[at("near_you")]
    assert of(None) == of("") and not any(of(""))


@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(0, 1)), min_size=1, max_size=40))
def test_isotonic_fit(points):
    x, y = (np.array(v, float) for v in zip(*points))
    knots, values = toxicity.isotonic(x, y)
    assert np.all(np.diff(values) >= -1e-12) and np.all(np.diff(knots) > 0)
    fitted = np.interp(x, knots, values)
    assert fitted.mean() == pytest.approx(y.mean())
    # The best monotone fit by brute force: max over lower sets of min over upper sets of the mean.
    for xi, fi in zip(x, fitted):
        best = max(
            min(y[(x >= a) & (x <= b)].mean() for b in np.unique(x[x >= xi])) for a in np.unique(x[x <= xi])
        )
        assert fi == pytest.approx(best)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] > 0.3)).astype(float)
    margin = toxicity.Boosted().fit(x[:2000], y[:2000]).margin(x[2000:])
    assert np.mean((margin > 0) == y[2000:]) > 0.98
