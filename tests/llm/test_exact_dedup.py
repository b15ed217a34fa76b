import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talus.llm import exact_dedup
from talus.llm.common import LOWER, UPPER, ascii_lower

from ..conftest import DATA
from .rows import awkward


def normal(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def brute(pairs):
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[normal(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i != best)):
            out.append((i, best, len(ids), first, digest))
            first = False
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in exact_dedup.exact_groups(df).collect()), key=repr)


def test_awkward_rows(spark):
    df = awkward(spark)
    assert found(df) == brute((r["doc_id"], r["text"]) for r in df.collect())
    assert found(awkward(spark, empty=True)) == []


def test_whole_table(spark):
    df = spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet"))
    assert found(df) == brute((r["doc_id"], r["text"]) for r in df.collect())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbBÄä \n"), max_size=4)), min_size=1, max_size=30))
def test_small_texts(spark, texts):
    rows = list(enumerate(texts))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_chunks_tile_the_text(spark):
    df = awkward(spark).where("text is not null")
    cut = exact_dedup.chunks(F.col("text"))
    sizes = F.transform(cut, F.char_length)
    row = df.select(F.array_join(cut, "") == F.col("text"), F.coalesce(F.array_max(sizes), F.lit(0))).collect()
    assert all(same and most <= exact_dedup.MAX_CHARS for same, most in row)


def test_a_change_leaves_later_chunks_alone(spark):
    text = " ".join(f"word{i * i % 7919}" for i in range(3000))
    df = spark.createDataFrame([(text,), ("other start " + text,)], "text string").select(exact_dedup.chunks(F.col("text")))
    a, b = (set(r[0]) for r in df.collect())
    assert len(a & b) > 0.8 * len(a)


def test_chunks_that_share_a_hash_stay_apart(spark):
    chunk = "struct<h:bigint,digest:binary,size:int>"
    one, two = (7, b"one", 3), (7, b"two", 3)
    rows = [(1, 10, "x", [one]), (2, 11, "y", [two]), (3, 12, "x", [one]), (4, 13, "z", [one, two]), (5, 14, "w", [two, one]), (6, 15, "v", [])]
    recipes = spark.createDataFrame(rows, f"row long, doc_id long, sha256 string, recipe array<{chunk}>")
    keys = {r["row"]: repr((r["ids"], r["apart"])) for r in exact_dedup._identified(recipes).collect()}
    assert keys[1] == keys[3] and len(set(keys.values())) == 5


def test_dropping_copies(spark):
    df = awkward(spark)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], normal(r["text"])) for r in kept.collect()), key=repr)
    want = sorted({(i, s) for i, best, n, stays, _ in brute((r["doc_id"], r["text"]) for r in df.collect()) if stays for s in [_]}, key=repr)
    assert [(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in got] == want or sorted(
        (repr(i), hashlib.sha256(t.encode()).hexdigest()) for i, t in got
    ) == sorted((repr(i), s) for i, s in want)
    assert exact_dedup.drop_copies(awkward(spark, empty=True)).count() == 0


def test_lower_casing_touches_ascii_only(spark):
    df = spark.createDataFrame([("ÀÉ A Z İ",), ("PLAIN",)], "t string").select(ascii_lower(F.col("t")))
    assert [r[0] for r in df.collect()] == ["ÀÉ a z İ", "plain"]


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz ", "абвгдежзийклмнопрстуфхцчшщъыьэюя ", "αβγδεζηθικλμνξοπρστυφχψω ", "אבגדהוזחטיכלמנסעפצקרשת ", "".join(map(chr, range(0x4E00, 0x9F00, 7)))])
def test_edges_follow_the_content_in_any_script(spark, letters):
    """A character put in at the start changes the first chunk only."""
    rng = random.Random(1)
    text = "".join(rng.choice(letters) for _ in range(60_000))
    rows = spark.createDataFrame([(text,), ("x" + text,)], "t string").select(exact_dedup.chunks(F.col("t")).alias("c")).collect()
    one, other = (r["c"] for r in rows)
    assert "".join(one) == text and "".join(other) == "x" + text
    assert len(one) > 20 and len(set(one) & set(other)) >= len(one) - 3
