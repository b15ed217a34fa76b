import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from talus.llm import packing, token_counts
from talus.llm.encode import WordEncoder, word_vocabulary

from ..conftest import DATA
from .rows import TEXTS, awkward


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(word_vocabulary())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


HARD = [
    "a\x0bb\x1cc\x85d e'S don't we'LL <|endoftext|> x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>",
    "J̌ ẖ ́x İstanbul ΣΑΣ ǅ 漢字かな '' 12ab's 'sx \x00 \x7f ﬁ",
    "﻿​  x y × ÷ ª º µ STRASSE straße ÀÉ'S",
]


@pytest.mark.parametrize("text", [*TEXTS, *HARD])
def test_ids_are_the_tokenizers(whole, text):
    assert ids_of(WordEncoder(word_vocabulary()), text) == whole(text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aAbzZ'sSÀéßÿ 09.,!<|>\n\t́İ"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_any_text(text):
    tokenizer = Tokenizer.from_file(word_vocabulary()) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = tokenizer
    test_any_text.e = encoder = getattr(test_any_text, "e", None) or WordEncoder(word_vocabulary())
    assert ids_of(encoder, text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_memory_is_bounded(monkeypatch, whole):
    monkeypatch.setattr("talus.llm.encode.REMEMBERED", 5)
    encoder = WordEncoder(word_vocabulary())
    text = " ".join(f"word{i % 11}x{i}" for i in range(300))
    assert ids_of(encoder, text) == whole(text) and len(encoder._parts) <= 5 and len(encoder._pieces) <= 5


def check_pieces(pieces, docs, length):
    """``pieces``: (document, start, tokens, sequence, offset); ``docs``: tokens of each document."""
    of_doc, of_seq = defaultdict(list), defaultdict(list)
    for doc, start, n, seq, offset in pieces:
        assert n > 0
        of_doc[doc].append((start, n))
        of_seq[seq].append((offset, n))
    for group in (of_doc, of_seq):
        for spans in group.values():
            at = 0
            for start, n in sorted(spans):
                assert start == at
                at += n
    assert {d: sum(n for _, n in s) for d, s in of_doc.items()} == {d: n for d, n in docs.items() if n}
    sizes = [sum(n for _, n in s) for s in of_seq.values()]
    assert all(s <= length and s & (s - 1) == 0 for s in sizes)
    return sizes


@given(st.lists(st.integers(0, 300), max_size=60))
def test_pack(lengths):
    sizes = check_pieces(packing.pack(lengths, 64), dict(enumerate(lengths)), 64)
    assert sum(s < 64 for s in sizes) <= 6


def test_costs_are_balanced():
    rng = random.Random(1)
    # Documents that fill a sequence of their own cost what they cost.
    lengths = [min(1000, max(1, int(rng.lognormvariate(5, 1)))) for _ in range(3000)]
    cost, tokens = defaultdict(float), defaultdict(int)
    for _, _, n, seq, _ in packing.pack(lengths):
        cost[seq] += n + n * n / 2048
        tokens[seq] += n
    naive, at, spent = defaultdict(float), 0, 0
    for n in lengths:  # in order, as they come
        while n:
            part = min(n, 2048 - spent)
            naive[at] += part + part * part / 2048
            n, spent = n - part, spent + part
            if spent == 2048:
                at, spent = at + 1, 0
    assert np.std([c for s, c in cost.items() if tokens[s] == 2048]) < 0.7 * np.std(list(naive.values())[:-1])


@pytest.mark.parametrize("table", ["sf0.001", "awkward"])
def test_packed_tables(spark, whole, table):
    df = awkward(spark) if table == "awkward" else spark.read.parquet(str(DATA / table / "documents.parquet")).repartition(3)
    rows = packing.packed(df, with_ids=True, block_tokens=20_000).collect()
    by_doc = defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        by_doc[r["doc_id"]].append(r)
    want = defaultdict(list)
    for r in df.collect():
        want[r["doc_id"]].append(whole(r["text"]) + [packing.END])
    assert by_doc.keys() == want.keys()
    for doc, texts in want.items():
        if len(texts) == 1:
            assert [i for r in sorted(by_doc[doc], key=lambda r: r["start"]) for i in r["ids"]] == texts[0]
            assert {r["doc_tokens"] for r in by_doc[doc]} == {len(texts[0])}
        else:
            assert sum(r["length"] for r in by_doc[doc]) == sum(map(len, texts))
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in seqs.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 2048 and at & (at - 1) == 0
    assert packing.packed(awkward(spark, empty=True)).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.packed(df, length=1000)


def test_reruns_agree(spark):
    df = spark.read.parquet(str(DATA / "sf0.001" / "documents.parquet"))
    assert packing.packed(df).collect() == packing.packed(df).collect()


@pytest.mark.parametrize("span", [1024, 7])
def test_histogram(spark, whole, monkeypatch, span):
    monkeypatch.setattr(token_counts, "SPAN", span)
    df = awkward(spark)
    hist = token_counts.histogram(df)
    lengths = sorted(len(whole(r["text"])) for r in df.collect())
    total = len(lengths)
    rows = {r["length"]: r for r in hist.collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        longer = [x for x in lengths if x >= n]
        assert (r["docs"], r["tokens"]) == (lengths.count(n), n * lengths.count(n))
        assert (r["docs_from"], r["tokens_from"]) == (len(longer), sum(longer))
        assert r["truncated"] == sum(min(x, n) for x in lengths)
        assert r["share_below"] == pytest.approx(1 - len(longer) / total)
    for limit in (0, 3, 100, 10**9):
        assert token_counts.truncated_total(hist, limit).first()["truncated"] == sum(min(x, limit) for x in lengths)
    for share in (0.1, 0.5, 0.9, 1.0):
        want = next(x for i, x in enumerate(lengths, 1) if i >= share * total - 1e-9)
        assert token_counts.quantile(hist, share).first()["length"] == want
    empty = token_counts.histogram(awkward(spark, empty=True))
    assert empty.count() == 0 and token_counts.truncated_total(empty, 5).first()["truncated"] == 0
    assert token_counts.quantile(empty, 0.5).first()["length"] is None
