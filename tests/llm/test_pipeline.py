"""The pipeline's stages, each against brute force on what the one before kept."""

import inspect

import corpus_pipeline
from talus.llm import quality
from talus.llm.common import read

from ..conftest import DATA
from .rows import awkward
from .test_exact_dedup import normal
from .test_mixing import check
from .test_packing import check_pieces
from .test_quality import brute
from .test_simhash import similar

SF = str(DATA / "sf0.001")


def test_stages(spark):
    docs = read(spark, SF, "documents")
    columns = docs.columns
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = list(text)
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        done[name] = out
        if name == "quality_rules":
            rules = quality.learn_rules(docs, read(spark, SF, "labels"))
            judged = {r["doc_id"]: r["kept"] for r in quality.judge(docs, read(spark, SF, "labels")).collect()}
            assert rules is not None
            want = [i for i in left if judged[i]]
            assert all((brute(text[i])[0] >= 20 and 100 * brute(text[i])[4] <= 30 * brute(text[i])[0]) for i in want)
        elif name == "exact_dedup":
            best = {}
            for i in left:
                best[normal(text[i])] = max(i, best.get(normal(text[i]), i))
            want = sorted(best.values())
        elif name == "simhash_dedup":
            want = sorted(i for i, keep in similar((i, text[i]) for i in left).items() if i == keep)
        elif name == "mix_sources":
            times = {}
            for r in out.collect():
                times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
            assert max(times.values()) <= 3 and set(times) <= set(left)
            from talus.llm import mixing

            rows = mixing.mix(docs).collect()
            check(docs, rows, 0.1)
            want = sorted(r["doc_id"] for r in rows for _ in range(r["copies"]))
        else:
            rows = out.collect()
            pieces = [(r["doc_id"], r["sequence_id"], r["offset"], r["length"]) for r in rows]
            by_seq = {}
            for _, s, o, n in pieces:
                by_seq.setdefault(s, []).append((o, n))
            assert all(sum(n for _, n in v) <= 2048 for v in by_seq.values())
            assert {p[0] for p in pieces} == set(left)
            break
        assert out.columns == columns
        left = sorted(r["doc_id"] for r in out.collect())
        assert left == sorted(want)
        docs = out
    assert list(done) == ["quality_rules", "exact_dedup", "simhash_dedup", "mix_sources", "packing"]
    assert check_pieces([], {}, 2048) == []


def test_run_ends_in_the_packed_rows(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "sequence_id", "ids_crc32"} <= set(rows[0].asDict())


def test_stages_on_awkward_rows(spark):
    for empty in (False, True):
        docs = awkward(spark, empty=empty)
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).count()


def test_the_pipeline_swallows_no_import_errors():
    assert "except" not in inspect.getsource(corpus_pipeline)
