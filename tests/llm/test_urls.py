import re
from urllib.parse import unquote_to_bytes

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talus.llm import bloom, urls
from talus.llm.common import LOWER, UPPER

from ..conftest import DATA


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(str.maketrans(UPPER, LOWER)), re.match(r"[^?#]*", rest[len(host) :])[0]


def brute_rule(host, path, rules):
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: f[:2])[2:] if fits else (None, None)


def brute_canonical(host, path):
    def unescaped(part):
        if re.search("%(?![0-9A-Fa-f]{2})", part):
            return part
        return unquote_to_bytes(part).decode("utf-8", "replace")

    host = re.sub(r":[0-9]*\Z", "", host.rpartition("@")[2])
    kept = unescaped(path).split("/")
    tail = kept[-1] if kept[-1] != "." else ""
    path = "/".join(["", *(s for s in kept[:-1] if s not in ("", ".")), tail])
    return unescaped(host).translate(str.maketrans(UPPER, LOWER)).rstrip("."), path


LISTED = tuple((f"{a}-{b}.{c}", "/", "block") for a in urls.FIRST_WORDS for b in urls.SECOND_WORDS for c in urls.DOMAINS)


def expected(rows, rules, listed):
    out = []
    for i, url in rows:
        host, path = brute_parts(url)
        has = url is not None and "://" in url
        rule, action = brute_rule(host, path, rules) if has else (None, None)
        _, listing = brute_rule(*brute_canonical(host, path), listed) if has else (None, None)
        out.append((i, host, path, rule, action or listing or "allow"))
    return sorted(out, key=repr)


def found(spark, rows, rules, listed):
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("key", F.lit("x"))
    out = urls.judge(pages, urls.entries(spark, rules, "rules"), urls.entries(spark, listed, "listed"))
    return sorted((tuple(r)[:5] for r in out.collect()), key=repr)


EDGES = [
    None, "", "no scheme/here", "://", "http://", "HTTP://EXAMPLE.ORG", "http://Example.ORG/EN/1", "http://a.example.org/en/1?x#y",
    "http://badexample.org/en/1", "http://example.org?x=/en/1", "http://example.org#/en/1", "http://x.com/fr/", "http://x.com/de/1",
    "ftp://a://b/c", "http://org/", "http://.org/", "http://a..org/x", "http://spam-farm.example.com/x", "http://spam-farm.example.org/x",
    "http://u@www.cheap-pills.example.net:80/", "http://cheap-pills.example.net/a b\nc?d", "http://É.com/fr/é", "http://x.com/FR/",
    "http://m.casino-win.example.com/de/2", "http://Free-Bets.Example.COM", "http://ads-track.example.com?x", "https://adult-x.example.net:8080/a",
    "http://a:b@c@spam-farm.example.com./q", "http://spam%2Dfarm.example.com/%zz", "http://notspam-farm.example.com/", "http://spam-farm.example.com.evil.net/",
]


def test_edges(spark):
    rows = [*enumerate(EDGES), (1, EDGES[8]), (None, EDGES[6]), (None, None)]
    assert found(spark, rows, urls.RULES, LISTED) == expected(rows, urls.RULES, LISTED)
    assert found(spark, [], urls.RULES, LISTED) == []
    assert found(spark, rows, [], []) == expected(rows, [], [])


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(str(DATA / "sf0.01" / "pages.parquet")).select("page_id", "url").collect()]
    assert found(spark, rows, urls.RULES, LISTED) == expected(rows, urls.RULES, LISTED)


label = st.sampled_from(["a", "b", "org", "com"])
host = st.lists(label, min_size=1, max_size=3).map(".".join)
path = st.sampled_from(["", "/", "/x", "/x/", "/xy", "/x/y"])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(host, path, st.sampled_from(["allow", "block"])), max_size=8, unique_by=lambda r: r[:2]),
    st.lists(st.tuples(host, path), min_size=1, max_size=20),
)
def test_any_rules(spark, rules, pages):
    rows = [(i, f"http://{h}{p}") for i, (h, p) in enumerate(pages)]
    assert found(spark, rows, rules, rules[:2]) == expected(rows, rules, rules[:2])


def test_a_full_filter_still_gives_exact_results(spark, monkeypatch):
    """One block for hundreds of entries lets nearly all through; the join removes them."""
    monkeypatch.setattr(bloom, "MAX_BLOCKS", 1)
    listed = [(f"h{i}.net", "/", "block") for i in range(600)]
    rows = [(i, f"http://h{i}.net/") for i in range(0, 1200, 7)]
    assert found(spark, rows, [], listed) == expected(rows, [], listed)


def test_the_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS key")
    made = urls.BlockedBloom(keys)
    assert made.blocks == 128
    assert made.mark(keys, F.col("key"), "hit").where("NOT hit").count() == 0
    others = spark.range(20_000).selectExpr("concat('other', id) AS key")
    assert made.mark(others, F.col("key"), "hit").where("hit").count() < 1000


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_rows_without_listed_ids(spark, monkeypatch, broadcast):
    """Exact under a filter that lets most through, with null and repeated ids and clashing names."""
    monkeypatch.setattr(bloom, "MAX_BLOCKS", 1)
    monkeypatch.setattr(bloom, "MAX_BROADCAST", broadcast)
    rows = [(i if i % 50 else None, f"t{i}", i, "x") for i in range(600)] + [(7, "again", 1, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _hit int, _of string")
    for gone in ([7, 8, 9, *range(100, 400), 5000], [None, 3], []):
        out = bloom.without(df, "doc_id", spark.createDataFrame([(g,) for g in gone], "x long"))
        assert out.columns == df.columns
        assert sorted(r["text"] for r in out.collect()) == sorted(t for i, t, _, _ in rows if i not in gone)


def test_keeping_allowed_pages(spark):
    rows = [*enumerate(EDGES), (1, EDGES[6])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("_of", F.lit(1))
    left = urls.keep_allowed(pages, urls.entries(spark, urls.RULES, ""), urls.entries(spark, LISTED, ""))
    blocked = {r[0] for r in expected(list(enumerate(EDGES)), urls.RULES, LISTED) if r[4] == "block"}
    assert left.columns == pages.columns
    assert sorted(r["url"] or "" for r in left.collect()) == sorted(
        u or "" for i, u in [*enumerate(EDGES), (6, EDGES[6])] if i not in blocked
    )


@pytest.mark.parametrize("url", EDGES)
def test_parts(spark, url):
    row = spark.createDataFrame([(url,)], "u string").select(urls.host(F.col("u")), urls.path(F.col("u"))).first()
    assert tuple(row) == brute_parts(url)


@pytest.mark.parametrize("url", [*(u for u in EDGES if u), "http://x.com//a/./b/.", "http://x.com/%61%2fb+c", "http://x.com/a/..", "http://x.com/./", "http://x.com/.a/"])
def test_canonical_parts(spark, url):
    df = spark.createDataFrame([(url,)], "u string")
    assert tuple(df.select(urls.canonical_host(F.col("u")), urls.canonical_path(F.col("u"))).first()) == brute_canonical(*brute_parts(url))


def test_a_hot_url_moves_no_page(spark):
    """Half of all pages have one url: ids of urls meet, pages stay where they are."""
    rows = [(i, "http://spam-farm.example.com/x" if i % 2 else f"http://a{i}.org/", "html") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    left = urls.keep_allowed(pages, urls.entries(spark, urls.RULES, ""), urls.entries(spark, LISTED, ""))
    plan = left._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert not moved and "SortMergeJoin" not in plan
    assert sorted(r["page_id"] for r in left.collect()) == list(range(0, 400, 2))


def test_pages_listed_by_their_html(spark):
    """Entries with paths, made by a rule over html: other spellings of a listed path are blocked, longer paths aren't."""
    junk = "<p>" + "and### of%%% " * 5 + "</p>"
    spelled = [
        ("http://A.org/x/%61b/./c", junk, "block"), ("http://a.org//x/ab//c", "", "block"), ("https://m.a.org:80/x/ab/c?q#f", "", "block"),
        ("http://a.org/x/ab/c/", "", "allow"), ("http://a.org/x/ab/cd", "", "allow"), ("http://a.org/x/ab/", None, "allow"),
        ("http://b.org/.", junk, "block"), ("http://b.org", "", "block"), ("http://b.org/y", "", "allow"), ("http://c.org/%2e/z", junk[:40], "allow"),
        ("no scheme", junk, "allow"), (None, junk, "allow"), ("http://", junk, "allow"),
        ("http://org/x/ab/c", "", "allow"), ("http://d.com/fr/1", junk, "allow"), ("http://www.d.com/fr/1", "", "allow"),
    ]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(spelled)], "page_id long, url string, html string")
    listed = urls.flagged(pages)
    assert sorted(map(tuple, listed.select("host", F.rtrim("path", F.lit(urls.END))).collect())) == [("a.org", "/x/ab/c"), ("b.org", "/"), ("d.com", "/fr/1")]
    rules = urls.entries(spark, [("com", "/fr/", "allow")], "rules")
    rows = {r["page_id"]: r for r in urls.judge(pages, rules, listed).collect()}
    assert [rows[i]["verdict"] for i in range(len(spelled))] == [v for _, _, v in spelled]
    assert rows[2]["listed"] == "a.org/x/ab/c" and rows[3]["listed"] is None
    plain = {r["page_id"]: r["verdict"] for r in urls.judge(pages, rules, urls.entries(spark, [], "listed")).collect()}
    assert set(plain.values()) == {"allow"}  # only the list decides


def test_the_list_of_the_query_decides_by_paths(spark):
    pages = spark.read.parquet(str(DATA / "sf0.01" / "pages.parquet"))
    rules = urls.entries(spark, urls.RULES, "rules")
    rows = urls.judge(pages, rules, urls.junk_hosts(spark).union(urls.flagged(pages))).where("rule IS NULL").collect()
    by_path = [r for r in rows if r["listed"] and not r["listed"].endswith("/")]
    assert len(by_path) > 5 and {r["verdict"] for r in by_path} == {"block"}
    assert any(r["listed"] is None and r["verdict"] == "allow" for r in rows)
