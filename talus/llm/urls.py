"""URL filters: a blocked Bloom filter in front of an exact hash join.

Listed canonical URLs (host and path prefix, with an action) are hashed into a
blocked Bloom filter: each entry sets a few bits of one 512-bit block. A URL's
candidates are its host and parent domains with every prefix of its path that
is as long as some listed path; those that the filter lets through go to an
exact hash join with the list, which removes the false positives. The longest
entry that fits decides. Rules are held against a URL's host and path as they
stand, the list against its canonical form, where an entry may name one path
alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bloom import BlockedBloom, without
from .common import ascii_lower, let, materialise, spread

#: Rules that the query is given, as (host, path, action).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: The list beside them, by rule: each first word, a hyphen and a second word under each domain, with all its paths.
FIRST_WORDS = (
    "adult", "ads", "bet", "casino", "cash", "cheap", "click", "crypto", "dating", "easy", "fake", "fast", "free",
    "hot", "loan", "lotto", "lucky", "poker", "porn", "quick", "slots", "spam", "viagra", "xxx",
)
SECOND_WORDS = (
    "bets", "bonus", "cams", "cash", "clicks", "coins", "deals", "farm", "games", "girls", "jackpot", "loans",
    "money", "pills", "poker", "prizes", "profit", "replica", "slots", "traffic", "track", "tube", "win", "x",
)
DOMAINS = ("example.com", "example.net", "example.org")
#: What ends a listed path that fits no longer one; canonical paths are looked up with it.
END = "\uffff"
#: Runs of signs in a page's html, and how many of them put its URL on the list.
SIGNS, LEAST_SIGNS = "[#*$%]{3}", 10


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """After the host up to ``? #``; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _unescaped(part: Column) -> Column:
    """Percent escapes resolved, once; a part with broken ones stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))), part)


def canonical_host(url: Column) -> Column:
    """The host without user part, port, trailing dots and percent escapes, A-Z lower-cased."""
    bare = F.regexp_replace(F.regexp_replace(host(url), r"(?s)^.*@", ""), r":[0-9]*\z", "")
    return F.regexp_replace(ascii_lower(_unescaped(bare)), r"\.+\z", "")


def canonical_path(url: Column) -> Column:
    """The path without percent escapes, empty and ``.`` segments; ``/`` for an empty one."""
    whole = F.regexp_replace(F.concat(F.lit("/"), _unescaped(path(url))), r"(?:/\.?)+(?=/)", "")
    return F.regexp_replace(whole, r"/\.\z", "/")


def entries(spark: SparkSession, rows: Iterable[tuple[str, str, str]], listing: str) -> DataFrame:
    """A short list of ``(host, path, action)`` as the table that the filter takes."""
    names = ("host", "path", "action", "listing")
    made = [F.struct(*(F.lit(v).alias(n) for v, n in zip((h.lower(), p, a, listing), names))) for h, p, a in rows]
    kind = f"array<struct<{','.join(f'{n}:string' for n in names)}>>"
    return spark.range(1).select(F.inline(F.array(*made).cast(kind)))


def junk_hosts(
    spark: SparkSession,
    first: Iterable[str] = FIRST_WORDS,
    second: Iterable[str] = SECOND_WORDS,
    domains: Iterable[str] = DOMAINS,
) -> DataFrame:
    """The list of blocked hosts that the words make; any other table of ``host, path, action`` does as well."""
    parts = spark.range(1)
    for name, values in (("a", first), ("b", second), ("c", domains)):
        parts = parts.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    named = F.concat_ws(".", F.concat_ws("-", "a", "b"), "c")
    return parts.select(named.alias("host"), F.lit("/").alias("path"), F.lit("block").alias("action"), F.lit("listed").alias("listing"))


def flagged(pages: DataFrame, url: str = "url", html: str = "html", signs: str = SIGNS, least: int = LEAST_SIGNS) -> DataFrame:
    """The list of blocked pages that their own html makes: canonical URLs of those with so many runs of signs.

    An entry fits its path alone, on its host and subdomains, however a URL
    spells it. Null html has no signs; URLs without a host are not listed; pages
    that share a canonical URL make one entry.
    """
    found = pages.where(F.regexp_count(F.col(html).cast("string"), F.lit(signs)) >= least).select(F.col(url).cast("string").alias("url"))
    named = found.select(canonical_host(F.col("url")).alias("host"), F.concat(canonical_path(F.col("url")), F.lit(END)).alias("path"))
    listed = named.where("host <> ''").distinct().select("host", "path", F.lit("block").alias("action"), F.lit("listed").alias("listing"))
    return materialise(listed, "flagged")  # html is read once, however often the list is


def _key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit(" "), path)


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """``(host, path)`` structs: every parent domain with every listed length of path prefix."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.char_length(path))
    prefixes = F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(
        F.transform(domains, lambda d: F.transform(prefixes, lambda p: F.struct(d.alias("host"), p.alias("path"))))
    )


def matches(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """``url, host, path, action`` of the longest listed entry that fits, for urls that one fits.

    ``urls`` has distinct ``url`` with the ``host`` and ``path`` to look up;
    ``listed`` has ``host, path, action``. An entry fits its host and all
    subdomains where the path starts with its own. Of entries as long as each
    other the longer host wins, then the action "allow".
    """
    entry = listed.groupBy(F.col("host").alias("l_host"), F.col("path").alias("l_path")).agg(
        F.min("action").alias("action")
    )
    lengths = sorted(r[0] for r in entry.select(F.char_length("l_path")).distinct().collect())
    if not lengths:
        return urls.select("url", F.lit("").alias("host"), F.lit("").alias("path"), F.lit("").alias("action")).where("false")
    bloom = BlockedBloom(entry.select(_key(F.col("l_host"), F.col("l_path"))))
    asked = urls.select("url", F.explode(candidates(F.col("host"), F.col("path"), lengths)).alias("c")).select("url", "c.*")
    hit = bloom.mark(asked, _key(F.col("host"), F.col("path")), "hit").where("hit").drop("hit")
    exact = hit.join(entry, (F.col("host") == F.col("l_host")) & (F.col("path") == F.col("l_path")))
    size = F.char_length("host") + F.char_length("path")
    best = F.max_by(F.struct("host", "path", "action"), F.struct(size, F.char_length("host")))
    return exact.groupBy("url").agg(best.alias("best")).select("url", "best.*")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    listed: DataFrame,
    url: str = "url",
    id_col: str = "page_id",
    default: str = "allow",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` for each row of ``pages``.

    The longest rule that fits host and path as they stand decides; without one
    the longest listed entry that fits the canonical URL does, then ``default``;
    a listed path that ends in ``END`` fits no longer one.
    Null urls and those without ``://`` have an empty host and path, which
    nothing fits; repeated rows and null ids each get a row; an empty table gives
    none. Other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).cast("string").alias("url"))
    distinct = rows.where(F.contains(F.col("url"), F.lit("://"))).select("url").distinct()
    url_col = F.col("url")
    parts = (("host", host), ("path", path), ("c_host", canonical_host), ("c_path", canonical_path))
    distinct = materialise(spread(distinct).select("url", *(part(url_col).alias(n) for n, part in parts)), "urls")
    by_rule = matches(distinct.select("url", "host", "path"), rules).select(
        F.col("url").alias("rule_url"), F.concat("host", "path").alias("rule"), F.col("action").alias("rule_action")
    )
    canonical = distinct.select("url", F.col("c_host").alias("host"), F.concat("c_path", F.lit(END)).alias("path"))
    by_list = matches(canonical, listed).select(
        F.col("url").alias("list_url"),
        F.rtrim(F.concat("host", "path"), F.lit(END)).alias("listed"),
        F.col("action").alias("list_action"),
    )
    return (
        rows.join(by_rule, rows["url"] == F.col("rule_url"), "left")
        .join(by_list, rows["url"] == F.col("list_url"), "left")
        .select(
            "page_id",
            host(F.col("url")).alias("host"),
            path(F.col("url")).alias("path"),
            "rule",
            F.coalesce("rule_action", "list_action", F.lit(default)).alias("verdict"),
            "listed",
        )
    )


def keep_allowed(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` without the rows whose url is blocked, all columns kept, whatever their names.

    Null urls and those without ``://`` get the default verdict; repeated rows
    go or stay together; an empty table stays empty. Blocked urls meet the rows
    through :func:`without`: no page is moved, however hot its url.
    """
    judged = judge(pages.select(url).distinct(), rules, listed, url, url, default)
    return without(pages, url, materialise(judged.where(F.col("verdict") == "block").select("page_id"), "blocked"))
