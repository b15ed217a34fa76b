"""The corpus operators' registered queries, and DuckDB SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, factorisation, langid, licenses, mixing, negatives, packing, quality, simhash, token_counts, toxicity, urls, whitening
from .common import read
from .vectors import SCALE


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("rate", "copies")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.histogram(read(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    listed = urls.junk_hosts(spark).union(urls.flagged(pages))
    return urls.judge(pages, urls.entries(spark, urls.RULES, "rules"), listed).drop("listed")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents"))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).drop("blocks")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorisation.rate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(rows.withColumn("label", moved))


def vector_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op12 says of each row without its components."""
    return op12_whiten(spark, sf_dir).where("component = 1").select("vec_id", "n", "deviation")


def quality_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op1 measures and decides before it learns anything."""
    s = quality.statistics(F.col("text"))
    measured = read(spark, sf_dir, "documents").select("doc_id", s.alias("s"))
    return measured.select("doc_id", *(f"s.{c}" for c in quality.BASE), quality.base_failed(F.col("s")).alias("base_failed"))


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op3's mix is to take of each source."""
    docs = read(spark, sf_dir, "documents")
    return mixing.source_targets(docs.select("source", mixing.token_count(F.col("text")).alias("size")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_mix_sources": op3_mix_sources,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_url_filter": op6_url_filter,
    "op7_language": op7_language,
    "op8_simhash": op8_simhash,
    "op9_pack": op9_pack,
    "op10_licenses": op10_licenses,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_whiten": op12_whiten,
    "op13_hard_negatives": op13_hard_negatives,
    "vector_deviations": vector_deviations,
    "quality_statistics": quality_statistics,
    "mix_targets": mix_targets,
}


def _list(words) -> str:
    return "[" + ", ".join(f"'{w.decode()}'" for w in words) + "]"


_PHRASES = ", ".join(f"({_list(licenses.words(p))}, '{label}')" for p, label in licenses.PHRASES)


def _said(texts) -> str:
    return "[" + ", ".join(f"'{p.decode()}'" for p in licenses.phrases(texts)) + "]::VARCHAR[]"


_TEMPLATES = ", ".join(
    f"({_list(sorted(set(licenses.words(t))))}, '{label}', {len(licenses.words(t))}, {_said(licenses.MARKS.get(t, ()))}, {_said(licenses.AGAINST.get(label, ()))})"
    for label, t in licenses.TEMPLATES
)
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WORDS = [f"unnest([{', '.join(map(repr, words))}])" for words in (urls.FIRST_WORDS, urls.SECOND_WORDS, urls.DOMAINS)]
_VALUES = [f"('{h}', '{p}', '{a}', 'rule')" for h, p, a in urls.RULES]

_SPLIT = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

ORACLE_SQL: dict[str, str] = {
    "quality_statistics": f"""
        WITH d AS (
          SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t, {_SPLIT} AS w,
                 list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
          FROM documents
        ),
        windows AS (
          SELECT n, i, array_to_string(w[i:i + {quality.WINDOW - 1}], ' ') AS eight
          FROM (SELECT n, w, unnest(generate_series(1, len(w) - {quality.WINDOW - 1})) AS i FROM d)
        ),
        repeated AS (SELECT n, i FROM windows QUALIFY count(*) OVER (PARTITION BY n, eight) > 1),
        covered AS (
          SELECT n, count(DISTINCT i + k) AS words FROM repeated, range(0, {quality.WINDOW}) r(k) GROUP BY n
        ),
        s AS (
          SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                 length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                 len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(words, 0) AS n_repeat_words
          FROM d LEFT JOIN covered USING (n)
        )
        SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words AS base_failed FROM s
    """,
    "op13_hard_negatives": f"""
        WITH ok AS (
          SELECT row_number() OVER () AS r, vec_id,
                 CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda c: greatest(least(CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS HUGEINT), {negatives.MOST_COMPONENT}), -{negatives.MOST_COMPONENT})) AS x
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ),
        longest AS (SELECT max(len(x)) AS size FROM ok),
        rows AS (SELECT r, vec_id, label, list_concat(x, list_transform(range(size - len(x)), lambda i: 0)) AS x FROM ok, longest),
        scored AS (
          SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same,
                 CAST(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])) AS BIGINT) AS score
          FROM rows a JOIN rows b ON a.r <> b.r WHERE a.vec_id % 100 = 0
        ),
        positive AS (
          SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id NULLS LAST, b) <= 5
        )
        SELECT p.anchor_id, p.id AS positive_id,
               CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.id NULLS LAST, n.b) AS INTEGER) AS rank,
               n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positive p JOIN scored n ON p.a = n.a AND NOT n.same
         AND 80 * CAST(p.score AS HUGEINT) <= 100 * CAST(n.score AS HUGEINT) AND n.score <= p.score
        QUALIFY rank <= 5
    """,
    "vector_deviations": f"""
        WITH u AS (
          SELECT vec_id, list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS HUGEINT)) AS x
          FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ),
        longest AS (SELECT max(len(x)) AS size FROM u),
        padded AS (
          SELECT row_number() OVER () AS r, vec_id, list_concat(x, list_transform(range(size - len(x)), lambda i: 0::HUGEINT)) AS x FROM u, longest
        ),
        fit AS (SELECT DISTINCT x FROM padded),
        sums AS (SELECT d, sum(x[d]) AS s FROM fit, (SELECT unnest(range(1, size + 1)) AS d FROM longest) GROUP BY d),
        counted AS (SELECT count(*) AS n FROM fit),
        entries AS (SELECT r, vec_id, unnest(x) AS c, unnest(range(1, len(x) + 1)) AS d FROM padded)
        SELECT any_value(vec_id) AS vec_id, any_value(n) AS n, CAST(sum((n * c - s) * (n * c - s)) AS BIGINT) AS deviation
        FROM entries JOIN sums USING (d), counted GROUP BY r
    """,
    "mix_targets": f"""
        WITH sizes AS (
          SELECT source, CAST(sum(len({_SPLIT})) AS BIGINT) AS source_size FROM documents GROUP BY source
        ),
        weighed AS (
          SELECT *, 3.0::DOUBLE * source_size AS ceiling,
                 CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight
          FROM sizes
        ),
        levels AS (
          SELECT (SELECT sum(source_size) FROM weighed) AS total, a.ceiling / a.weight AS level FROM weighed a
        ),
        -- Shared out at a level: every source up to its ceiling. The mix's level is where that is all there is.
        below AS (
          SELECT max(level) AS level FROM levels
          WHERE (SELECT sum(least(ceiling, levels.level * weight)) FROM weighed) <= total
        ),
        found AS (
          SELECT coalesce((SELECT level FROM below), 0) AS low,
                 (SELECT sum(source_size) FROM weighed) AS total
        )
        SELECT source, source_size,
               CASE WHEN ceiling <= low * weight THEN ceiling
                    ELSE (total - (SELECT coalesce(sum(ceiling), 0) FROM weighed WHERE ceiling <= low * weight))
                         / (SELECT sum(weight) FROM weighed WHERE ceiling > low * weight) * weight END AS target
        FROM weighed, found
    """,
    "op4_exact_dedup": f"""
        WITH t AS (
          SELECT doc_id, {_LOWERED} AS norm
          FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM t
    """,
    "op6_url_filter": f"""
        WITH u AS (
          SELECT page_id, url,
                 regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1) AS raw,
                 regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
                 row_number() OVER () AS n,
                 len(regexp_extract_all(coalesce(html, ''), '{urls.SIGNS}')) >= {urls.LEAST_SIGNS} AS flagged
          FROM pages
        ),
        p AS (
          SELECT page_id, n, path, flagged,
                 translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
          FROM u
        ),
        c AS (
          SELECT n, page_id,
                 regexp_replace(translate(url_decode(regexp_replace(regexp_replace(host, '^(?s:.*)@', ''), ':[0-9]*\\z', '')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '\\.+\\z', '') AS c_host,
                 '/' || array_to_string(list_concat(list_filter(k[:-2], lambda s: s NOT IN ('', '.')), [CASE WHEN k[-1] = '.' THEN '' ELSE k[-1] END]), '/') AS c_path
          FROM (SELECT *, string_split(url_decode(path), '/') AS k FROM p)
        ),
        looked_up AS (
          SELECT n, host, path, 'rule' AS kind FROM p
          UNION ALL
          SELECT n, c_host, c_path || chr(65535), 'listed' FROM c
        ),
        r(r_host, r_path, action, kind) AS (
          VALUES {", ".join(_VALUES)}
          UNION ALL
          SELECT a || '-' || b || '.' || c, '/', 'block', 'listed'
          FROM (SELECT {_WORDS[0]} AS a), (SELECT {_WORDS[1]} AS b), (SELECT {_WORDS[2]} AS c)
          UNION
          SELECT c_host, c_path || chr(65535), 'block', 'listed' FROM c JOIN p USING (n) WHERE flagged AND c_host <> ''
        ),
        fit AS (
          SELECT n, kind, arg_max({{'rule': r_host || r_path, 'action': action}}, length(r_host || r_path) * 10000 + length(r_host)) AS best
          FROM looked_up JOIN r USING (kind) WHERE (host = r_host OR suffix(host, '.' || r_host)) AND starts_with(path, r_path)
          GROUP BY n, kind
        )
        SELECT page_id, host, path, a.best.rule AS rule,
               coalesce(a.best.action, b.best.action, 'allow') AS verdict
        FROM p
        LEFT JOIN fit a ON a.n = p.n AND a.kind = 'rule'
        LEFT JOIN fit b ON b.n = p.n AND b.kind = 'listed'
    """,
    "op10_licenses": f"""
        WITH d AS (
          SELECT row_number() OVER () AS n, doc_id,
                 regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
          FROM documents
        ),
        phrase(words, label) AS (VALUES {_PHRASES}),
        template(words, label, n_own, marks, against) AS (VALUES {_TEMPLATES}),
        place AS (
          SELECT n, label, i - 1 AS word_at
          FROM (SELECT n, w, unnest(generate_series(1, len(w))) AS i FROM d), phrase
          WHERE w[i] = words[1] AND w[i:i + len(words) - 1] = words
        ),
        base AS (
          SELECT n, count(*) AS n_base, min(word_at) AS first_word, max(word_at) AS last_word,
                 string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
          FROM place GROUP BY n
        ),
        block AS (
          SELECT n, label, marks, against, len(list_filter(words, lambda x: list_contains(w[s + 1:s + 2 * n_own + n_own // 4], x))) / len(words) AS share,
                 w[s + 1:s + 2 * n_own + n_own // 4] AS b
          FROM (SELECT n, w, words, label, n_own, marks, against, unnest(generate_series(0, len(w) - 1, n_own)) AS s FROM d, template)
        ),
        near AS (
          SELECT n, label, share, marks, against, ' ' || array_to_string(b, ' ') || ' ' AS said FROM block
          WHERE share >= {licenses.THRESHOLD} - 1e-12
        ),
        hit AS (
          SELECT n, label, share FROM near
          WHERE (len(marks) = 0 OR len(list_filter(marks, lambda m: contains(said, m))) > 0)
            AND len(list_filter(against, lambda m: contains(said, m))) = 0
        ),
        both_labels AS (
          SELECT n, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT n, label FROM place UNION ALL SELECT n, label FROM hit) GROUP BY n
        ),
        best AS (SELECT n, max(share) AS share FROM hit GROUP BY n)
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
        FROM d LEFT JOIN base USING (n) LEFT JOIN both_labels USING (n) LEFT JOIN best USING (n)
    """,
}
