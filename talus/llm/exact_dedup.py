"""Exact deduplication over content-defined chunk recipes.

A text is cut where its own characters say so, and becomes a *recipe*: the
ordered list of its chunks' 64-bit hashes, each with the chunk's SHA-256 and
byte length. Chunks are deduplicated into a store in which every 64-bit hash is
verified to stand for one (SHA-256, length) only; should two chunks share a
hash, the later ones get an ordinal of their own. Texts are equal when their
ordered identifier lists are. After the one scan only recipes move (about 50
bytes a chunk), never the text, however long or often copied it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bloom import without
from .common import ascii_lower, fresh, let, materialise

#: Bounds of a chunk's length in characters.
MIN_CHARS = 256
MAX_CHARS = 4096


#: Scripts beyond ASCII, with the period after which classes of their code points repeat.
SCRIPTS = ((0xA0, 0x700, 32), (0x900, 0xE80, 32), (0x3040, 0x3100, 32), (0x4E00, 0xA000, 1024), (0xAC00, 0xD7A4, 1024))


def chunk_pattern(low: int = MIN_CHARS, high: int = MAX_CHARS, mask: int = 8) -> str:
    """A regular expression whose matches tile a text.

    A chunk ends at the first place, ``low`` characters on, where three
    characters fall into three fixed classes of 1 in ``mask`` code points each,
    or after ``high`` characters. In ASCII every ``mask``-th code point is of a
    class; beyond, a run of them in every period of the script.
    """

    def one_in(rest: int) -> str:
        plain = "".join(f"\\x{c:02x}" for c in range(0x20, 0x7F) if (c * 5) % mask == rest)
        runs = ((c + step // 2 + rest * (step // mask), step // mask) for low, end, step in SCRIPTS for c in range(low & -step, end, step))
        other = "".join(f"\\u{first:04x}-\\u{first + width - 1:04x}" for first, width in runs)
        return f"(?:[{plain}]|(?![\\x00-\\x7f])[{other}])"

    edge = one_in(0) + one_in(1) + one_in(1)
    return f"(?s).{{{low},{high - 3}}}?{edge}|.{{1,{high}}}"


def chunks(text: Column, pattern: str | None = None) -> Column:
    """The chunks of a text, in order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(pattern or chunk_pattern()), F.lit(0))


def _ids(docs: DataFrame, text: str, id_col: str, pattern: str | None) -> DataFrame:
    """A row for each document: its number here, id, digest and recipe."""
    norm = ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    cut = let(
        norm,
        lambda t: F.struct(
            F.sha2(t, 256).alias("sha256"),
            F.transform(
                chunks(t, pattern),
                lambda c: F.struct(
                    F.xxhash64(c).alias("h"),
                    F.unhex(F.sha2(c, 256)).alias("digest"),
                    F.octet_length(c).alias("size"),
                ),
            ).alias("recipe"),
        ),
    )
    return (
        docs.select(F.col(id_col).alias("doc_id"), cut.alias("cut"))
        .select("doc_id", "cut.sha256", "cut.recipe")
        .withColumn("row", F.monotonically_increasing_id())
    )


def _ordinals(recipes: DataFrame) -> DataFrame:
    """Chunks that share a 64-bit hash with another chunk, numbered apart. All but always there are none."""
    store = recipes.select(F.explode("recipe").alias("c")).select("c.*").distinct()
    shared = store.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    by_hash = Window.partitionBy("h").orderBy("digest", "size")
    return store.join(shared, "h", "left_semi").withColumn("ordinal", F.row_number().over(by_hash))


def _identified(recipes: DataFrame) -> DataFrame:
    """``recipes`` with each document's list of verified chunk identifiers."""
    ordinals = materialise(_ordinals(recipes), "ordinals")
    none = F.array().cast("array<struct<pos:int,ordinal:int>>")
    if ordinals.isEmpty():
        return recipes.select("row", "doc_id", "sha256", F.col("recipe.h").alias("ids"), none.alias("apart"))
    apart = (
        recipes.select("row", F.posexplode("recipe").alias("pos", "c"))
        .select("row", "pos", "c.*")
        .join(ordinals, ["h", "digest", "size"])
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "ordinal"))).alias("apart"))
    )
    return recipes.join(apart, "row", "left").select(
        "row",
        "doc_id",
        "sha256",
        F.col("recipe.h").alias("ids"),
        F.coalesce("apart", none).alias("apart"),
    )


def exact_groups(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", pattern: str | None = None
) -> DataFrame:
    """Which rows hold the same text, and which one stays.

    Returns a row for each row of ``docs``: ``doc_id``, ``keep_id`` (the largest
    id of the group), ``group_size``, ``kept``, ``text_sha256``.

    Null texts count as empty and equal each other. A null id ranks below every
    other; of rows that repeat the largest id exactly one has ``kept``. Empty
    tables give empty results; other columns of ``docs`` are not read, so their
    names cannot clash.
    """
    recipes = materialise(_ids(docs, text, id_col, pattern), "recipes")
    rows = _identified(recipes)
    key = ["ids", "apart"]
    groups = (
        rows.groupBy(*key)
        .agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    # As a table of its own, so that both sides of the join are plain exchanges: then a group with
    # very many copies is split over tasks.
    groups = materialise(groups, "groups")
    return rows.join(groups, key, "left").select(
        "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (F.col("best").isNull() | (F.col("row") == F.col("best.row"))).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def _text_digest(text: Column) -> Column:
    return F.sha2(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), 256)


def drop_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose text another row with a larger id has.

    Dropped ids meet the rows through :func:`without`, so the text isn't moved;
    only rows that share an id with a row of another fate are.

    All columns are kept, whatever their names. Rows that repeat id and text
    leave one; rows that share an id but not a text are judged one by one; a
    null id ranks below every other.
    """
    judged = materialise(exact_groups(docs, text, id_col), "exact")
    gid, rows, stay, sha, nth, of = fresh(docs, "id", "rows", "stay", "sha", "nth", "of")
    by_id = judged.groupBy(F.col("doc_id").alias(gid)).agg(
        F.count("*").alias(rows), F.count_if("kept").alias(stay)
    )
    by_id = materialise(by_id.where(F.col(rows) > F.col(stay)), "dropped")
    gone, shared = by_id.where(F.col(stay) == 0).select(gid), by_id.where(F.col(stay) > 0).select(gid)
    if shared.isEmpty():
        return without(docs, id_col, gone)
    among = (
        docs.join(shared, docs[id_col].eqNullSafe(shared[gid]), "left_semi")
        .withColumn(sha, _text_digest(F.col(text)))
        .withColumn(nth, F.row_number().over(Window.partitionBy(id_col, sha).orderBy(F.lit(0))))
        .where(F.col(nth) == 1)
    )
    kept = judged.where("kept").select(F.col("doc_id").alias(gid), F.col("text_sha256").alias(of))
    among = among.join(kept, among[id_col].eqNullSafe(kept[gid]) & (among[sha] == kept[of]), "left_semi")
    return without(docs, id_col, by_id.select(gid)).unionByName(among.select(*docs.columns))
