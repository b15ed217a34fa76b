"""SimHash near-duplicates, linked by multi-index hashing.

A fingerprint has a bit set where over half the text's word-shingle hashes have
it. Two fingerprints link when at most ``distance`` bits differ. The 64 bits
fall into segments, each with a table of the distinct fingerprints by that
segment's value. If two fingerprints differ in ``distance`` bits or fewer, some
segment differs by no more than its share, so every fingerprint enumerates the
small Hamming ball around each of its segments, fetches the tables' matches and
verifies the complete distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bloom import MAX_BROADCAST, BlockedBloom, without
from .common import discard, fresh, materialise, spread, to_workers
from .graph import components

#: Words of a shingle, bits that linked fingerprints may differ in, and segments, of about as
#: many bits each as the logarithm of the number of distinct fingerprints.
WORDS = 4
DISTANCE = 4
SEGMENTS = 3
SEED = 42
#: A table bucket with more nodes than this keeps its most frequent chain from meeting itself, and
#: more near copies than this are a crowd.
HOT = 64
#: Nodes of a crowd that all others of it are compared with.
HUBS = 4
#: Nodes of one bucket that are put in order together, about.
WINDOW = 4096
#: Near copies by similarity: words of a shingle and least similarity; 64-bit words of their
#: fingerprints and bits of a segment; bits that the first word, and every word on average, may
#: differ in. At a similarity of 0.8 a bit differs with a probability of 0.15: 10 of 64 and 39 of
#: 256, with a deviation of 2.9 and 5.7.
NEAR_WORDS = 5
SIMILARITY = 0.8
WIDE_WORDS = 4
SEGMENT_BITS = 18
SKETCH_BITS = 15
WIDE_DISTANCE = 12
#: Neighbours in a table's order that chains are made of, and bits a word that they may differ in: chains
#: may leave links out, which the search then finds.
LAGS = 2
CHAIN_DISTANCE = 9
#: Rows whose shingles a task holds together.
ROWS = 256
#: Shingles hashed together: a bound on memory for very long texts.
BLOCK = 1 << 15


def fingerprint(text: str | None, n: int = WORDS) -> int:
    """The unsigned 64-bit fingerprint of a whole text; 0 for one with no words.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Shingles are ``n``
    words joined by spaces, repeats counted; a shorter text is one shingle.
    """
    import xxhash

    hash64 = xxhash.xxh64_intdigest
    # On bytes, lower() and split() know only A-Z and the six ASCII spaces.
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    total = max(1, len(found) - n + 1)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, total, BLOCK):
        part = found[start : min(start + BLOCK, total) + n - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(n)))) if len(found) >= n else [b" ".join(found)]
        hashes = np.array([hash64(s, SEED) for s in shingles], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist())


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", n: int = WORDS) -> DataFrame:
    """``doc_id, fp``: each row's fingerprint as a signed long."""

    def fp(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.fromiter((fingerprint(t.as_py(), n) for t in batch.column("text")), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made.view(np.int64))], names=["doc_id", "fp"])

    read = _read(docs, text, id_col)
    return read.mapInArrow(fp, T.StructType([read.schema["doc_id"], T.StructField("fp", T.LongType())]))


def _read(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    return to_workers(docs).select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))


def segments(count: int = SEGMENTS, distance: int = DISTANCE) -> list[tuple[int, int, int]]:
    """``(shift, bits, radius)`` of each segment.

    With radii ``r``, two fingerprints whose every segment differs by more than
    its radius differ in ``sum(r + 1)`` bits at least; radii with
    ``sum(r + 1) = distance + 1`` therefore miss no link.
    """
    if not 1 <= count <= min(64, distance + 1):
        raise ValueError("segments must be between 1 and distance + 1")
    edges = [64 * i // count for i in range(count + 1)]
    shares = [(distance + 1) // count + (i < (distance + 1) % count) for i in range(count)]
    return [(a, b - a, share - 1) for a, b, share in zip(edges, edges[1:], shares)]


def _ball(bits: int, radius: int) -> list[int]:
    """Masks of up to ``radius`` of ``bits`` bits."""
    return [sum(1 << b for b in flips) for r in range(radius + 1) for flips in combinations(range(bits), r)]


def _segment(words: list[Column], shift: int, bits: int) -> Column:
    """``bits`` bits from bit ``shift`` on of 64-bit words, lowest first."""
    word, low = divmod(shift, 64)
    if bits == 64 and not low:
        return words[word]
    value = F.shiftrightunsigned(words[word], low)
    if low + bits > 64:
        value = value.bitwiseOR(F.shiftleft(words[word + 1], 64 - low))
    return value.bitwiseAND(F.lit((1 << bits) - 1))


def _signed(mask: int) -> Column:
    return F.lit(mask - (mask >> 63 << 64)).cast("long")


def _probes(seg: int, value: Column, bits: int, radius: int, odd: bool) -> Column:
    """Table keys that differ from a fingerprint's segment in an odd, or an even, number of bits, ``radius`` at most.

    Of two segments that differ in an odd number one has odd parity: only that
    one asks, so half of the probes of a radius of 1 suffice.
    """
    masks = [m for m in _ball(bits, radius) if m.bit_count() % 2 == odd]
    keys = F.transform(F.array(*map(_signed, masks)), lambda m: F.struct(F.lit(seg).alias("seg"), value.bitwiseXOR(m).alias("value")))
    none = F.array().cast("array<struct<seg:int,value:bigint>>")
    return F.when(F.bit_count(value) % 2 == 1, keys).otherwise(none) if odd else keys


def _table(fps: DataFrame, plan: list[tuple[int, int, int]], words: list[str]) -> DataFrame:
    """Every node under each of its segments: ``seg, value`` before the columns of ``fps``."""
    columns = [F.col(w) for w in words]
    keys = (
        F.struct(F.lit(i).alias("seg"), _segment(columns, shift, bits).alias("value"))
        for i, (shift, bits, _) in enumerate(plan)
    )
    return fps.select(F.inline(F.array(*keys)), "*")


def _at(rows: DataFrame, buckets: DataFrame, how: str) -> DataFrame:
    """``rows`` joined with a list of buckets, whose columns ``seg, value`` become ``h_seg, h_value``."""
    named = buckets.withColumnsRenamed({"seg": "h_seg", "value": "h_value"})
    named = F.broadcast(named) if buckets.count() <= MAX_BROADCAST else named
    return rows.join(named, (F.col("seg") == F.col("h_seg")) & (F.col("value") == F.col("h_value")), how)


def _split(rows: DataFrame, hot: DataFrame | None, probe: bool) -> DataFrame:
    """``rows`` with ``part``, which keeps the most frequent chain of a hot bucket from meeting itself.

    In a hot bucket that chain's rows are part 1, all others part 2. A probe of
    the chain asks for part 2 only, any other for both.
    """
    if hot is None:
        return rows.withColumn("part", F.lit(0))
    joined = _at(rows, hot, "left")
    same = F.coalesce(F.col("chain") == F.col("main"), F.lit(False))
    if probe:
        both = F.when(F.col("h_seg").isNull(), F.array(F.lit(0))).when(same, F.array(F.lit(2))).otherwise(F.array(F.lit(1), F.lit(2)))
        part = F.explode(both)
    else:
        part = F.when(F.col("h_seg").isNull(), 0).when(same, 1).otherwise(2)
    return joined.withColumn("part", part).drop("h_seg", "h_value", "main")


def _asking(
    nodes: DataFrame, words: list[str], plan: list[tuple[int, int, int]], odd: bool, carried: list[str]
) -> DataFrame | None:
    """The probes of all nodes: ``seg, value`` before the carried columns. None if there are no such."""
    columns = [F.col(w) for w in words]
    balls = [_probes(i, _segment(columns, s, b), b, r, odd) for i, (s, b, r) in enumerate(plan) if r or not odd]
    return nodes.select(F.inline(F.flatten(F.array(*balls))), *carried) if balls else None


def near_pairs(fps: DataFrame, distance: int = DISTANCE, count: int = SEGMENTS) -> DataFrame:
    """``u, v``: all pairs of distinct fingerprints that differ in 1 to ``distance`` bits.

    ``fps`` has each fingerprint once, as the long ``fp``, and may have a
    ``chain``: pairs within one chain are then left out. A pair may come from
    several tables. The join emits verified pairs only.
    """
    return _search(fps.withColumnRenamed("fp", "node"), ["node"], segments(count, distance), "node", distance)


def _search(
    nodes: DataFrame, words: list[str], plan: list[tuple[int, int, int]], sketch: str, distance: int, similarity: float = 0.0
) -> DataFrame:
    """``u, v``: nodes that share a table bucket after the probes, with ``sketch`` at most ``distance`` bits apart.

    ``nodes`` has ``node``, the fingerprint's ``words`` and, if chained, ``chain``;
    if :func:`_crowded` found any, ``crowd`` and ``room``, and then pairs within a
    crowd are left out that cannot be as similar as asked.
    """
    carried = [c for c in dict.fromkeys(("node", sketch, "chain", "crowd", "room")) if c in nodes.columns]
    chain = "chain" in carried
    table = _table(nodes, plan, words).select("seg", "value", *carried)
    hot = None
    if chain:
        full = table.groupBy("seg", "value", "chain").agg(F.count("*").alias("n"))
        most = F.max_by("chain", F.when(F.col("chain").isNotNull(), F.col("n")))
        hot = full.groupBy("seg", "value").agg(F.sum("n").alias("n"), most.alias("main"))
        hot = materialise(hot.where(F.col("n") > HOT).drop("n"), "hot")
    table = _split(table, hot, probe=False)
    found = None
    for odd in (False, True):
        asking = _asking(nodes, words, plan, odd, carried)
        if asking is None:
            continue
        probe = _split(asking, hot, probe=True)
        on = F.bit_count(F.col(f"p.{sketch}").bitwiseXOR(F.col(f"t.{sketch}"))) <= distance
        for key in ("seg", "value", "part"):
            on = (F.col(f"p.{key}") == F.col(f"t.{key}")) & on
        if not odd:  # either of two can be the probe; which is fixed, by value
            on = on & (F.col("p.node") < F.col("t.node"))
        if chain:
            on = on & F.coalesce(F.col("p.chain") != F.col("t.chain"), F.lit(True))
        if "crowd" in carried:
            on = on & (F.coalesce(F.col("p.crowd") != F.col("t.crowd"), F.lit(True)) | _may_be_similar("p.room", "t.room", similarity))
        u, v = F.col("p.node"), F.col("t.node")
        pairs = probe.alias("p").join(table.alias("t"), on).select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v"))
        found = pairs if found is None else found.union(pairs)
    return found


def _beside(nodes: DataFrame, words: list[str], plan: list[tuple[int, int, int]], sketch: str, distance: int) -> DataFrame:
    """``u, v, apart``: neighbours in a table's order with ``sketch`` at most ``distance`` bits apart.

    ``apart`` counts the bits of all words.

    A bucket of more than ``WINDOW`` nodes is ordered in parts of about that
    many, dealt by a hash that differs in every table.
    """
    table = _table(nodes, plan, words).select("seg", "value", *dict.fromkeys(("node", sketch, *words)))
    full = table.groupBy("seg", "value").agg(F.count("*").alias("n")).where(F.col("n") > WINDOW)
    full = materialise(full, "full")
    part = F.lit(0)
    if not full.isEmpty():
        table = _at(table, full, "left")
        parts = F.coalesce(F.ceil(F.col("n") / F.lit(WINDOW)), F.lit(1))
        part = F.pmod(F.xxhash64("node", "seg"), parts)
    order = Window.partitionBy("seg", "value", "part").orderBy(*dict.fromkeys((*words, "node")))
    at = table.withColumn("part", part)
    every = F.struct(*dict.fromkeys(("node", *words)))
    before = F.array(*(F.lag(every, k).over(order) for k in range(1, LAGS + 1)))

    def bits(x: Column, w: str) -> Column:
        return F.bit_count(x[w].bitwiseXOR(F.col(w)))

    near = F.filter(before, lambda x: bits(x, sketch) <= distance)
    pairs = at.select(*dict.fromkeys(("node", *words)), near.alias("near")).select(
        "node",
        F.inline(F.transform("near", lambda x: F.struct(x["node"].alias("u"), sum((bits(x, w) for w in words), F.lit(0)).alias("apart")))),
    )
    return pairs.select(F.least("u", "node").alias("u"), F.greatest("u", "node").alias("v"), "apart").distinct()


def _with_chain(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with ``chain``, the component of ``links`` that each is in; null without one."""
    roots = components(links)
    members = roots.union(roots.select(F.col("root").alias("node"), "root")).distinct().toDF("of", "chain")
    return nodes.join(members, F.col("node") == F.col("of"), "left").drop("of")


def chained(fps: DataFrame, distance: int = DISTANCE, count: int = SEGMENTS) -> DataFrame:
    """``fps`` with ``chain``, the component of links between neighbours in a table's order; null without one.

    A dense group of near copies has links between almost all its pairs. Those
    between neighbours, at most one for each fingerprint and table, connect most
    of it, and the search need not emit the rest.
    """
    nodes = fps.withColumnRenamed("fp", "node")
    links = _beside(nodes, ["node"], segments(count, distance), "node", distance).select("u", "v")
    return _with_chain(nodes, links).withColumnRenamed("node", "fp")


def near_groups(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    n: int = WORDS,
    distance: int = DISTANCE,
    count: int = SEGMENTS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest id
    reachable over links. Equal fingerprints are one node, so copies make no
    pairs. Null and blank texts have fingerprint 0 and link like any other;
    null ids are passed over in the minimum (null where there is no other);
    repeated rows each get a row. Other columns are not read.
    """
    rows = materialise(fingerprints(docs, text, id_col, n), "fingerprints")
    fps = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    chains = materialise(spread(chained(fps.select("fp"), distance, count)), "chains")
    along = chains.where("fp != chain").select(F.col("fp").alias("u"), F.col("chain").alias("v"))
    roots = components(along.union(near_pairs(chains, distance, count)))
    rooted = fps.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    label = rooted.join(smallest, "root").select(F.col("fp").alias("of"), "component_id")
    return rows.join(label, F.col("fp") == F.col("of")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# Near copies by similarity: wide fingerprints find them, an exact check of the shingles decides.


def _wide(text: str | None, n: int, wide: int = WIDE_WORDS) -> tuple[list[int], int, np.ndarray]:
    """Fingerprint words, a digest and the sorted distinct hashes of a text's ``n``-word shingles."""
    import xxhash

    found = (text or "").encode().lower().split()
    if not found:
        return [0] * wide, 0, np.zeros(0, dtype=np.uint64)
    hash64 = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(found[i:] for i in range(n)))) if len(found) >= n else [b" ".join(found)]
    hashes = np.unique(np.fromiter((hash64(s, SEED) for s in shingles), dtype=np.uint64))
    out = []
    for i in range(wide):
        mixed = hashes * np.uint64(2 * i + 1) + np.uint64(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        counts = np.zeros(64, dtype=np.int64)
        for start in range(0, len(mixed), BLOCK):
            part = mixed[start : start + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0]))
    return out, xxhash.xxh64_intdigest(hashes.tobytes(), SEED) - (1 << 63), hashes


def _sketched(docs: DataFrame, text: str, id_col: str, n: int, wide: int, with_hashes: bool) -> DataFrame:
    """``doc_id, node`` and the fingerprint's words, or the ``hashes``; rows of one shingle set share the ``node``."""
    words = [f"w{i}" for i in range(wide)]
    kinds = {"node": pa.int64()} | ({"hashes": pa.list_(pa.int64())} if with_hashes else dict.fromkeys(words, pa.int64()))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                part = batch.slice(start, ROWS)
                rows = []
                for value in part.column("text"):
                    fp, node, hashes = _wide(value.as_py(), n, wide)
                    rows.append((node, hashes.view(np.int64)) if with_hashes else (node, *fp))
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds.values())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", *kinds])

    read = _read(docs, text, id_col)
    more = (T.StructField(c, T.ArrayType(T.LongType()) if c == "hashes" else T.LongType()) for c in kinds)
    return read.mapInArrow(sketch, T.StructType([read.schema["doc_id"], *more]))


def similar_groups(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    n: int = NEAR_WORDS,
    similarity: float = SIMILARITY,
    wide: int = WIDE_WORDS,
    bits: int = SEGMENT_BITS,
) -> DataFrame:
    """``doc_id, keep_id`` for each row of ``docs``: the smallest id of its group of near copies.

    Two texts link if the Jaccard similarity of their sets of ``n``-word
    shingles (a shorter text is one shingle) is ``similarity`` or more; groups
    are the components of links. Candidates come from SimHash fingerprints of
    ``wide`` 64-bit words by multi-index hashing with a radius of 1 in segments of
    ``bits`` bits; their complete distance and then their exact similarity is
    verified, so no group joins texts that no links connect. A pair at the
    threshold itself has all its segments (14 of 18 bits by default) 2 bits or
    more apart in about 3 % of cases and is then missed; far fewer above it (the
    README has measured figures). A table bucket holds one of ``2 ** bits`` of all
    distinct texts, and probes compare within buckets, so 18 bits suit up to some
    10^8 texts; beyond, 8 words and 24 bits keep nearly the same recall.

    Null and blank texts have no shingles and equal each other. A null id is
    passed over in the minimum (null where there is no other). Repeated rows each
    get a row; an empty table gives none; other columns are not read.
    """
    words = [f"w{i}" for i in range(wide)]
    rows = materialise(_sketched(docs, text, id_col, n, wide, False), "wide")
    least = F.min("doc_id").alias("least")
    nodes = materialise(rows.groupBy("node").agg(least, *(F.first(w).alias(w) for w in words)), "nodes")
    plan = [(bits * i, bits, 1) for i in range(64 * wide // bits)]
    search = nodes.select("node", *words)

    def verified(pairs: DataFrame) -> DataFrame:
        asked = _nodes_of(pairs)
        sets = _sets(docs, rows, asked, text, id_col, n)
        found = _similar(pairs, sets, similarity)
        discard(pairs, asked, sets)
        return found

    near_by = materialise(_beside(search, words, plan, "w0", SKETCH_BITS), "beside")
    close = near_by.where(F.col("apart") <= CHAIN_DISTANCE * wide).select("u", "v")
    along = verified(materialise(close, "close"))
    if (crowds := _crowded(near_by.select("u", "v"))) is not None:
        sets = _sets(docs, rows, crowds.select(F.col("node").alias("of")), text, id_col, n)
        rooms, links = _spokes(crowds, sets, similarity)
        discard(sets, crowds)
        along = along.union(links)
        search = search.join(rooms.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").drop("of")
    discard(near_by)
    chains = materialise(spread(_with_chain(search, along)), "chains")
    across = materialise(_search(chains, words, plan, "w0", SKETCH_BITS, similarity).distinct(), "across")
    near = _complete(across, nodes.select("node", *words), words, WIDE_DISTANCE)
    discard(across, chains)
    across = verified(near)
    roots = components(along.union(across))
    rooted = nodes.join(roots.toDF("of", "root"), F.col("node") == F.col("of"), "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("keep_id"))
    label = rooted.join(smallest, "root").select(F.col("node").alias("of"), "keep_id")
    return rows.join(label, F.col("node") == F.col("of")).select("doc_id", "keep_id")


def _complete(pairs: DataFrame, nodes: DataFrame, words: list[str], distance: int) -> DataFrame:
    """Candidate pairs whose complete fingerprints differ in ``distance`` bits a word at most."""
    of_u = nodes.toDF("u", *(f"u_{w}" for w in words))
    of_v = nodes.toDF("v", *(f"v_{w}" for w in words))
    apart = sum((F.bit_count(F.col(f"u_{w}").bitwiseXOR(F.col(f"v_{w}"))) for w in words), F.lit(0))
    return materialise(pairs.join(of_u, "u").join(of_v, "v").where(apart <= distance * len(words)).select("u", "v"), "close")


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return materialise(pairs.select("u").union(pairs.select("v")).distinct().toDF("of"), "asked")


def _sets(docs: DataFrame, rows: DataFrame, asked: DataFrame, text: str, id_col: str, n: int) -> DataFrame:
    """``node, hashes``: the shingles of the nodes ``of`` in ``asked``, from the texts themselves.

    Only rows whose id passes a Bloom filter of one row for each node are read
    into shingles, and only the shingles asked for are moved.
    """
    ids = rows.join(asked, F.col("node") == F.col("of"), "left_semi").groupBy("node").agg(F.min("doc_id").alias("id"))
    (hit,) = fresh(docs, "hit")
    known = BlockedBloom(ids.select("id").distinct())
    maybe = known.mark(docs, F.col(id_col), hit).where(hit)
    own = _sketched(maybe, text, id_col, n, 0, True)
    own = own.join(asked, F.col("node") == F.col("of"), "left_semi")
    sets = materialise(own.groupBy("node").agg(F.first("hashes").alias("hashes")), "shingles")
    discard(known.table)
    return sets


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose sets of shingles are as similar as asked."""
    both = F.size(F.array_intersect("u_set", "v_set"))
    jaccard = both / F.greatest(F.lit(1), F.size("u_set") + F.size("v_set") - both)
    joined = pairs.join(sets.toDF("u", "u_set"), "u").join(sets.toDF("v", "v_set"), "v")
    return materialise(joined.where(jaccard >= similarity).select("u", "v"), "verified")


def _crowded(near_by: DataFrame) -> DataFrame | None:
    """``node, crowd`` of nodes that are near each other in the tables, more than ``HOT`` together; None without such.

    A crowd is a component of neighbours by the first word of their fingerprints
    alone. It only says whose pairs are worth a closer look before they are made.
    """
    roots = components(near_by)
    members = roots.select("node", F.col("root").alias("crowd")).union(roots.select("root", "root")).distinct()
    large = materialise(members.groupBy("crowd").agg(F.count("*").alias("n")).where(F.col("n") > HOT).drop("n"), "large")
    return None if large.isEmpty() else materialise(members.join(large, "crowd").select("node", "crowd"), "crowds")


def _spokes(crowds: DataFrame, sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """``node, crowd, room`` and verified links ``u, v`` from some nodes of each crowd to all others.

    In a group of very many near copies pairs grow with its square. Two things
    make most of them needless. ``room`` is how many shingles a node has and,
    in its lower half, how many of them any other of the crowd has too: two nodes
    cannot share more than the lesser of those. And the ``HUBS`` nodes with the
    least shingles of their own are compared with all, which brings almost every
    node that has links into a chain.
    """
    each = sets.join(crowds.toDF("of", "crowd"), F.col("node") == F.col("of")).drop("of")
    # A shingle that one node alone has carries its node with it: no join, and partial sums for frequent ones.
    own = each.select("crowd", "node", F.explode("hashes").alias("h")).groupBy("crowd", "h").agg(
        F.count("*").alias("n"), F.min("node").alias("node")
    )
    own = own.where("n = 1").groupBy("node").agg(F.count("*").alias("own")).withColumnRenamed("node", "of")
    counted = each.select("node", "crowd", F.size("hashes").cast("long").alias("size"))
    counted = counted.join(own, F.col("node") == F.col("of"), "left").withColumn("own", F.coalesce("own", F.lit(0)))
    room = F.shiftleft("size", 32).bitwiseOR(F.col("size") - F.col("own"))
    rooms = materialise(counted.select("node", "crowd", "own", room.alias("room")), "rooms")
    nth = F.pmod(F.xxhash64("node"), F.lit(HUBS))
    hubs = rooms.groupBy("crowd", nth.alias("nth")).agg(F.min_by(F.struct("node", "room"), F.struct("own", "node")).alias("hub"))
    hubs = materialise(hubs.select(F.col("crowd").alias("of"), F.col("hub.node").alias("hub"), F.col("hub.room").alias("h_room")), "hubs")
    hubs = F.broadcast(hubs) if hubs.count() <= MAX_BROADCAST else hubs
    pairs = rooms.join(hubs, (F.col("crowd") == F.col("of")) & (F.col("node") != F.col("hub")) & _may_be_similar("room", "h_room", similarity))
    pairs = pairs.select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v")).distinct()
    return rooms.drop("own"), _similar(materialise(pairs, "spokes"), sets, similarity)


def _may_be_similar(room: str, other: str, similarity: float) -> Column:
    """Whether two nodes of a crowd could share so much, from what each has and shares with any of it."""

    def size(c: str) -> Column:
        return F.shiftrightunsigned(F.col(c), 32)

    def shared(c: str) -> Column:
        return F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))

    most = F.least(shared(room), shared(other))
    return most >= F.lit(similarity) * (size(room) + size(other) - most)


def drop_near_copies(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", n: int = NEAR_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """``docs`` with one document of each group of :func:`similar_groups`: that with the smallest id.

    Rows with a null id stay. Rows that repeat an id go only if all of them
    would. Dropped ids meet the rows through :func:`without`: no text is moved.
    """
    groups = similar_groups(docs, text, id_col, n, similarity)
    others = groups.groupBy("doc_id").agg(F.bool_and(F.col("doc_id") != F.col("keep_id")).alias("all"))
    return without(docs, id_col, materialise(others.where("all").select("doc_id"), "others"))
