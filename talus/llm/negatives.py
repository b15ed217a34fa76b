"""Hard negatives by a vantage-point tree over norm-augmented vectors.

A further coordinate gives every row the same length, and none to a query: then
a row's distance to the query falls as their inner product rises, and a window
of scores is an annulus around the query. The tree's top is fitted on a bounded
sample and broadcast; it deals all rows to leaves, large leaves to several
shards, and each task grows the rest of the tree over the shards it reads.
Queries go to the shards whose bounds meet their annulus, and walk a shard's
leaves nearest first until no unseen leaf can improve on what they have.

Rows that share a vector and a label are kept in the index as often as they can
be asked for (one more than the positives, or the negatives, wanted), queries
that do are asked once, and each result is handed to all of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, to_workers
from .vectors import matrix, usable, whole

#: Components beyond this count as this, so that no inner product leaves 64 bits (in up to 2^14 dimensions).
MOST_COMPONENT = 1 << 24
#: Rows of a leaf of a shard's tree.
LEAF = 64
#: Shards that a table is cut into, and the bounds on a shard's rows that go before.
SHARDS, LEAST_SHARD, MOST_SHARD = 64, 256, 16_384
#: Numbers in the sample that the top is fitted on, sampled rows for each leaf of it, and leaves, at most.
SAMPLE, LEAF_SAMPLE, TOP_LEAVES = 1 << 20, 8, 1024
#: Queries that a task searches a shard for together.
BLOCK = 256
#: Parts that each group of equal rows is cut into before it is cut down.
SALTS = 16
#: A row without an id comes after all that have one.
NO_ID = (1 << 63) - 1
#: Bounds of an open window, and the part of all lengths that rounding may cost a distance.
OPEN = 1 << 62
SLACK = 1e-6


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def augmented(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the coordinate that makes them all as long as the longest, whose squared length is given."""
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0))])


@dataclass
class Tree:
    """Inner nodes, parents first: a vantage point, the distance that ends its near child, and the far child's distances.

    A child below 0 is a leaf, ``~child`` its number.
    """

    vantage: np.ndarray
    cut: np.ndarray
    far_from: np.ndarray
    far_to: np.ndarray
    near: np.ndarray
    far: np.ndarray
    leaves: int

    @classmethod
    def grow(cls, points: np.ndarray, leaf: int, whole: bool = True) -> tuple[Tree, list[np.ndarray]]:
        """A tree over ``points``, split at median distances down to ``leaf`` rows or equal ones, and the rows of its leaves.

        With ``whole`` unset the points are a sample: rows farther than any of them may come.
        """
        nodes: list[list] = []
        leaves: list[np.ndarray] = []
        todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(points)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            p = points[rows]
            place = ~len(leaves)
            if len(rows) > leaf:
                middle = ((p - p.mean(0)) ** 2).sum(1)
                v = p[middle.argmax()]
                d = _distances(p, v[None, :])[:, 0]
                d[(p == v).all(1)] = 0.0
                cut = np.partition(d, len(d) // 2 - 1)[len(d) // 2 - 1]
                if cut == d.max():
                    cut = d[d < cut].max(initial=-1.0)
                if cut >= 0:
                    place = len(nodes)
                    inside = d <= cut
                    beyond = d[~inside]
                    nodes.append([v, cut, beyond.min() if whole else cut, beyond.max() if whole else np.inf, 0, 0])
                    todo += [(rows[~inside], place, 5), (rows[inside], place, 4)]
            if place < 0:
                leaves.append(rows)
            if parent >= 0:
                nodes[parent][side] = place
        width = points.shape[1]
        columns = list(zip(*nodes)) or [()] * 6
        numbers = [np.array(c, dtype=t) for c, t in zip(columns[1:], (float, float, float, int, int))]
        return cls(np.array(columns[0], dtype=float).reshape(-1, width), *numbers, len(leaves)), leaves

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point belongs to."""
        if not len(self.cut):
            return np.zeros(len(points), dtype=int)
        d = _distances(points, self.vantage)
        at, rows = np.zeros(len(points), dtype=int), np.arange(len(points))
        while (inner := at >= 0).any():
            here = np.where(inner, at, 0)
            at = np.where(inner, np.where(d[rows, here] <= self.cut[here], self.near[here], self.far[here]), at)
        return ~at

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible distance from each query to a row of each leaf, by the triangle inequality."""
        low, high = np.zeros((len(queries), self.leaves)), np.full((len(queries), self.leaves), np.inf)
        d = _distances(queries, self.vantage) if len(self.cut) else None
        at: dict[int, tuple[np.ndarray, np.ndarray]] = {0 if len(self.cut) else ~0: (low[:, 0], high[:, 0])}
        for i in range(len(self.cut)):
            least, most = at.pop(i)
            here = d[:, i]
            at[int(self.near[i])] = np.maximum(least, here - self.cut[i]), np.minimum(most, here + self.cut[i])
            outside = np.maximum(here - self.far_to[i], self.far_from[i] - here)
            at[int(self.far[i])] = np.maximum(least, outside), np.minimum(most, here + self.far_to[i])
        for place, (least, most) in at.items():
            low[:, ~place], high[:, ~place] = least, most
        return low, high


@dataclass
class Asked:
    """Queries with windows of scores: the best ``k`` rows of each are wanted, from ``low`` to ``high``.

    A row of the score ``low`` must have an id up to ``last``. Windows that a
    query lacks are empty ones.
    """

    x: np.ndarray
    labels: list
    low: np.ndarray
    high: np.ndarray
    last: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, size: int) -> Asked:
        windows = batch.column("windows").to_pylist()
        width = max(1, max(map(len, windows), default=1))
        low, high, last = (np.full((len(windows), width), v, dtype=np.int64) for v in (OPEN, -OPEN, NO_ID))
        for i, own in enumerate(windows):
            for w, window in enumerate(own):
                low[i, w], high[i, w], last[i, w] = window["low"], window["high"], window["last"]
        return cls(matrix(batch.column("x"), size), batch.column("label").to_pylist(), low, high, last)

    def annulus(self, longest: float) -> tuple[np.ndarray, np.ndarray]:
        """Inner and outer radius around each query that all its windows lie within."""
        x = self.x.astype(np.float64)
        both = (x * x).sum(1) + longest
        return np.sqrt(np.maximum(both - 2.0 * self.high.max(1), 0)), np.sqrt(np.maximum(both - 2.0 * self.low.min(1), 0))


class Shard:
    """The tree's lower levels over the rows of one shard."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: list, longest: float) -> None:
        self.tree, leaves = Tree.grow(augmented(x, longest), LEAF)
        order = np.concatenate(leaves) if leaves else np.arange(0)
        self.ends = np.cumsum([len(leaf) for leaf in leaves])
        self.x, self.rows, self.ids = x[order], rows[order], ids[order]
        self.codes = {label: i for i, label in enumerate(dict.fromkeys(labels))}
        self.labels = np.array([self.codes[label] for label in labels], dtype=int)[order]
        self.longest = longest
        self.most = int(np.abs(x).max(initial=0))

    def search(self, asked: Asked, k: int, same: bool) -> Iterator[tuple[int, int, int, int, int]]:
        """``query, window, score, id, row`` of up to ``k`` rows for each window, best first; their label is the query's or isn't."""
        codes = np.array([self.codes.get(label, -1) for label in asked.labels])
        most = int(np.abs(asked.x).max(initial=0)) * self.most * max(1, self.x.shape[1])
        kind = np.float64 if most < 1 << 53 else np.int64  # whole numbers either way
        q, x = asked.x.astype(kind), self.x.astype(kind)
        need, last = asked.low.copy(), asked.last.copy()
        inner, reach = asked.annulus(self.longest)
        slack = SLACK * (math.sqrt(self.longest) + np.sqrt((q.astype(float) ** 2).sum(1)))
        low, high = self.tree.bounds(np.column_stack([asked.x.astype(float), np.zeros(len(q))]))
        order = np.argsort(low, axis=1, kind="stable")
        found: dict[tuple[int, int], list] = {}
        walking = np.flatnonzero((asked.low <= asked.high).any(1))
        for nth in range(self.tree.leaves):
            # A leaf out of reach ends a walk: all later ones are farther.
            walking = walking[low[walking, order[walking, nth]] - slack[walking] <= reach[walking]]
            if not len(walking):
                break
            leaf = order[walking, nth]
            meets = high[walking, leaf] + slack[walking] >= inner[walking]
            for number in np.unique(leaf[meets]):
                who = walking[meets & (leaf == number)]
                part = slice(self.ends[number - 1] if number else 0, self.ends[number])
                scores = (q[who] @ x[part].T).astype(np.int64)
                fits = (self.labels[part][None, :] == codes[who][:, None]) == same
                for w in range(need.shape[1]):
                    bound = need[who, w][:, None]
                    hit = fits & (scores <= asked.high[who, w][:, None])
                    hit &= (scores > bound) | ((scores == bound) & (self.ids[part][None, :] <= last[who, w][:, None]))
                    for i in np.flatnonzero(hit.any(1)):
                        self._keep(found, need, last, who[i], w, k, part.start + np.flatnonzero(hit[i]), scores[i][hit[i]])
                both = self.longest + (asked.x[who].astype(float) ** 2).sum(1)
                reach[who] = np.sqrt(np.maximum(both - 2.0 * need[who].min(1), 0))
        for (i, w), best in found.items():
            for score, i_d, row in sorted(best, reverse=True):
                yield i, w, score, -i_d, -row

    def _keep(self, found: dict, need: np.ndarray, last: np.ndarray, i: int, w: int, k: int, at: np.ndarray, scores: np.ndarray) -> None:
        """Offer rows to a window's heap, and tighten the window once it has ``k``."""
        if len(at) > k:
            best = np.lexsort((self.rows[at], self.ids[at], -scores))[:k]
            at, scores = at[best], scores[best]
        heap = found.setdefault((int(i), w), [])
        for j, score in zip(at.tolist(), scores.tolist()):
            entry = (score, -int(self.ids[j]), -int(self.rows[j]))
            if len(heap) < k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
        if len(heap) == k and heap[0][0] >= need[i, w]:
            need[i, w], last[i, w] = heap[0][0], -heap[0][1]


@dataclass
class Index:
    """All rows by shard, and the tree's top with the first shard of each of its leaves."""

    table: DataFrame
    top: Tree
    first_shard: np.ndarray
    size: int
    longest: float

    def route(self, asked: Asked, head: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and shard that may hold an answer: among each query's nearest shards, or among all others."""
        low, high = self.top.bounds(np.column_stack([asked.x.astype(float), np.zeros(len(asked.x))]))
        inner, reach = asked.annulus(self.longest)
        slack = SLACK * (math.sqrt(self.longest) + np.sqrt((asked.x.astype(float) ** 2).sum(1)))
        leaf_of = np.repeat(np.arange(self.top.leaves), np.diff(self.first_shard))
        low, high = low[:, leaf_of], high[:, leaf_of]
        order = np.argsort(low, axis=1, kind="stable")
        nearest = np.zeros(low.shape, dtype=bool)
        np.put_along_axis(nearest, order[:, : math.isqrt(max(0, len(leaf_of) - 1)) + 1], True, axis=1)
        meets = (low - slack[:, None] <= reach[:, None]) & (high + slack[:, None] >= inner[:, None])
        return np.nonzero(meets & (nearest == head) & (asked.low <= asked.high).any(1)[:, None])


def rows_of(df: DataFrame, id_col: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """``row, id, label, x`` of the rows that take part, ``row`` being a name of its own for each, and the length of ``x``."""
    usable_rows = df.where(usable(F.col(vector)) & F.col(label).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v")
    )
    size = usable_rows.agg(F.max(F.size("v")).alias("size")).first()["size"] or 0
    bound = F.lit(MOST_COMPONENT).cast("long")
    x = F.transform(whole(F.col("v"), size), lambda c: F.greatest(F.least(c, bound), -bound))
    return materialise(usable_rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", x.alias("x")), "vectors"), size


def _least(rows: DataFrame, often: int) -> DataFrame:
    """Of the rows that share a vector and a label, those with the least ids, ``often`` at most."""
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS))
    nth = F.row_number().over(Window.partitionBy("x", "label", "salt").orderBy("id", "row"))
    some = rows.withColumn("salt", salt).withColumn("nth", nth).where(F.col("nth") <= often)
    nth = F.row_number().over(Window.partitionBy("x", "label").orderBy("id", "row"))
    return some.withColumn("nth", nth).where(F.col("nth") <= often).drop("nth", "salt")


def build(rows: DataFrame, size: int, often: int) -> Index:
    """The index of :func:`rows_of`'s rows, of which equal ones need not be found more than ``often`` times.

    The top is fitted on ``SAMPLE / size`` rows at most, those with the least hashes; all rows are indexed.
    """
    spark = rows.sparkSession
    kept = materialise(_least(rows, often), "least")
    square = F.aggregate("x", F.lit(0).cast("long"), lambda a, c: a + c * c)
    n, longest = kept.agg(F.count("*"), F.max(square)).first()
    longest = float(longest or 0)
    shard_rows = min(MOST_SHARD, max(LEAST_SHARD, n // SHARDS))
    leaves = min(TOP_LEAVES, max(1, n // shard_rows))
    wanted = max(1, min(SAMPLE // max(1, size), leaves * LEAF_SAMPLE * 8))
    share = min(1.0, 2 * wanted / max(1, n))
    hashed = F.xxhash64("row", F.lit(3))
    near_least = kept.where(F.pmod(hashed, F.lit(1 << 30)) < int(share * (1 << 30)))
    picked = near_least.select("x", hashed.alias("h"), "row").orderBy("h", "row").limit(wanted).collect()
    sample = np.array([r["x"] for r in picked], dtype=np.int64).reshape(len(picked), size)
    top, _ = Tree.grow(augmented(sample, longest), max(LEAF_SAMPLE, -(-len(picked) // leaves)), whole=False)
    shared = spark.sparkContext.broadcast(top)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.leaf_of(augmented(matrix(batch.column("x"), size), longest))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], names=[*batch.schema.names, "leaf"])

    placed = materialise(to_workers(kept).mapInArrow(place, "row long, id long, label string, x array<long>, leaf int"), "placed")
    counts = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    shards = [-(-counts.get(i, 0) // shard_rows) for i in range(top.leaves)]
    first = np.concatenate([[0], np.cumsum(shards)]).astype(np.int64)
    own = lambda values: F.get(F.array(*(F.lit(int(v)) for v in values)), F.col("leaf"))
    shard = own(first[:-1]) + F.pmod(F.xxhash64("row", F.lit(4)), own([max(1, s) for s in shards]))
    return Index(placed.select(shard.cast("int").alias("shard"), "row", "id", "label", "x"), top, first, size, longest)


_WINDOWS = "array<struct<w:long,low:long,high:long,last:long>>"
_FOUND = "q binary, w long, score long, id long, row long"


def _sweep(index: Index, queries: DataFrame, k: int, same: bool, head: bool) -> DataFrame:
    """What each query's nearest shards hold for it, or all its other ones: ``q, w, score, id, row``."""
    spark = queries.sparkSession
    size, longest = index.size, index.longest
    router = spark.sparkContext.broadcast(Index(None, index.top, index.first_shard, size, longest))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                who, shard = router.value.route(Asked.of(part, size), head)
                for at in range(0, len(who), 1000):
                    sent = part.take(pa.array(who[at : at + 1000]))
                    yield pa.RecordBatch.from_arrays([*sent.columns, pa.array(shard[at : at + 1000].astype(np.int32))], names=[*sent.schema.names, "shard"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, shard, waiting = None, [], None, []

        def answers() -> Iterator[pa.RecordBatch]:
            nonlocal shard, waiting
            if rows and waiting:
                if shard is None:
                    table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
                    columns = (table.column(c).to_numpy(zero_copy_only=False) for c in ("row", "id"))
                    shard = Shard(matrix(table.column("x"), size), *columns, table.column("label").to_pylist(), longest)
                asks = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                for at in range(0, asks.num_rows, BLOCK):
                    block = asks.slice(at, BLOCK)
                    windows = block.column("windows").to_pylist()
                    hits = list(shard.search(Asked.of(block, size), k, same))
                    if hits:
                        who, w, *rest = zip(*hits)
                        q = block.column("q").take(pa.array(who))
                        names = [windows[i][j]["w"] for i, j in zip(who, w)]
                        yield pa.RecordBatch.from_arrays([q, *(pa.array(c, pa.int64()) for c in (names, *rest))], names=["q", "w", "score", "id", "row"])
            waiting = []

        for batch in batches:
            of, asks = batch.column("shard").to_numpy(), batch.column("asks").to_numpy()
            runs = [0, *(np.flatnonzero((np.diff(of) != 0) | (np.diff(asks) != 0)) + 1).tolist(), len(of)]
            for a, b in zip(runs, runs[1:]):
                if a == b:
                    continue
                if of[a] != number:
                    yield from answers()
                    number, rows, shard = of[a], [], None
                (waiting if asks[a] else rows).append(batch.slice(a, b - a))
                if sum(len(part) for part in waiting) >= BLOCK:
                    yield from answers()
        yield from answers()

    routed = to_workers(queries).mapInArrow(route, f"q binary, x array<long>, label string, windows {_WINDOWS}, shard int")
    none = {"q": F.lit(None).cast("binary"), "windows": F.lit(None).cast(_WINDOWS), "asks": F.lit(0)}
    asked = routed.withColumns({"row": F.lit(None).cast("long"), "id": F.lit(None).cast("long"), "asks": F.lit(1)})
    both = index.table.withColumns(none).unionByName(asked)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(tasks, "shard").sortWithinPartitions("shard", "asks")
    return to_workers(dealt).mapInArrow(search, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("q", "w").orderBy(F.desc("score"), "id", "row"))
    return found.withColumn("rank", nth).where(F.col("rank") <= k)


def nearest(index: Index, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """``q, w, score, id, row, rank`` of the best ``k`` rows of each window of ``queries`` (``q, x, label, windows``).

    The nearest shards, about the root of their number, are searched first: the
    rest are then left with the windows' upper parts, and mostly have nothing to send.
    """
    head = materialise(_sweep(index, queries, k, same, head=True), "head")
    worst = _ranked(head, k).where(F.col("rank") == k).groupBy("q")
    worst = worst.agg(F.map_from_entries(F.collect_list(F.struct("w", F.struct("score", "id")))).alias("worst"))

    def tightened(window: Column) -> Column:
        found = F.try_element_at("worst", window["w"])
        return F.struct(
            window["w"].alias("w"),
            F.coalesce(found["score"], window["low"]).alias("low"),
            window["high"].alias("high"),
            F.coalesce(found["id"], window["last"]).alias("last"),
        )

    left = queries.join(worst, "q", "left").select("q", "x", "label", F.transform("windows", tightened).alias("windows"))
    return _ranked(head.unionByName(_sweep(index, left, k, same, head=False)), k)


OUTPUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    df: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
) -> DataFrame:
    """For each anchor (a row whose id is divisible by ``every``) and each of its positives, the hardest negatives.

    Components become ``floor(256 * component)``; a row's score is its inner
    product with the anchor; ties go to the smaller id. Positives are the
    anchor's first ``positives`` other rows of its label; negatives the first
    rows of other labels that score from ``percent`` % of the positive's score
    up to that score, ``negatives`` at most (none where it is below 0). Columns:
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows with a null label or vector or a null or non-finite component take no
    part. Shorter vectors are as if followed by zeros; components beyond 2^24
    count as 2^24. A row without an id is no anchor, comes last among equal
    scores, and shows as null. Rows that share an id are rows of their own,
    as anchors too. Other columns are not read.
    """
    rows, size = rows_of(df, id_col, vector, label)
    often = max(positives + 1, negatives)
    index = build(rows, size, often)
    key = F.unhex(F.sha2(F.to_json(F.struct("x", "label")).cast("binary"), 256))
    anchors = materialise(rows.where((F.col("id") % every == 0) & (F.col("id") != NO_ID)).withColumn("q", key), "anchors")
    asked = anchors.select("q", "x", "label").dropDuplicates(["q"])

    def window(w: Column, low: Column, high: Column) -> Column:
        return F.struct(w.cast("long").alias("w"), low.cast("long").alias("low"), high.cast("long").alias("high"), F.lit(NO_ID).alias("last"))

    everything = F.array(window(F.lit(0), F.lit(-OPEN), F.lit(OPEN)))
    near = nearest(index, asked.withColumn("windows", everything), positives + 1, same=True)
    # The anchor itself may be among them, so there is one more.
    pairs = anchors.select("q", F.col("row").alias("anchor"), F.col("id").alias("anchor_id")).join(near, "q").where("row <> anchor")
    nth = F.row_number().over(Window.partitionBy("anchor").orderBy("rank"))
    pairs = pairs.withColumn("nth", nth).where(F.col("nth") <= positives)
    pairs = materialise(pairs.select("q", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # Windows by the positive's score: there are few to a query, however many anchors ask it.
    score = F.col("positive_score")
    least = F.ceil(score.cast("decimal(20,0)") * percent / 100)
    windows = pairs.where(score >= 0).select("q", "positive_score").distinct().groupBy("q").agg(F.collect_list(window(score, least, score)).alias("windows"))
    hard = nearest(index, asked.join(windows, "q"), negatives, same=False)
    known = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias(c)
    out = pairs.join(hard.select("q", F.col("w").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), ["q", "positive_score"])
    return out.select("anchor_id", known("positive_id"), F.col("rank").cast("int").alias("rank"), known("negative_id"), "positive_score", "negative_score")
