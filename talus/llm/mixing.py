"""Mixing sources to target weights by entropy balancing.

Documents get rates ``r`` that stay as close to 1 as the token constraints
allow: they minimise the relative entropy ``sum(r ln r - r + 1)`` over documents
subject to ``sum(size * r) = target`` for each source and ``0 <= r <= cap``. The
solution tilts exponentially, ``r = min(cap, exp(lambda * x))`` with the
multiplier of the document's source and ``x`` its size over the source's mean
(or any other positive column), so a source that grows repeats its long
documents first and one that shrinks gives them up first. The convex dual is
solved by Newton iterations, kept within a bracket, whose sums are distributed
aggregates over all documents. Rates are then rounded into whole copies: a hash
of the document against the rate's fraction, shifted for each source and class
of sizes until the words that the classes owe, from large to small, are met.
What a row takes follows from its own columns and one row for its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bloom import MAX_BROADCAST
from .common import discard, let, materialise, words

#: Weights of the sources by rank, repeating, as the mix's contract fixes them.
WEIGHTS = (5.0, 2.0, 1.0)
#: No document is taken more often than this, so no source exceeds it either.
CAP = 3.0
#: Newton stops when each source is this near its target, or after so many rounds.
TOLERANCE = 1e-9
ROUNDS = 60
#: Steps between 0 and 1 that the shift of a class takes.
STEPS = 2048
#: Rows that share an id and a size beyond this number are told apart by their place in the input.
ALIKE = 8
#: Sources up to this number are broadcast, a row of about 1 kB each.
MAX_SOURCES = 10_000


def token_count(text: Column) -> Column:
    """Words of a text as long; null has none."""
    return F.size(words(F.coalesce(text.cast("string"), F.lit("")))).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``source, source_size, target``: the share of all tokens each source gets.

    ``sizes`` has ``source, size``. Sources rank by code point, null last, and
    weigh ``weights`` in turn. Targets fill up to ``cap`` times the source's
    size; what is above is shared out anew by weight until none is above. That
    fixed point is the water level ``level`` with
    ``sum(min(cap * size, level * weight)) = total``, read off one sorted pass
    over the sources (one row each).
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    ranked = total.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), nth)).withColumn(
        "ceiling", F.lit(float(cap)) * F.col("source_size")
    )
    fill = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stepped = ranked.withColumn(
        "level",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)))
        / F.sum("weight").over(onward),
    )
    # Up to the level sources fill to their ceiling; past it, subtracting ceilings takes too much.
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("ceiling"), F.col("level"))).over(every)
    return stepped.withColumn("at", level).select(
        "source",
        "source_size",
        F.coalesce(F.least("ceiling", F.col("at") * F.col("weight")), F.col("ceiling")).alias("target"),
    )


def solve(levels: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """``source, source_size, target, lam``: the dual's solution for each source.

    ``levels`` has ``source, size, x, n``: how many documents share size and
    ``x``. Every round is one aggregation of it; a step that leaves the bracket
    of earlier rounds is halved into it. A source at its ceiling has no finite
    multiplier and takes the cap itself (``lam`` null), one with target 0 the
    rate 0 (``lam`` -inf).
    """
    unknown = F.lit(None).cast("double")
    state = targets.select(
        "source",
        "source_size",
        "target",
        F.when(F.col("target") >= cap * F.col("source_size") * (1 - 1e-12), unknown)
        .when(F.col("target") <= 0, F.lit(float("-inf")))
        .otherwise(F.lit(0.0))
        .alias("lam"),
        unknown.alias("low"),
        unknown.alias("high"),
    ).withColumn("open", F.col("lam").isNotNull() & (F.col("target") > 0))
    state = materialise(state, "dual")
    for _ in range(ROUNDS):
        if state.where("open").isEmpty():
            break
        multiplier = state.where("open").select(F.col("source").alias("of"), "lam")
        tilt = F.exp(F.col("lam") * F.col("x"))
        weight = F.col("n") * F.col("size")
        sums = (
            levels.join(multiplier, levels["source"].eqNullSafe(multiplier["of"]))
            .groupBy("of")
            .agg(
                F.sum(weight * F.least(F.lit(cap), tilt)).alias("got"),
                F.sum(F.when(tilt < cap, weight * F.col("x") * tilt).otherwise(0.0)).alias("slope"),
            )
        )
        gap, lam = F.col("target") - F.col("got"), F.col("lam")
        low, high = F.when(gap > 0, lam).otherwise(F.col("low")), F.when(gap < 0, lam).otherwise(F.col("high"))
        reach = F.greatest(F.lit(2.0), F.abs(lam))
        step = F.when(F.col("slope") > 0, gap / F.col("slope")).otherwise(F.signum(gap) * reach)
        newton = lam + F.greatest(-reach, F.least(reach, step))
        outside = F.coalesce(newton <= low, F.lit(False)) | F.coalesce(newton >= high, F.lit(False))
        moved = F.when(outside, F.coalesce((low + high) / 2, newton)).otherwise(newton)
        done = ~F.col("open") | (F.abs(gap) <= TOLERANCE * F.col("target"))
        last, state = state, materialise(
            state.join(sums, state["source"].eqNullSafe(sums["of"]), "left").select(
                "source",
                "source_size",
                "target",
                F.when(done, lam).otherwise(moved).alias("lam"),
                low.alias("low"),
                high.alias("high"),
                (~done).alias("open"),
            ),
            "dual",
        )
        discard(last)
    else:
        if not state.where("open").isEmpty():
            raise ValueError(f"targets are not met after {ROUNDS} rounds")
    # Sums of doubles depend on their order in the last digits; copies must not.
    steady = F.when(F.abs("lam") < float("inf"), F.format_string("%.10e", "lam").cast("double")).otherwise(F.col("lam"))
    return state.select("source", "source_size", "target", steady.alias("lam"))


def _rate(cap: float) -> Column:
    """A row's rate from ``x`` and its source's ``lam``."""
    tilted = F.round(F.least(F.lit(cap), F.exp(F.col("lam") * F.col("x"))), 9)
    return F.when(F.col("lam").isNull(), F.lit(float(cap))).otherwise(tilted)


def _class() -> Column:
    """Documents of sizes from 2^c to 2^(c+1) - 1 are class c."""
    return F.length(F.bin("size")) - 1


def _step(rate: Column) -> Column:
    """Where a row stands: it is rounded up if this is under the edge of its source and class."""
    # 52 bits of a hash, as a number from 0 to 1.
    point = F.shiftrightunsigned(F.xxhash64("doc_id", "size", "place"), 12) / float(1 << 52)
    return F.floor((point - (rate - F.floor(rate))) * STEPS).cast("int")


def _edges(rows: DataFrame, cap: float) -> DataFrame:
    """``source, edges``: the step under which each class (a map) rounds up.

    ``rows`` has ``source, size, x, lam, doc_id, place``. From the class of the
    largest documents down, the edge is put where the words rounded up come
    nearest to what the fractions of the rates ask for, the rest of the larger
    classes included. A source gathers at most 2 x STEPS steps for each class.
    """
    part = F.col("rate") - F.floor("rate")
    open_rows = rows.withColumn("rate", _rate(cap)).withColumn("part", part).where("part > 0 AND size > 0")
    stepped = open_rows.groupBy("source", _class().alias("class"), _step(F.col("rate")).alias("step")).agg(
        F.sum("size").alias("words"), F.sum(F.col("part") * F.col("size")).alias("asked")
    )
    upward = Window.partitionBy("source", "class").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = stepped.withColumn("words", F.sum("words").over(upward))
    by_class = summed.groupBy("source", "class").agg(
        F.sum("asked").alias("asked"), F.sort_array(F.collect_list(F.struct("step", "words"))).alias("steps")
    )
    by_source = by_class.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("class", "asked", "steps")), asc=False).alias("classes")
    )
    none = F.array().cast("array<struct<class:int,edge:int>>")

    def settle(acc: Column, c: Column) -> Column:
        def nearest(owed: Column) -> Column:
            under = F.filter(c["steps"], lambda s: s["words"] <= owed)
            over = F.get(c["steps"], F.size(under))
            last = F.coalesce(F.get(under, F.size(under) - 1)["words"], F.lit(0)).cast("double")
            more = F.coalesce(over["words"] - owed < owed - last, F.lit(False))
            # The edge lies right above the last step that is in: steps between have no rows.
            edge = F.when(more, over["step"] + 1).otherwise(F.coalesce(F.get(under, F.size(under) - 1)["step"] + 1, F.lit(-STEPS)))
            got = F.when(more, over["words"].cast("double")).otherwise(last)
            return F.struct(
                (owed - got).alias("owed"),
                F.concat(acc["edges"], F.array(F.struct(c["class"].alias("class"), edge.cast("int").alias("edge")))).alias("edges"),
            )

        return let(F.round(acc["owed"] + c["asked"], 3), nearest)

    edges = F.aggregate("classes", F.struct(F.lit(0.0).alias("owed"), none.alias("edges")), settle, lambda acc: acc["edges"])
    return by_source.select("source", F.map_from_entries(edges).alias("edges"))


class Mix:
    """What each row of ``docs`` takes, as a rule that needs a row's own columns and its source's."""

    def __init__(
        self,
        docs: DataFrame,
        text: str,
        id_col: str,
        source: str,
        weights: tuple[float, ...] = WEIGHTS,
        cap: float = CAP,
        x: Column | None = None,
    ) -> None:
        self.cap = cap
        self._columns = [
            F.col(id_col).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            token_count(F.col(text)).alias("size"),
            (F.lit(None) if x is None else x).cast("double").alias("given"),
            F.monotonically_increasing_id().alias("row"),
        ]
        self.sized = materialise(docs.select(*self._columns), "sizes")
        self.alike = materialise(
            self.sized.groupBy("doc_id", "size").agg(F.count("*").alias("n")).where(F.col("n") > ALIKE).drop("n"), "alike"
        )
        self._n_alike = self.alike.count()
        means = self.sized.where("size > 0").groupBy(F.col("source").alias("of")).agg(F.avg("size").alias("mean"))
        targets = source_targets(self.sized.select("source", "size"), weights, cap)
        targets = targets.join(means, targets["source"].eqNullSafe(means["of"]), "left").drop("of")
        targets = materialise(targets, "targets")
        counted = self.sized.where("size > 0").groupBy("source", "size", "given").agg(F.count("*").alias("n"))
        levels = counted.join(targets.select(F.col("source").alias("of"), "mean"), F.col("source").eqNullSafe(F.col("of")))
        levels = materialise(levels.select("source", "size", _tilt().alias("x"), "n"), "levels")
        dual = solve(levels, targets, cap)
        of_mean = targets.select(F.col("source").alias("of"), "mean")
        dual = dual.join(of_mean, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        dual = materialise(dual, "multipliers")
        self._sources = dual.count()
        edges = _edges(self._placed(self.sized, dual), cap).withColumnRenamed("source", "of")
        self.params = materialise(dual.join(edges, F.col("source").eqNullSafe(F.col("of")), "left").drop("of"), "mix")

    def _placed(self, rows: DataFrame, params: DataFrame) -> DataFrame:
        """``rows`` with ``place``, ``x`` and the columns of their source."""
        place = F.lit(0).cast("long")
        if self._n_alike:
            alike = self.alike.toDF("a_id", "a_size").withColumn("many", F.lit(True))
            alike = F.broadcast(alike) if self._n_alike <= MAX_BROADCAST else alike
            rows = rows.join(alike, F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("size") == F.col("a_size")), "left")
            place = F.when(F.col("many"), F.col("row")).otherwise(place)
        params = params.withColumnRenamed("source", "of")
        params = F.broadcast(params) if self._sources <= MAX_SOURCES else params
        joined = rows.withColumn("place", place).join(params, F.col("source").eqNullSafe(F.col("of")))
        return joined.withColumn("x", _tilt())

    def of(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have the columns of ``sized``, with ``rate`` and ``copies``."""
        rated = self._placed(rows, self.params).withColumn("rate", _rate(self.cap))
        up = (F.col("rate") > F.floor("rate")) & (_step(F.col("rate")) < F.element_at("edges", _class()))
        copies = F.floor("rate") + F.coalesce(up, F.lit(False)).cast("long")
        return rated.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(1).cast("long"))

    def taken_from(self, docs: DataFrame) -> DataFrame:
        rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), *self._columns)
        taken = self.of(rows).where("copies > 0")
        return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def _tilt() -> Column:
    """The column given to tilt along, else the size over the mean size of the source."""
    return F.coalesce(F.col("given"), F.col("size") / F.col("mean"))


def mix(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    cap: float = CAP,
    x: Column | None = None,
) -> DataFrame:
    """How often the mix takes each document.

    Returns a row for each row of ``docs``: ``doc_id, size, source_size,
    target, rate, copies, taken``. A null text has no words and an empty one
    none either; such documents meet no constraint and are taken once. Rows
    that repeat an id count one by one; a null source is a source of its own.
    Which documents are rounded up follows from a hash of id and size, whatever
    the partitions, so reruns agree; rows that share both more than ``ALIKE``
    times are told apart by their place in the input, so for them the same files
    and split sizes give the same rows. Empty tables give empty results; no
    other column is read.
    """
    made = Mix(docs, text, id_col, source, weights, cap, x)
    return made.of(made.sized).select(
        "doc_id", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def take_mix(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """``docs`` with each row repeated as often as :func:`mix` takes it (never: it goes).

    Every row is judged where it lies, so no text is shuffled. Rows that share
    an id, or have none, each get their own copies; rows without words stay
    once; all columns are kept, whatever their names.
    """
    return Mix(docs, text, id_col, source).taken_from(docs)
