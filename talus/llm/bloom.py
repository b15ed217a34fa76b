"""Blocked Bloom filters as tables, and row filters that leave long columns where they are.

A filter is a table of blocks of 512 bits; each key sets a few bits of one
block. Rows look up their key's block by a broadcast join, so the filter is
never collected on the driver and no plan carries it. The number of blocks grows
with the keys up to a bound on what is broadcast; beyond it the filter lets more
through, and the exact join behind it still decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, materialise

#: Bits of a block, bits that a key sets in it, and bits for each key.
BLOCK_BITS = 512
HASHES = 6
BITS_PER_KEY = 14
#: A block is a row of nine longs: 2^17 of them are about 10 MB, and serve five million keys.
MAX_BLOCKS = 1 << 17
#: Keys that pass a filter by mistake go to a broadcast up to this number, else to a shuffle.
MAX_BROADCAST = 100_000

LANES = [f"w{i}" for i in range(BLOCK_BITS // 64)]


def _bits(key: Column) -> Column:
    """The places in a block, of 9 bits each, that a key sets."""
    return let(
        F.xxhash64(key, F.lit(1)),
        lambda h: F.array(*(F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(HASHES))),
    )


class BlockedBloom:
    """A filter over the one column of ``keys``, nulls included."""

    def __init__(self, keys: DataFrame) -> None:
        keys = keys.toDF("key")
        need = max(1, -(-keys.count() * BITS_PER_KEY // BLOCK_BITS))
        self.blocks = min(MAX_BLOCKS, 1 << (need - 1).bit_length())
        bit = keys.select(self._block(F.col("key")).alias("block"), F.explode(_bits(F.col("key"))).alias("bit"))
        here = F.expr("shiftleft(1L, bit & 63)")
        lanes = (F.bit_or(F.when(F.shiftright("bit", 6) == i, here).otherwise(0)).alias(w) for i, w in enumerate(LANES))
        self.table = materialise(bit.groupBy("block").agg(*lanes), "bloom")

    def _block(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.blocks))

    def mark(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """``df`` with the boolean ``name``: false only where no such key was put in."""
        block, *lanes = fresh(df, "block", *LANES)
        table = F.broadcast(self.table.toDF(block, *lanes))
        set_in = let(
            F.array(*lanes),
            lambda w: F.forall(_bits(key), lambda b: F.getbit(F.get(w, F.shiftright(b, 6)), b.bitwiseAND(F.lit(63))) == 1),
        )
        joined = df.withColumn(block, self._block(key)).join(table, block, "left")
        return joined.withColumn(name, F.col(lanes[0]).isNotNull() & set_in).drop(block, *lanes)


def without(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id (null is one) is in the one column of ``ids``; exact.

    Rows that miss a Bloom filter of ``ids`` stay where they are. The ids that
    hit it by mistake are found by a join of ids alone, so no other column is
    shuffled unless there are more of them than a broadcast may hold.
    """
    hit, of, found = fresh(docs, "hit", "of", "found")
    ids = ids.toDF(of).distinct()
    bloom = BlockedBloom(ids)
    marked = bloom.mark(docs, F.col(id_col), hit)
    suspects = bloom.mark(docs.select(id_col), F.col(id_col), hit).where(hit).select(id_col).distinct()
    mistaken = materialise(suspects.join(ids, F.col(id_col).eqNullSafe(F.col(of)), "left_anti").toDF(of), "mistaken")
    count = mistaken.count()
    if not count:
        return marked.where(~F.col(hit)).drop(hit)
    if count <= MAX_BROADCAST:
        stays = F.broadcast(mistaken.withColumn(found, F.lit(True)))
        joined = marked.join(stays, F.col(id_col).eqNullSafe(F.col(of)), "left")
        return joined.where(~F.col(hit) | F.col(found)).select(*docs.columns)
    rest = marked.where(hit).join(mistaken, F.col(id_col).eqNullSafe(F.col(of)), "left_semi")
    return marked.where(~F.col(hit)).unionByName(rest).drop(hit)
