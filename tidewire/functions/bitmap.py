"""Membership filters of fixed size: a bitmap of hashes, broadcast in pieces and tested in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**24 bits are 2 MB whatever the number of hashes; a fuller bitmap lets more rows pass, never fewer.
BITS = 24
_FOLD = (1 << BITS) - 1


def bitmap(hashes: DataFrame, hash_col: str) -> DataFrame:
    """Rows ``piece, bits``: at most 512 pieces of 512 words each."""
    slots = hashes.select(F.col(hash_col).bitwiseAND(_FOLD).alias("b"))
    words = slots.select(F.shiftright("b", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(b & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    by_piece = words.groupBy(F.shiftright("word", 9).alias("piece")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("word").bitwiseAND(511), "bits"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(511)), lambda i: F.coalesce(F.col("m")[i], F.lit(0).cast("long")))
    return by_piece.select("piece", dense.alias("bits"))


def only_in(df: DataFrame, hash_col: str, pieces: DataFrame) -> DataFrame:
    """The rows of ``df`` whose hash may be in the bitmap: a broadcast join of 2 MB at most."""
    slot = F.col(hash_col).bitwiseAND(_FOLD)

    def test(bits: Column) -> Column:
        return F.bit_get(F.get(bits, F.shiftright(slot, 6).bitwiseAND(511).cast("int")), slot.bitwiseAND(63).cast("int")) == 1

    named = pieces.select(F.col("piece").alias("_piece"), F.col("bits").alias("_piece_bits"))
    joined = df.withColumn("_piece", F.shiftright(slot, 15).cast("int")).join(F.broadcast(named), "_piece")
    return joined.filter(test(F.col("_piece_bits"))).drop("_piece", "_piece_bits")
