"""Bitmaps of fixed size that Spark puts together and Python workers look things up in."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared_bits(slots: DataFrame, slot_col: str, bits: int) -> Broadcast:
    """Broadcast bitmap of 2**bits bits with the slots of ``slots`` set; its pieces of 4 KB are aggregated in Spark.

    Its size does not depend on the input. The caller destroys it.
    """
    at = F.col(slot_col).cast("long") + 1
    pieces = slots.groupBy(F.bitmap_bucket_number(at).alias("_piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")).collect()
    whole = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in pieces:
        start = (r["_piece"] - 1) * 4096
        whole[start : start + 4096] = np.frombuffer(r["_bits"], dtype=np.uint8)
    return slots.sparkSession.sparkContext.broadcast(whole.tobytes())


def bits_set(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which of ``slots`` are set in the bytes ``bits``."""
    slots = slots.astype(np.int64)
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 > 0
