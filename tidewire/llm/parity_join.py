"""N-gram Jaccard join by parity sketches: pigeonhole blocks per size band, Hamming bound, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.keys import stored
from tidewire.llm.linking import linked_classes, shared_buckets
from tidewire.llm.near_duplicates import NO_ID, SIGNED, WordHashes, bucket_members, classes_of, decided, digest, full_sets, mix, placed_texts, shingle_set

WORDS = 4
#: Bits of a block of the wide sketch, as a power of two.
BLOCK_BITS = 16
#: Bits of the narrow sketch, which is compared as a whole, of sets of up to so many elements.
NARROW = ((1000, 1024), (4000, 4096), (16_000, 16_384), (1 << 62, 65_536))

_U = np.uint64


@lru_cache(maxsize=None)
def band_starts(percent: int, top: int = 1 << 40) -> tuple[int, ...]:
    """Smallest set size of each band, half as large again as the last: a set may be linked with one of the next band only where ``reaches_next``."""
    starts = [1]
    while starts[-1] < top:
        starts.append(max(starts[-1] + 1, starts[-1] * 3 // 2, (starts[-1] - 1) * 100 // percent + 1))
    return tuple(starts)


def reaches_next(size: int, band: int, percent: int) -> bool:
    return size * 100 // percent >= band_starts(percent)[band + 1]


def most_differing(total: int | np.ndarray, percent: int) -> int | np.ndarray:
    """The largest symmetric difference of linked sets whose sizes add up to ``total``."""
    return total * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def band_blocks(band: int, percent: int) -> tuple[int, int]:
    """Number of blocks for pairs whose larger set is in ``band``, and how many of them are spare.

    Of d + 1 + spare blocks at least spare + 1 are equal in a linked pair, because each element of
    the symmetric difference flips one bit and so changes one block. Sets of a band without difference are
    linked only when equal, and need no blocks.
    """
    d = most_differing(2 * (band_starts(percent)[band + 1] - 1), percent)
    spare = 2 + d // 8
    return (d + 1 + spare, spare) if d else (0, 0)


def block_keys(s: np.ndarray, band: int, percent: int) -> tuple[np.ndarray, int]:
    """One key per block of the set's parity sketch for ``band``, and how many of them a linked set shares at least.

    Equal blocks have equal keys. The sketch has one run of 2**BLOCK_BITS bits per
    block. A key is the XOR of one number per odd bit; elements on the same bit
    cancel out in the key as they do in the sketch. Empty blocks, which many sets
    share, are left out while they are no more than the spare ones: one of the shared blocks then is not
    empty. No more blocks can be equal and empty than one of the two sets has empty ones. The last bit of a key is that of the band.
    """
    blocks, spare = band_blocks(band, percent)
    if not blocks:
        return np.zeros(0, _U), 1
    # the set is sorted, so the elements of a block are consecutive
    block = ((s >> _U(32)) * _U(blocks)) >> _U(32)
    bits = mix((block << _U(BLOCK_BITS)) | (s & _U((1 << BLOCK_BITS) - 1)))
    first = np.flatnonzero(np.diff(block, prepend=_U(1 << 63)))
    keys, owner = np.bitwise_xor.reduceat(bits, first), block[first]
    odd = keys != 0
    keys, owner = keys[odd], owner[odd]
    empty = blocks - len(keys)
    if empty > spare:
        none = np.setdiff1d(np.arange(blocks, dtype=_U), owner)
        keys, owner = np.concatenate([keys, np.zeros(len(none), _U)]), np.concatenate([owner, none])
    keys = mix(keys + mix(owner + _U(band << 40)))
    return (keys & ~_U(1)) | _U(band & 1), max(spare + 1 - empty, 1)


def buckets_of(s: np.ndarray, percent: int) -> tuple[np.ndarray, int, int]:
    """Keys of the set's own band and, where a larger set of the next one may be linked with it, of that; the least shared keys of even and of odd bands."""
    own = int(np.searchsorted(band_starts(percent), len(s), side="right")) - 1
    bands = [own, own + 1] if reaches_next(len(s), own, percent) else [own]
    keys, least = zip(*[block_keys(s, band, percent) for band in bands], strict=True)
    even_odd = {band & 1: n for band, n in zip(bands, least, strict=True)}
    return np.concatenate(keys).view(np.int64), even_odd.get(0, 1), even_odd.get(1, 1)


def parity_sketch(s: np.ndarray) -> tuple[int, bytes]:
    """The set's size, and one bit per hash value, flipped by each element: two sketches, the longer one folded, differ in no more bits than the sets in elements."""
    bits = next(b for most, b in NARROW if len(s) <= most)
    odd = np.bincount((mix(s + _U(3)) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return len(s), np.packbits(odd.astype(np.uint8)).tobytes()


def hamming_slack(percent: int, a: np.ndarray, b: np.ndarray, n1: np.ndarray, n2: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
    """How many more bits the sketches may differ in; below 0 the symmetric difference is surely too large."""
    return most_differing(n1.astype(np.int64) + n2, percent) - np.bitwise_count(a ^ b).sum(axis=1).astype(np.int64)


def _signed(percent: int):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out, kept = [], 0
            for place, tag, text in batch.itertuples(index=False):
                s = shingle_set(text, hashes, WORDS)
                out.append((place, tag, len(s), digest(s), *buckets_of(s, percent)) if len(s) else (place, tag, 0, 0, np.zeros(0, np.int64), 1, 1))
                kept += len(s)
                if kept >= 2_000_000:
                    yield pd.DataFrame(out, columns=_SIGNED)
                    out, kept = [], 0
            yield pd.DataFrame(out, columns=_SIGNED)

    return read


_SIGNED = ["place", "tag", "n", "node", "buckets", "even", "odd"]


def _with_enough(members: DataFrame, signed: DataFrame) -> DataFrame:
    """Members without the nodes that share too few buckets of a band for any link, and without the buckets that this leaves with one node."""
    side = F.col("bucket").bitwiseAND(1)
    shared = members.groupBy("node", side.alias("side")).agg(F.count(F.lit(1)).alias("_n"))
    least = signed.filter("n > 0").groupBy("node").agg(F.first("even").alias("even"), F.first("odd").alias("odd"))
    enough = shared.join(least, "node").filter(F.col("_n") >= F.when(F.col("side") == 0, F.col("even")).otherwise(F.col("odd"))).select("node", "side")
    return shared_buckets(members.select("bucket", "node", side.alias("side")).join(enough, ["node", "side"]).select("bucket", "node"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, block_rows: int = 1024) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``, the smallest id that can be reached by links.

    Two documents are linked when their sets of four-word shingles (A-Z lower-cased) have a Jaccard similarity of at least ``percent`` hundredths.

    1. Equal sets are one class.
    2. Sets of similar size share a band. Each set is folded into a parity sketch of
       more blocks than a linked pair may differ in elements, so any linked pair has
       equal blocks: the blocks are the join keys, and a set that shares fewer of them than
       any linked one must is out. No linked pair is missed.
    3. Sets that share a block compare narrow parity sketches, whose Hamming
       distance never exceeds the symmetric difference, so what it refutes is refuted for sure.
    4. What remains is confirmed on full sets, first with the smallest class of each bucket, then between the components left in a bucket.

    A set of n shingles has about n / 3 keys. Empty and null texts have no shingles and are linked with nothing. Rows that
    share an id but not a text are documents of their own; repeated rows get equal results. A row with a null id takes part
    but never names a component unless no row of it has an id; its ``component_id`` is then null. Other columns of
    ``docs`` are ignored, whatever their names. No rows give no rows. Sets are told apart by 64-bit hashes of their shingles.
    """
    texts = placed_texts(docs, id_col, text_col)
    signed = stored(texts.mapInPandas(_signed(percent), SIGNED + ", even int, odd int"), "signed")
    classes = stored(classes_of(signed), "classes")
    members = stored(_with_enough(stored(bucket_members(signed), "buckets"), signed), "members")
    sets = full_sets(texts, classes, members, WORDS, parity_sketch)
    comps = linked_classes(members, sets, percent, partial(hamming_slack, percent), block_rows)

    def known(c: str) -> Column:
        return F.when(F.col(c) < NO_ID, F.col(c))

    rows = decided(signed, classes, comps)
    return rows.select(known("place").alias(id_col), F.col("n").cast("long").alias("n_shingles"), known("first").alias("component_id"))
