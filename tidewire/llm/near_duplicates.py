"""Near-duplicate documents: banded MinHash, odd sketches and exact confirmation on shingle sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.bits import bits_set, shared_bits
from tidewire.llm.keys import boxed, row_keys, stored, unboxed
from tidewire.llm.linking import linked_classes, shared_buckets

WORDS = 5
#: MinHash bands: BANDS bands of ROWS values. A pair with Jaccard 0.75 shares no band with probability (1 - 0.75**4)**40 = 2.5e-7.
BANDS, ROWS = 40, 4
#: The odd sketch folds the minimum of each of BINS hash ranges into BITS parity bits.
BINS, BITS = 2048, 4096
#: Standard errors that a sketch may be off before a pair at the threshold is passed over.
MARGIN = 4.5
#: Rows without an id are numbered from here, by their text, so that they come after all ids.
NO_ID = 1 << 62

_U = np.uint64
_rng = np.random.default_rng(7)
_PLACES = _rng.integers(1, 1 << 63, WORDS, dtype=_U) | _U(1)
_FACTORS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=_U) | _U(1)
_SHIFTS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=_U)
_FOLDS = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=_U) | _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """64-bit hash of each word, remembered in bounded memory."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 300_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def shingle_set(text: str | None, hashes: WordHashes, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``width`` words; a shorter text is one shingle, no words give none."""
    if not text:
        return np.zeros(0, _U)
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, _U)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=_U, count=len(words))
    n = max(1, len(w) - width + 1)
    total = np.full(n, _U(min(len(w), width)))
    for j in range(min(width, len(w))):
        total += w[j : j + n] * _PLACES[j]
    return np.unique(mix(total))


def digest(s: np.ndarray) -> int:
    """64 bits that name the set."""
    return int(mix(s ^ _U(0x5DEECE66D)).sum(dtype=_U).view(np.int64))


def min_bands(s: np.ndarray) -> np.ndarray:
    """One value per band."""
    lowest = np.full(BANDS * ROWS, _U(0xFFFFFFFFFFFFFFFF))
    for part in np.array_split(s, max(1, -(-len(s) // 1024))):
        lowest = np.minimum(lowest, (part[:, None] * _FACTORS + _SHIFTS).min(axis=0))
    return mix((lowest.reshape(BANDS, ROWS) * _FOLDS).sum(axis=1, dtype=_U) + np.arange(BANDS, dtype=_U)).view(np.int64)


def odd_sketch(s: np.ndarray) -> tuple[int, bytes]:
    """The number of MinHash samples and their parity bitmap."""
    # the set is sorted, so the first hash of each range is its minimum
    samples = s[np.unique(s >> _U(64 - BINS.bit_length() + 1), return_index=True)[1]]
    parity = np.bincount((mix(samples + _U(99)) >> _U(64 - BITS.bit_length() + 1)).astype(np.int64), minlength=BITS) & 1
    return len(samples), np.packbits(parity.astype(np.uint8)).tobytes()


def signature(s: np.ndarray) -> tuple[np.ndarray, bytes, int]:
    """Bands, odd sketch and number of its samples."""
    samples, sketch = odd_sketch(s)
    return min_bands(s), sketch, samples


def most_odd_bits(n1: np.ndarray, n2: np.ndarray, c1: np.ndarray, c2: np.ndarray, similarity: float) -> np.ndarray:
    """The most differing bits that two sets of sizes ``n1, n2`` with ``c1, c2`` samples may have and still reach ``similarity``.

    At the threshold the union has (n1 + n2) / (1 + similarity) elements, which
    fill so many ranges, of which that share has the same minimum. The
    other samples differ; of D differing samples, BITS / 2 * (1 - exp(-2 D / BITS)) bits are odd.
    """
    union = (n1 + n2) / (1 + similarity)
    filled = BINS * -np.expm1(-union / BINS)
    spread = np.sqrt(filled * similarity * (1 - similarity) * (1 - filled / union) + 1)
    differing = np.maximum(c1 + c2 - 2 * (similarity * filled - MARGIN * spread), 0)
    return BITS / 2 * -np.expm1(-2 * differing / BITS) + MARGIN * np.sqrt(2 * differing**2 / BITS) + 2


def odd_sketch_slack(similarity: float, a: np.ndarray, b: np.ndarray, n1: np.ndarray, n2: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
    """How many more bits the sketches could differ in before the pair is passed over."""
    return most_odd_bits(n1, n2, c1, c2, similarity) - np.bitwise_count(a ^ b).sum(axis=1)


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        out = []
        for place, tag, text in batch.itertuples(index=False):
            s = shingle_set(text, hashes)
            if len(s):
                out.append((place, tag, len(s), digest(s), min_bands(s)))
            else:
                out.append((place, tag, 0, 0, np.zeros(0, np.int64)))
        yield pd.DataFrame(out, columns=["place", "tag", "n", "node", "buckets"])


SIGNED = "place long, tag long, n int, node long, buckets array<long>"


def _place(id_col: str, text_col: str) -> Column:
    """Where a row is found again: its id, or else a number from its text."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID) + F.pmod(F.xxhash64(text_col), F.lit(1 << 61)))


def _tag(text_col: str) -> Column:
    """Tells the texts of one place apart."""
    return F.xxhash64(F.lit(31), F.col(text_col))


def placed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``place, tag, text`` of every row."""
    return docs.select(_place(id_col, text_col).alias("place"), _tag(text_col).alias("tag"), F.col(text_col).alias("text"))


def classes_of(signed: DataFrame) -> DataFrame:
    """One row per distinct set (``node``) with its smallest place and the smallest tag there."""
    return signed.filter("n > 0").groupBy("node").agg(F.min("place").alias("place"), F.min_by("tag", F.struct("place", "tag")).alias("tag"))


def bucket_members(signed: DataFrame) -> DataFrame:
    """The classes that share buckets, from the buckets of one row of each class."""
    return shared_buckets(signed.filter("n > 0").select("node", "buckets").dropDuplicates(["node"]).select("node", F.explode("buckets").alias("bucket")))


def full_sets(texts: DataFrame, classes: DataFrame, members: DataFrame, width: int, sketched: Callable[[np.ndarray], tuple[int, bytes]], bits: int = 26) -> DataFrame:
    """``node, n, samples, sketch, shingles`` of every class that shares a bucket, from the text of its first row.

    A bitmap of fixed size picks out the rows to read again; what it passes too much goes in the join with the members.
    """
    several = members.select("node").distinct()
    slot = F.pmod(F.xxhash64("place", "tag"), F.lit(1 << bits)).alias("slot")
    shared = shared_bits(classes.join(several, "node").select(slot), "slot", bits)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, wanted = WordHashes(), np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            out, kept = [], 0
            for text in batch["text"][bits_set(wanted, batch["slot"].to_numpy())]:
                s = shingle_set(text, hashes, width)
                if len(s):
                    out.append((digest(s), len(s), *sketched(s), s.view(np.int64)))
                    kept += len(s)
                if kept >= 2_000_000:
                    yield pd.DataFrame(out, columns=_SET)
                    out, kept = [], 0
            yield pd.DataFrame(out, columns=_SET)

    sets = texts.select(slot, "text").mapInPandas(read, "node long, n int, samples int, sketch binary, shingles array<long>")
    sets = stored(sets.join(several, "node").dropDuplicates(["node"]), "sets")
    shared.destroy()
    return sets


_SET = ["node", "n", "samples", "sketch", "shingles"]


def decided(signed: DataFrame, classes: DataFrame, comps: DataFrame) -> DataFrame:
    """``place, tag, n, first, first_tag`` of every row of ``signed``, given the components ``node, comp`` of linked classes.

    Rows meet their class, and classes their component, in plain joins; a class or component with very many rows is split by the adaptive skew join.
    """
    linked = comps.join(classes.select("node", "place", "tag"), "node")
    named = linked.groupBy("comp").agg(F.min("place").alias("first"), F.min_by("tag", F.struct("place", "tag")).alias("first_tag"))
    linked = linked.select("node", "comp").join(named, "comp").select("node", "first", "first_tag")
    firsts = classes.select("node", "place", "tag").join(linked, "node", "left").select("node", F.coalesce("first", "place").alias("first"), F.coalesce("first_tag", "tag").alias("first_tag"))
    rows = signed.filter("n > 0").select("place", "tag", "n", "node").join(firsts, "node").select("place", "tag", "n", "first", "first_tag")
    return rows.unionByName(signed.filter("n = 0").select("place", "tag", "n", F.col("place").alias("first"), F.col("tag").alias("first_tag")))


def _decided(docs: DataFrame, id_col: str, text_col: str, percent: int = 75, block_rows: int = 1024) -> DataFrame:
    """``place, tag, n, first, first_tag`` for every row: its own place and tag, the size of its set, and the smallest place of its component with the smallest tag there."""
    texts = placed_texts(docs, id_col, text_col)
    signed = stored(texts.mapInPandas(_signatures, SIGNED), "signed")
    classes = stored(classes_of(signed), "classes")
    members = stored(bucket_members(signed), "members")
    sets = full_sets(texts, classes, members, WORDS, odd_sketch)
    return decided(signed, classes, linked_classes(members, sets, percent, partial(odd_sketch_slack, percent / 100), block_rows))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, block_rows: int = 1024) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles``, ``component_id`` (the smallest id of its group) and ``kept`` (it has that id, and of several texts of that id the one of smallest hash).

    Two documents are linked when their sets of five-word shingles (A-Z lower-cased) have a Jaccard similarity of ``percent`` hundredths.

    1. Equal sets are one class from here on, so copies cost one comparison in all.
    2. Classes that share a MinHash band share a bucket.
    3. Proposals within buckets pass the odd sketches: the population count of the XOR of two
       parity bitmaps tells how many samples differ. What passes is confirmed
       by exact intersection (``linking.linked_classes``).

    So a group of m near copies takes about m confirmed links, not m squared, and
    no pair that shares a bucket is given up. Full sets exist only for classes that share a bucket.

    Empty and null texts have no shingles and are linked with nothing. Rows that share an id but not a text are documents of their own. A row
    with a null id takes part but never names a component; where no row has an id, the null ids with the text of smallest hash are kept and ``component_id`` is null.
    Repeated rows get equal results. No rows give no rows. Classes are named by 64-bit digests of their sets.
    """
    def known(c: str) -> Column:
        return F.when(F.col(c) < NO_ID, F.col(c))

    rows = _decided(docs, id_col, text_col, percent, block_rows)
    return rows.select(known("place").alias(id_col), F.col("n").cast("long").alias("n_shingles"), known("first").alias("component_id"), ((F.col("first") == F.col("place")) & (F.col("first_tag") == F.col("tag"))).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, columns as they are, and one of each set of rows equal in id and text.

    Rows whose keys occur once, the usual case, are not shuffled for the latter.
    """
    gone = _decided(docs, id_col, text_col, **options).filter("first != place or first_tag != tag").select("place", "tag").distinct()
    keys = ["_k1", "_k2"]
    kept = docs.select(boxed(docs.columns), _place(id_col, text_col).alias("place"), _tag(text_col).alias("tag"), *row_keys(id_col, text_col)).join(gone, ["place", "tag"], "left_anti")
    repeated = stored(docs.select(*row_keys(id_col, text_col)).groupBy(*keys).count().filter("count > 1").select(*keys), "repeated")
    once = kept.join(repeated, keys, "left_anti")
    often = kept.join(repeated, keys, "left_semi").dropDuplicates(keys)
    return once.unionByName(often).select(*unboxed(docs.columns))
