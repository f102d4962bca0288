"""Benchmark decontamination with spaced seeds: overlaps are found although single words were replaced."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.keys import boxed, row_keys, stored, unboxed

#: Everything that is not a letter, a mark or a digit parts words.
SEPARATOR = r"[^\p{L}\p{M}\p{N}]+"


def seed_masks(window: int, substitutions: int) -> list[list[int]]:
    """Selected positions of each mask, first 0.

    The window is cut into ``substitutions + 2`` blocks; that many replaced words
    leave two blocks whole, so the masks of any two blocks, moved to their first
    position, find every window that the rule accepts.
    """
    blocks = substitutions + 2
    edges = [window * i // blocks for i in range(blocks + 1)]
    shapes = set()
    for a, b in combinations(range(blocks), 2):
        spots = [*range(edges[a], edges[a + 1]), *range(edges[b], edges[b + 1])]
        shapes.add(tuple(s - spots[0] for s in spots))
    return [list(s) for s in sorted(shapes)]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), SEPARATOR), "")


def _hash(mask_no: int, mask: list[int]) -> Column:
    """Hash of the selected words at ``_p``; null where the mask leaves the text."""
    parts = [F.get("_w", F.col("_p") + i) for i in mask]
    return F.when(F.col("_p") + (mask[-1] + 1) <= F.col("_len"), F.xxhash64(F.lit(mask_no), *parts))


def _around(window: int, mask: list[int]) -> Column:
    """The words of all windows that hold the whole mask, null beyond the text's ends."""
    span = mask[-1] + 1
    return F.transform(F.sequence(F.lit(span - window), F.lit(window - 1)), lambda i: F.get("_w", F.col("_p") + i))


def _positions(df: DataFrame, keep: list[str], text_col: str, shortest: int, window: int) -> DataFrame:
    """One row per word position with the words of the text alongside; the outer form avoids a second split for an inferred filter."""
    return _places(df.select(*keep, _words(F.col(text_col)).alias("_w")), keep, shortest, window)


def _places(words: DataFrame, keep: list[str], shortest: int, window: int) -> DataFrame:
    spots = F.when(F.size("_w") >= window, F.sequence(F.lit(0), F.size("_w") - shortest))
    return words.select(*keep, "_w", F.size("_w").alias("_len"), F.explode_outer(spots).alias("_p")).filter("_p is not null")


#: A filter has this many bits for each hash, as long as it stays below 2**MOST_BITS (32 MB), in pieces of 2**PIECE_BITS bits.
BITS_A_HASH, MOST_BITS, PIECE_BITS = 32, 28, 15
#: Bits that a hash sets in its piece.
PROBES = 3
#: A hash that more document positions propose is salted.
HOT = 1000


def _spots(hash_col: str) -> list[Column]:
    """The bits of a hash within its piece, from its low bits; the piece comes from the high ones."""
    return [F.shiftright(hash_col, PIECE_BITS * i).bitwiseAND((1 << PIECE_BITS) - 1).cast("int") for i in range(PROBES)]


def _filter_of(hashes: DataFrame, bits: int) -> tuple[DataFrame, int]:
    """Rows ``piece, bits`` of a Bloom filter of 2**bits bits over the column ``h``, written once, and ``bits``."""
    words = 1 << bits - 6
    set_bits = hashes.select(_piece("h", bits).alias("piece"), F.explode(F.array(*_spots("h"))).alias("b"))
    set_bits = set_bits.select(
        (F.col("piece") * (1 << PIECE_BITS - 6) + F.shiftright("b", 6)).alias("word"), F.expr("shiftleft(1L, b & 63)").alias("bit"),
    )
    every = hashes.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bit"))
    filled = set_bits.unionByName(every).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    # pieces of 512 words, so that the broadcast has few rows
    pieces = filled.groupBy(F.shiftright("word", PIECE_BITS - 6).alias("piece")).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w"))
    return stored(pieces.select("piece", F.col("w.bits").alias("bits")), "filter"), bits


def _piece(hash_col: str, bits: int) -> Column:
    return F.shiftrightunsigned(hash_col, 64 - (bits - PIECE_BITS)).cast("int")


def _flagged(df: DataFrame, hash_col: str, made: tuple[DataFrame, int], name: str) -> DataFrame:
    """Add ``name``: whether the filter may hold the hash, never null. The filter is broadcast."""
    pieces, bits = made
    named = pieces.select(F.col("piece").alias(f"_at{name}"), F.col("bits").alias(f"_of{name}"))
    hit = F.lit(True)
    for spot in _spots(hash_col):
        hit = hit & (F.bit_get(F.get(f"_of{name}", F.shiftright(spot, 6)), spot.bitwiseAND(63)) == 1)
    joined = df.withColumn(f"_at{name}", _piece(hash_col, bits)).join(F.broadcast(named), f"_at{name}", "left")
    return joined.withColumn(name, F.coalesce(hit, F.lit(False))).drop(f"_at{name}", f"_of{name}")


def _bits_for(n: int, least: int) -> int:
    return max(least, min(MOST_BITS, (n * BITS_A_HASH).bit_length()))


def _overlapping_texts(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, window: int, substitutions: int, filter_bits: int, salts: int) -> DataFrame:
    """Rows ``_k1, _k2, c1, c2, equal_words``: every document row and benchmark text that overlap; ``items`` has the words ``_w`` of each text ``c1, c2`` once."""
    masks = seed_masks(window, substitutions)
    shortest = min(m[-1] + 1 for m in masks)
    least = max(filter_bits, PIECE_BITS + 1)

    n = (items.agg(F.sum(F.size("_w") - (shortest - 1))).first()[0] or 0) * len(masks)
    # a small file is read by one task, but its seeds are many
    places = _places(items.repartition(n // 100_000 + 1, "c1", "c2"), ["c1", "c2"], shortest, window)
    hashes = places.select(F.explode(F.array(*[_hash(i, m) for i, m in enumerate(masks)])).alias("h")).filter("h is not null")
    known = _filter_of(hashes, _bits_for(n, least))

    spots = _positions(docs.select(*row_keys(id_col, text_col), F.col(text_col).alias("_text")), ["_k1", "_k2"], "_text", shortest, window)
    spots = spots.select("*", *[_hash(i, m).alias(f"_h{i}") for i, m in enumerate(masks)])
    for i in range(len(masks)):
        spots = _flagged(spots, f"_h{i}", known, f"_b{i}")
    likely = spots.filter(" or ".join(f"_b{i}" for i in range(len(masks))))
    proposals = likely.select("_k1", "_k2", F.explode(F.array(*[F.when(F.col(f"_b{i}"), F.struct(F.col(f"_h{i}").alias("h"), _around(window, m).alias("words"))) for i, m in enumerate(masks)])).alias("s")).filter("s is not null").select("_k1", "_k2", "s.*")
    proposals = stored(proposals, "proposals")

    met = proposals.groupBy("h").count()
    met_n, hot_n = met.agg(F.count(F.lit(1)), F.count_if(F.col("count") > HOT)).first()
    wanted = _filter_of(met.select("h"), _bits_for(met_n, least))
    hot = _filter_of(met.filter(F.col("count") > HOT).select("h"), _bits_for(hot_n, PIECE_BITS + 1))
    # both sides ask the same filter, so a hash that it holds by mistake still meets itself
    left = _flagged(proposals, "h", hot, "_hot").withColumn("_salt", F.when(F.col("_hot"), F.pmod("_k1", F.lit(salts)).cast("int")).otherwise(0))
    seeds = places.select("c1", "c2", F.explode(F.array(*[F.struct(_hash(i, m).alias("h"), _around(window, m).alias("item_words")) for i, m in enumerate(masks)])).alias("s")).select("c1", "c2", "s.*").filter("h is not null")
    seeds = _flagged(_flagged(seeds, "h", wanted, "_met").filter("_met"), "h", hot, "_hot")
    right = seeds.withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    # merged, because Spark would judge the seeds by the size of the file of items and broadcast them
    pairs = left.select("_k1", "_k2", "h", "words", "_salt").join(right.hint("merge"), ["h", "_salt"]).select("_k1", "_k2", "c1", "c2", F.arrays_zip("words", "item_words").alias("z"))
    # 1: equal, 0: replaced, null: beyond the end of one of the texts
    flags = F.transform("z", lambda x: F.when(x["words"].isNotNull() & x["item_words"].isNotNull(), (x["words"] == x["item_words"]).cast("int")))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("f") - (window - 1)), lambda i: F.aggregate(F.slice("f", i, window), F.lit(0), lambda a, x: a + x)))
    checked = pairs.select("_k1", "_k2", "c1", "c2", flags.alias("f")).select("_k1", "_k2", "c1", "c2", best.alias("equal_words"))
    return checked.groupBy("_k1", "_k2", "c1", "c2").agg(F.max("equal_words").alias("equal_words")).filter(F.col("equal_words") >= window - substitutions)


def _overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 12, substitutions: int = 2, filter_bits: int = 24, salts: int = 16,
) -> tuple[DataFrame, DataFrame]:
    """``_overlapping_texts``, and the ids ``c1, c2, item_id`` of each text, which items of equal words share."""
    words = benchmark.select(F.col(item_col).alias("item_id"), _words(F.col(item_text_col)).alias("_w"))
    named = words.select("item_id", "_w", F.xxhash64(F.lit(17), F.col("_w")).alias("c1"), F.xxhash64(F.col("_w"), F.lit(23)).alias("c2"))
    named = stored(named.filter(F.size("_w") >= window), "items")
    items = stored(named.select("c1", "c2", "_w").dropDuplicates(["c1", "c2"]), "item-texts")
    return _overlapping_texts(docs, items, id_col, text_col, window, substitutions, filter_bits, salts), named.select("c1", "c2", "item_id").distinct()


def spaced_seed_overlaps(docs: DataFrame, benchmark: DataFrame, *columns: str, **options) -> DataFrame:
    """Rows ``_k1, _k2`` (see ``row_keys``), ``item_id, equal_words``: every document row and benchmark item that overlap.

    They overlap when ``window`` consecutive words of each, laid side by side,
    differ in at most ``substitutions`` places; ``equal_words`` is the best count over such windows.
    Seeds only propose: each proposal is checked on the words around it, which travel with the hit,
    so the documents are read once and their texts never shuffled.

    Before the join, document hashes pass a Bloom filter of the benchmark's hashes. It has ``2**filter_bits`` bits, or
    more for a large benchmark, up to 32 MB, and is broadcast in pieces of 4 KB; false positives
    fall at the join. Items of equal words are compared as one, and only seeds that a document proposes
    are joined. Passages that many documents share make hot hashes; the rows of these carry a salt on both sides of the join.
    """
    found, ids = _overlaps(docs, benchmark, *columns, **options)
    return found.join(ids, ["c1", "c2"]).groupBy("_k1", "_k2", "item_id").agg(F.max("equal_words").alias("equal_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: the id, ``contaminated``, ``n_items``, ``first_item`` and ``equal_words`` (null where clean).

    Null and empty texts, and texts or items of fewer words than the window, overlap with nothing. Items with a null id count as one item.
    Repeated rows get equal results; an empty benchmark leaves every row clean.
    """
    found = spaced_seed_overlaps(docs, benchmark, id_col, text_col, **options).groupBy("_k1", "_k2").agg(
        F.count(F.lit(1)).alias("n_items"), F.min("item_id").alias("first_item"), F.max("equal_words").cast("long").alias("equal_words"),
    )
    rows = docs.select(F.col(id_col), *row_keys(id_col, text_col))
    return rows.join(found, ["_k1", "_k2"], "left").select(
        id_col, F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), "first_item", "equal_words",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, columns as they are."""
    found = _overlaps(docs, benchmark, id_col, text_col, **options)[0].select("_k1", "_k2").distinct()
    return docs.select(boxed(docs.columns), *row_keys(id_col, text_col)).join(found, ["_k1", "_k2"], "left_anti").select(*unboxed(docs.columns))
