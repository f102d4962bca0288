"""Mix sources to target weights by systematic sampling of whole documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.keys import WORD, boxed, unboxed
from tidewire.sources.tables import cut_lineage


def word_count(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixture_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """Target of each row of ``sizes`` (``source``, ``source_size``).

    The sources in code point order, null last, weigh ``weights`` in turn and
    share the sum of all sizes. A target stops at ``max_repeats`` times the
    source's size, and the excess is shared again by weight among the others.
    The end of that process is a water level L with target = min(cap, weight * L);
    with the sources sorted by cap / weight, L is found from prefix sums, which
    are sums of integers and so exact. One row per source passes one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    caps = sizes.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * max_repeats).alias("_cap"))
    ratio = F.col("_cap").cast("double") / F.col("weight")
    level = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before, rest, whole = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(0, Window.unboundedFollowing), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    steps = caps.select(
        "*",
        ((F.sum("source_size").over(whole.partitionBy(F.lit(0))) - F.coalesce(F.sum("_cap").over(before), F.lit(0))).cast("double") / F.sum("weight").over(rest)).alias("_level"),
        ratio.alias("_ratio"),
        F.row_number().over(level).alias("_step"),
    )
    found = F.min_by(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level")), F.when(F.col("_level") <= F.col("_ratio"), F.col("_step")))
    every = Window.partitionBy(F.lit(0))
    return steps.select("source", "source_size", "weight", F.least(F.col("_cap").cast("double"), F.col("weight") * found.over(every)).alias("target"))


def _fraction(text: Column) -> Column:
    """A number in [0, 1) from the first six hexadecimal digits of an MD5."""
    digest = F.md5(text.cast("binary"))
    return sum(((F.instr(F.lit("0123456789abcdef"), F.substring(digest, i, 1)) - 1) / F.lit(16.0**i) for i in range(1, 7)), F.lit(0.0))


def systematic_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3, seed: int = 9,
) -> DataFrame:
    """All columns of ``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    Each document of a source has the same expected copies, target / size of the
    source, so the prefix sum at the r-th document is r times that number. One
    random offset per source is added, and a document gets one copy per integer
    that the sum passes at it. Documents are ordered by size (to an eighth of an
    octave) and then by a hash of the id, so every size class is thinned or
    repeated alike and the words taken stay near the target.

    The rank needs no global sort and no task per source: rows are numbered
    within (source, size class, two hash digits) and moved by the count of
    all earlier cells, so a source with a third of all rows is thousands of cells.

    Null text has size 0; null sources are one source, the last; a null id is an
    id like any other. Equal rows share a place in the order and are
    interchangeable. A source without words has target 0 and no copies. No rows
    give no rows. Added names begin with ``mix_``; existing columns of these
    names are replaced.
    """
    added = ("mix_size", "mix_source_size", "mix_target", "mix_copies")
    names = [c for c in docs.columns if c not in added]
    source = F.coalesce(F.concat(F.lit("="), F.col("_from")), F.lit(""))
    size = F.col("mix_size")
    bits = F.length(F.bin(size))
    rows = docs.select(boxed(docs.columns), F.col(source_col).alias("_from"), F.col(id_col).alias("_id"), word_count(F.col(text_col)).alias("mix_size"))
    cells = rows.select(
        "_row", "_id", "mix_size", source.alias("_source"),
        (bits * 16 + F.expr("shiftright(mix_size, greatest(length(bin(mix_size)) - 4, 0))")).cast("int").alias("_band"),
        F.md5(F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("~")), F.lit(f"#{seed}#"), size.cast("string")).cast("binary")).alias("_key"),
    ).withColumn("_sub", F.substring("_key", 1, 2))
    cell = ["_source", "_band", "_sub"]
    counts = cut_lineage(cells.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"), F.sum("mix_size").alias("_words")))
    earlier = Window.partitionBy("_source").orderBy("_band", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*cell, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    sizes = counts.groupBy("_source").agg(F.sum("_words").alias("source_size"))
    named = sizes.select(F.when(F.col("_source") != "", F.expr("substring(_source, 2)")).alias("source"), "source_size")
    targets = mixture_targets(named, weights, max_repeats).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_source"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
    )
    place = Window.partitionBy(*cell).orderBy("_key", "_id", "mix_size")
    offsets = offsets.join(targets, "_source")
    ranked = cells.withColumn("_r", F.row_number().over(place)).join(offsets, cell)
    expected = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    offset = _fraction(F.concat(F.col("_source"), F.lit(f"#{seed}")))
    rank = F.col("_before") + F.col("_r")
    copies = F.floor(rank * expected + offset) - F.floor((rank - 1) * expected + offset)
    return ranked.select(*unboxed(names), "mix_size", "mix_source_size", "mix_target", copies.cast("long").alias("mix_copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixture itself: each document as often as ``systematic_mix`` takes it, with the columns of ``docs``."""
    taken = systematic_mix(docs.select(boxed(docs.columns), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")), "id", "text", "source", **options)
    times = F.explode(F.array_repeat(F.lit(0), F.col("mix_copies").cast("int"))).alias("_copy")
    return taken.filter(F.col("mix_copies") > 0).select("_row", times).select(*unboxed(docs.columns))
