"""Overlapping intervals and greedy one-to-one matching as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import unnest
from tidewire.sources.tables import cut_lineage


def numbered_spans(df: DataFrame, array: str, name: str, *keep: str) -> DataFrame:
    """One row per element of ``array`` with its number ``name`` and the element as ``<name>_span``; empty arrays give none."""
    pairs = df.withColumn("_pairs", F.transform(array, lambda s, i: F.struct(i.cast("int").alias(name), s.alias(f"{name}_span"))))
    return unnest(pairs, "_pairs", "_e", *keep).select(*keep, f"_e.{name}", f"_e.{name}_span")


def span_overlaps(left: DataFrame, right: DataFrame, on: str, a: str, b: str, cell: int = 512) -> DataFrame:
    """Pairs of overlapping spans of one ``on``, with ``iou``, intersection over union.

    Spans meet per cell of ``cell`` offsets, so a text with thousands of spans compares neighbours
    only; a pair counts in the cell where its overlap begins. Empty spans overlap with nothing.
    """

    def cells(df: DataFrame, name: str) -> DataFrame:
        start, end = F.col(f"{name}_span.start"), F.col(f"{name}_span.end")
        covered = F.sequence(F.floor(start / cell), F.floor((end - 1) / cell))
        return df.filter(end > start).withColumn("_cell", F.explode(covered))

    both = cells(left, a).join(cells(right, b), [on, "_cell"])
    low = F.greatest(f"{a}_span.start", f"{b}_span.start")
    high = F.least(f"{a}_span.end", f"{b}_span.end")
    union = F.greatest(f"{a}_span.end", f"{b}_span.end") - F.least(f"{a}_span.start", f"{b}_span.start")
    return both.filter((low < high) & (F.floor(low / cell) == F.col("_cell"))).withColumn("iou", (high - low) / union).drop("_cell")


def greedy_pairs(pairs: DataFrame, on: str, a: str, b: str, worth: str) -> DataFrame:
    """One-to-one choice out of ``pairs``: each ``a`` in turn takes its best free ``b``, the smaller one on ties.

    In every round all ``a`` point to their best remaining ``b`` and each ``b`` holds on to the smallest ``a``; pairs that lose
    against it go. Whoever comes first in turn wins in both ways, so nothing else is chosen than one after
    the other would choose; the rounds are as many as a refusal has followers, mostly one or two.
    """
    alive = cut_lineage(pairs)
    best = F.max_by(F.struct(*[F.col(c) for c in pairs.columns]), F.struct(F.col(worth), -F.col(b)))
    while True:
        chosen = alive.groupBy(on, a).agg(best.alias("_p")).select("_p.*")
        held = chosen.groupBy(on, b).agg(F.min(a).alias("_held"))
        left = cut_lineage(alive.join(held, [on, b], "left").withColumn("_lost", F.col(a) > F.col("_held")))
        if left.filter("_lost").isEmpty():
            return chosen
        alive = left.filter(F.coalesce(~F.col("_lost"), F.lit(True))).select(*pairs.columns)


def matched_spans(df: DataFrame, pred: str, gold: str, threshold: float, on: str = "msg_id") -> DataFrame:
    """Greedy matches of two span arrays: ``on, p, g, iou, pred, gold`` with the numbers and the spans of both."""
    left, right = numbered_spans(df, pred, "p", on), numbered_spans(df, gold, "g", on)
    pairs = span_overlaps(left, right, on, "p", "g").filter(F.col("iou") >= threshold)
    return greedy_pairs(pairs, on, "p", "g", "iou").select(on, "p", "g", "iou", F.col("p_span").alias("pred"), F.col("g_span").alias("gold"))
