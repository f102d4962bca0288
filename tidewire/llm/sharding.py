"""Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.keys import boxed, unboxed
from tidewire.sources.tables import cut_lineage


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Number of good items among ``draws`` from ``good + bad``, by inversion around the mode.

    Weights come from ratios of neighbouring probabilities, which stay exact for
    any population, over twelve standard deviations to each side.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    spread = 12 * math.sqrt(draws * (good / total) * (bad / total) * (total - draws) / max(1, total - 1)) + 24
    up, weight, k = [1.0], 1.0, mode
    while k < high and k < mode + spread:
        weight *= (good - k) * (draws - k) / ((k + 1) * (bad - draws + k + 1))
        k += 1
        up.append(weight)
    down, weight, k = [], 1.0, mode
    while k > low and k > mode - spread:
        weight *= k * (bad - draws + k) / ((good - k + 1) * (draws - k + 1))
        k -= 1
        down.append(weight)
    at = rng.random() * (math.fsum(up) + math.fsum(down))
    for i, w in enumerate(up):
        at -= w
        if at < 0:
            return mode + i
    for i, w in enumerate(down):
        at -= w
        if at < 0:
            return mode - 1 - i
    return mode


def communication_matrix(blocks: Sequence[int], shards: Sequence[int], seed: int) -> list[list[int]]:
    """Rows sum to ``blocks``, columns to ``shards``; the law is that of a uniformly random permutation of all rows.

    Row by row, the block's rows are dealt to the places left in each shard.
    """
    left, matrix = list(shards), []
    for b, rows in enumerate(blocks):
        rng = random.Random(f"{seed}:{b}")
        rest, places, dealt = rows, sum(left), []
        for s, free in enumerate(left):
            n = rest if s == len(left) - 1 else hypergeometric(rng, free, places - free, rest)
            places, rest = places - free, rest - n
            dealt.append(n)
        left = [a - n for a, n in zip(left, dealt, strict=True)]
        matrix.append(dealt)
    return matrix


def _numbered_copies(docs: DataFrame, id_col: str, text_col: str, carried: Sequence[str], chunk: int) -> tuple[DataFrame, int]:
    """Rows ``_row, _id, size, text_crc32, _k1, _k2, _copy`` and their number: ``_copy`` counts equal rows from 0.

    Rows are counted before they are repeated, so a row that fills a large part
    of the table is one row of each task until then; more than ``chunk`` copies are made by several tasks.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    more = [F.to_json(F.struct(*[F.col(f"`{c}`") for c in carried]))] if carried else []
    rows = docs.select(
        boxed([id_col, *carried]), F.col(id_col).alias("_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(17), F.col(id_col), F.col(text_col), *more).alias("_k1"),
        F.xxhash64(*more, F.col(text_col), F.col(id_col), F.lit(23)).alias("_k2"),
    )
    groups = cut_lineage(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")))
    total, most = groups.agg(F.sum("_n"), F.max("_n")).first()
    if (most or 0) > chunk:
        parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / chunk))).alias("_part")
        groups = groups.select("*", parts).repartition("_k1", "_part")
    else:
        groups = groups.withColumn("_part", F.lit(0))
    start = (F.col("_part") * chunk).cast("long")
    numbers = F.sequence(start, F.least(F.col("_n"), start + chunk) - 1)
    return groups.select(*rows.columns, F.explode(numbers).alias("_copy")), total or 0


def shuffled_shards(
    docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (),
    seed: int = 4, block_rows: int = 500_000, cell_rows: int = 50_000,
) -> DataFrame:
    """Rows ``id_col, size, text_crc32, shard, slot`` (and the ``carry`` columns) of a uniform random shuffle.

    1. Equal rows are counted and numbered, and rows fall into blocks by a hash of their content and that number,
       so that a lost task gives the same rows again and copies of one row are shuffled like any others.
    2. The number of rows that each block sends to each shard is drawn exactly
       (``communication_matrix``): only one count per block reaches the driver, one per ``block_rows`` rows and at least 64.
    3. Each block is permuted (ranked by a hash) and cut at the drawn counts: that is the exchange.
    4. Each shard is permuted again by another hash; slots count from 0 without gaps. A shard is numbered
       in cells of about ``cell_rows`` rows with the counts of the earlier cells as offsets, so no shard passes one task.

    Shard sizes differ by one row at most; the first shards take the odd rows.
    ``size`` is the UTF-8 length of the text plus 8, null texts count as empty.
    Null ids are ids like any other; equal rows are interchangeable. No rows give no rows.
    """
    carried = [c for c in carry if c != id_col]
    copies, total = _numbered_copies(docs, id_col, text_col, carried, cell_rows)
    keys = [F.xxhash64(F.lit(seed * 3 + i), F.col("_k1"), F.col("_k2"), F.col("_copy")) for i in range(3)]
    n_blocks = max(64, -(-total // block_rows))
    rows = copies.select(
        "_row", "_id", "size", "text_crc32", "_copy",
        F.pmod(keys[0], F.lit(n_blocks)).cast("int").alias("_block"), keys[1].alias("_first"), keys[2].alias("_second"),
    )
    counts = {r["_block"]: r["n"] for r in rows.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()}
    capacity = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    order = sorted(counts)
    plan = []
    for block, dealt in zip(order, communication_matrix([counts[b] for b in order], capacity, seed), strict=True):
        ends, at = [], 0
        for n in dealt:
            at += n
            ends.append(at)
        plan.append({"_block": block, "_ends": ends})
    matrix = docs.sparkSession.range(1).select(F.explode(F.from_json(F.lit(json.dumps(plan)), "array<struct<_block:int,_ends:array<bigint>>>")).alias("x")).select("x.*")
    local = Window.partitionBy("_block").orderBy("_first", "_id", "text_crc32", "_copy")
    cells = 1 << max(4, math.ceil(math.log2(max(1, total / n_shards / cell_rows))))
    dealt = (
        rows.withColumn("_rank", F.row_number().over(local))
        .join(matrix, "_block")
        .withColumn("shard", F.expr("size(filter(_ends, e -> e < _rank))"))
        .withColumn("_cell", F.shiftrightunsigned("_second", 64 - int(math.log2(cells))).cast("int"))
        .drop("_block", "_ends", "_rank", "_first")
    )
    dealt = cut_lineage(dealt)
    earlier = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n")).select("shard", "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("shard", "_cell").orderBy("_second", "_id", "text_crc32", "_copy")
    return (
        dealt.withColumn("_r", F.row_number().over(inner))
        .join(offsets, ["shard", "_cell"])
        .select(*unboxed([id_col, *carried]), "size", "text_crc32", "shard", (F.col("_before") + F.col("_r") - 1).alias("slot"))
    )
