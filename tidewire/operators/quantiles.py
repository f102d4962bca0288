"""Exact percentiles per group without holding a group."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def grouped_percentile(df: DataFrame, keys: list[str], value: str, share: float, name: str, low: float = 0.0, high: float = 1.0, bins: int = 1024, times: str | None = None) -> DataFrame:
    """Keys and ``name``: the ``share`` percentile of ``value``, interpolated between the two ranks around it; null values do not count.

    Equal values are counted first, before the shuffle. A histogram per group, of
    ``bins`` rows between ``low`` and ``high`` and one beyond either end, tells which bins hold the
    ranks; only the values of these are put in order, a small part of a large
    group. Any limits give the right result; close ones keep the bins small. A row counts as often as its column ``times`` says.
    """
    if not 0 <= share <= 1 or not math.isfinite(low) or not low < high:
        raise ValueError("share from 0 to 1 and finite limits expected")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg((F.sum(times) if times else F.count(F.lit(1))).alias("_n"))
    spot = F.floor((F.col("_v") - low) * (bins / (high - low)))
    counts = counts.withColumn("_bin", F.greatest(F.lit(-1), F.least(F.lit(bins), spot)))
    before = W.partitionBy(*keys).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    binned = counts.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_in"))
    binned = binned.withColumns({"_before": F.coalesce(F.sum("_in").over(before), F.lit(0)), "_rank": (F.sum("_in").over(W.partitionBy(*keys)) - 1) * share})
    first, second = F.floor("_rank"), F.ceil("_rank")
    holds = [(F.col("_before") <= r) & (r < F.col("_before") + F.col("_in")) for r in (first, second)]
    wanted = binned.filter(holds[0] | holds[1]).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bin").alias("_b"), "_before", "_rank")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    near = counts.join(wanted, [*same, F.col("_bin") == F.col("_b")]).select(*keys, "_bin", "_v", "_n", "_before", "_rank")
    upto = W.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = near.withColumn("_upto", F.col("_before") + F.sum("_n").over(upto))
    ends = placed.groupBy(*keys).agg(
        F.first("_rank").alias("_rank"),
        *[F.min(F.when(F.col("_upto") > r, F.col("_v"))).alias(c) for r, c in ((first, "_low"), (second, "_high"))],
    )
    return ends.select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_rank") - first)).alias(name))
