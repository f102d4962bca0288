"""Corpus rollups: daily summaries, stance tables, topic shares, dataset totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewire.functions.text import unnest
from tidewire.operators.quantiles import grouped_percentile
from tidewire.sources.tables import cut_lineage

DAY = F.to_date


def summary_parts(columns: list[str]) -> dict[str, Column]:
    """The aggregates of the daily summary; parts whose columns are missing are left out."""
    parts = {
        "message_count": ("msg_id", F.count("msg_id")),
        "avg_text_length": ("text", F.bround(F.avg(F.length("text")), 3)),
        "avg_entities": ("entity_count", F.bround(F.avg("entity_count"), 3)),
        "avg_sentiment": ("sentiment_score", F.bround(F.avg("sentiment_score"), 3)),
        "avg_toxicity": ("toxicity_score", F.bround(F.avg("toxicity_score"), 3)),
        "max_toxicity": ("toxicity_score", F.bround(F.max("toxicity_score"), 3)),
        "total_links": ("total_links", F.sum("total_links")),
        "total_unique_domains": ("unique_domains", F.sum("unique_domains")),
    }
    return {k: v for k, (needs, v) in parts.items() if needs in columns}


def daily_summary(df: DataFrame) -> DataFrame:
    """One row per day."""
    present = summary_parts(df.columns)
    return (
        df.groupBy(DAY("date").alias("day")).agg(*[v.alias(k) for k, v in present.items()])
        .select(F.date_format("day", "yyyy-MM-dd").alias("date"), *present)
    )


def daily_summary_extended(df: DataFrame) -> DataFrame:
    """Posts, mean sentiment, max toxicity, distinct entities, most frequent topic
    and stance edges per day. The few columns that are read three times are worked out once."""
    day = F.col("day")
    df = cut_lineage(
        df.select(
            DAY("date").alias("day"), "sentiment_score", "toxicity_score", "stance_edge_count", "primary_topic",
            F.col("entities.text").alias("names"),
        )
    )
    base = df.groupBy(day).agg(
        F.count("*").alias("total_posts"),
        F.bround(F.avg("sentiment_score"), 3).alias("avg_sentiment"),
        F.bround(F.max("toxicity_score"), 3).alias("max_toxicity"),
        F.sum("stance_edge_count").alias("stance_edges_count"),
    )
    names = unnest(df, "names", "e", day).groupBy("day").agg(
        F.countDistinct("e").alias("unique_entities")
    )
    topics = (
        df.groupBy(day, "primary_topic").agg(F.count("*").alias("n"))
        .groupBy("day").agg(F.min_by("primary_topic", F.struct(-F.col("n"), F.col("primary_topic"))).alias("top_topic"))
    )
    return (
        base.join(names, "day", "left").join(topics, "day", "left")
        .withColumn("unique_entities", F.coalesce("unique_entities", F.lit(0)))
    )


def _stance(df: DataFrame, *keep: Column | str) -> DataFrame:
    return unnest(df, "stance_edges", "e", *keep).select(
        *[k if isinstance(k, str) else "day" for k in keep],
        F.col("e.target").alias("entity"), F.col("e.target_type").alias("entity_type"),
        F.col("e.label").alias("stance"), F.col("e.score").alias("score"),
    )


def entity_stance_counts(df: DataFrame) -> DataFrame:
    """Support and oppose edges per entity: count and mean score.

    The aggregate combines on the map side, so a very frequent entity costs one
    partial row per task, not one row per edge.
    """
    return (
        _stance(df).filter(F.col("stance").isin("support", "oppose") & (F.col("entity") != ""))
        .groupBy("entity", "stance")
        .agg(F.count("*").alias("count"), F.bround(F.avg("score"), 3).alias("avg_score"))
    )


def entity_stance_daily(df: DataFrame) -> DataFrame:
    return (
        _stance(df, DAY("date").alias("day"))
        .filter(F.col("stance").isin("support", "oppose") & (F.col("entity") != ""))
        .groupBy("day", "entity", "stance")
        .agg(F.count("*").alias("count"), F.bround(F.avg("score"), 3).alias("avg_score"))
    )


def _by_label() -> list[Column]:
    return [F.count_if(F.col("stance") == s).alias(f"{s}_count") for s in ("support", "oppose", "neutral")]


def entity_stance_wide(df: DataFrame) -> DataFrame:
    """Support / oppose / neutral counts and the 95th percentile of the score."""
    keys = ["entity", "entity_type"]
    # equal scores are counted once for all that follows
    scores = cut_lineage(_stance(df).groupBy(*keys, "stance", "score").agg(F.count("*").alias("n")))
    high = grouped_percentile(scores, keys, "score", 0.95, "p95", times="n").select(F.col("entity").alias("_e"), F.col("entity_type").alias("_t"), "p95")
    of = lambda label: F.coalesce(F.sum(F.when(F.col("stance") == label, F.col("n"))), F.lit(0)).alias(f"{label}_count")
    counts = scores.groupBy(*keys).agg(*[of(x) for x in ("support", "oppose", "neutral")], F.sum("n").alias("total_mentions"))
    both = counts.join(high, F.col("entity").eqNullSafe(F.col("_e")) & F.col("entity_type").eqNullSafe(F.col("_t")), "left")
    return both.withColumn("stance_confidence_p95", F.round("p95", 6)).drop("_e", "_t", "p95")


def entity_stance_shares(df: DataFrame) -> DataFrame:
    """Counts per day and entity with the support and oppose shares."""
    daily = _stance(df, DAY("date").alias("day")).groupBy("day", "entity").agg(*_by_label())
    total = F.col("support_count") + F.col("oppose_count") + F.col("neutral_count")
    return daily.withColumns(
        {
            "support_share": F.round(F.try_divide(F.col("support_count"), total), 6),
            "oppose_share": F.round(F.try_divide(F.col("oppose_count"), total), 6),
        }
    )


TOPIC_COLUMNS = ("top_topic_label", "ontology_topic_label", "discovery_topic_label")


def topic_of(df: DataFrame) -> Column:
    """The message's topic from whichever topic columns exist."""
    return F.coalesce(*[F.col(c) for c in TOPIC_COLUMNS if c in df.columns])


def _topic_days(df: DataFrame) -> DataFrame:
    """Topical messages per day and topic.

    The empty topic is dropped by its count, because a predicate on the topic
    would be pushed down and compute the topic a second time.
    """
    named = df.select(DAY("date").alias("day"), topic_of(df).alias("topic"))
    counts = named.groupBy("day", "topic").agg(F.count_if(F.col("topic") != "").alias("n"))
    return counts.filter("n > 0")


def topic_share_daily(df: DataFrame) -> DataFrame:
    """Messages per day and topic and their share of the day's topical messages.

    The window runs over the aggregated (day, topic) rows, not over messages.
    """
    counts = _topic_days(df).withColumnRenamed("n", "count")
    total = F.sum("count").over(W.partitionBy("day"))
    return counts.withColumn("percentage", F.bround(F.col("count") / total * 100, 2))


def topic_share_extended(df: DataFrame) -> DataFrame:
    """Topic share with the day's topic entropy and a flag for a topic's first day."""
    counts = _topic_days(df).withColumnRenamed("n", "message_count")
    day, topic = W.partitionBy("day"), W.partitionBy("topic")
    share = F.col("message_count") / F.sum("message_count").over(day)
    first = F.min("day").over(topic)
    return (
        counts.withColumn("share", share).withColumn("_first", first)
        .withColumn("topic_entropy", F.round(-F.sum(F.col("share") * F.log("share")).over(day), 6))
        .select(
            "day", F.col("topic").alias("topic_label"), "message_count",
            F.round("share", 6).alias("topic_share"), "topic_entropy",
            (F.col("day") == F.col("_first")).alias("emerging_flag"),
        )
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_messages"),
        F.countDistinct("chat_id").alias("unique_channels"),
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.round(F.avg(F.length("text")), 6).alias("avg_text_length"),
        F.count("forwarded_from").alias("has_forwarded"),
        F.count("media_type").alias("has_media") if "media_type" in df.columns else F.lit(0).cast("long").alias("has_media"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share of all non-null values."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))
    return counts.join(F.broadcast(total), F.lit(True)).select(
        F.col(column).alias("value"), "count", F.round(F.col("count") / F.col("_total"), 6).alias("share")
    )
