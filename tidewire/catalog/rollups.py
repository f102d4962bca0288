"""Corpus rollups over the enriched messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.entities import with_entities
from tidewire.catalog.messages import messages, texts
from tidewire.catalog.registry import query, view
from tidewire.catalog.stance import with_stance
from tidewire.operators import entities, links, rollups, sentiment, stance, topics, toxicity

view(
    "v_dated_edges",
    "SELECT CAST(m.date AS DATE) AS day, e.* FROM v_edges e JOIN v_messages m ON m.msg_id = e.msg_id",
)
view(
    "v_dated_topics",
    """SELECT CAST(m.date AS DATE) AS day, t.primary_topic AS topic FROM v_topics t JOIN v_messages m ON m.msg_id = t.msg_id""",
)


def scored(df: DataFrame) -> DataFrame:
    df = entities.entity_summary(with_entities(df))
    return links.link_columns(toxicity.score_toxicity(sentiment.score_sentiment(df)))


@query(
    "A01 A12 N02 N05 N10",
    """SELECT strftime(m.date, '%Y-%m-%d') AS date, count(*) AS message_count,
    round_even(avg(length(m.text)), 3) AS avg_text_length, round_even(avg(coalesce(e.n, 0)), 3) AS avg_entities,
    round_even(avg(s.sentiment_score), 3) AS avg_sentiment, round_even(avg(s.toxicity_score), 3) AS avg_toxicity,
    round_even(max(s.toxicity_score), 3) AS max_toxicity,
    CAST(sum(coalesce(l.total_links, 0)) AS BIGINT) AS total_links,
    CAST(sum(coalesce(l.unique_domains, 0)) AS BIGINT) AS total_unique_domains
    FROM v_messages m JOIN v_scores s ON s.msg_id = m.msg_id
    LEFT JOIN (SELECT msg_id, count(*) AS n FROM v_entities GROUP BY msg_id) e ON e.msg_id = m.msg_id
    LEFT JOIN v_link_stats l ON l.msg_id = m.msg_id GROUP BY 1""",
)
def daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.daily_summary(scored(messages(spark, folder)))


@query(
    "A02 O01",
    """SELECT target AS entity, label AS stance, count(*) AS count, round_even(avg(score), 3) AS avg_score
    FROM v_edges WHERE label IN ('support', 'oppose') GROUP BY ALL""",
)
def entity_stance_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.entity_stance_counts(with_stance(texts(spark, folder))).orderBy("entity", F.desc("count"))


@query(
    "A03",
    """SELECT day, target AS entity, label AS stance, count(*) AS count, round_even(avg(score), 3) AS avg_score
    FROM v_dated_edges WHERE label IN ('support', 'oppose') GROUP BY ALL""",
)
def entity_stance_daily(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.entity_stance_daily(with_stance(messages(spark, folder)))


@query(
    "A04 W01 N13",
    """SELECT day, topic, count(*) AS count,
    round_even(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY day) * 100, 2) AS percentage
    FROM v_dated_topics GROUP BY day, topic""",
)
def topic_share_daily(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.topic_share_daily(topics.ontology_topics(messages(spark, folder)))


@query(
    "A05",
    """SELECT count(*) AS total_messages, count(DISTINCT chat_id) AS unique_channels, min(date) AS start_date,
    max(date) AS end_date, round(avg(length(text)), 6) AS avg_text_length, count(forwarded_from) AS has_forwarded,
    CAST(0 AS BIGINT) AS has_media FROM v_messages""",
)
def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.dataset_summary(messages(spark, folder))


@query(
    "A06",
    """SELECT target AS entity, target_type AS entity_type, count(*) FILTER (label = 'support') AS support_count,
    count(*) FILTER (label = 'oppose') AS oppose_count, count(*) FILTER (label = 'neutral') AS neutral_count,
    count(*) AS total_mentions, round(quantile_cont(score, 0.95), 6) AS stance_confidence_p95
    FROM v_edges GROUP BY ALL""",
)
def entity_stance_wide(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.entity_stance_wide(with_stance(texts(spark, folder)))


@query(
    "A07",
    """SELECT day, target AS entity, count(*) FILTER (label = 'support') AS support_count,
    count(*) FILTER (label = 'oppose') AS oppose_count, count(*) FILTER (label = 'neutral') AS neutral_count,
    round(count(*) FILTER (label = 'support')::DOUBLE / count(*), 6) AS support_share,
    round(count(*) FILTER (label = 'oppose')::DOUBLE / count(*), 6) AS oppose_share FROM v_dated_edges GROUP BY ALL""",
)
def entity_stance_shares(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.entity_stance_shares(with_stance(messages(spark, folder)))


@query(
    "A08",
    """SELECT day, topic AS topic_label, n AS message_count, round(share, 6) AS topic_share,
    round(-sum(share * ln(share)) OVER (PARTITION BY day), 6) AS topic_entropy,
    day = min(day) OVER (PARTITION BY topic) AS emerging_flag FROM (
      SELECT day, topic, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY day) AS share
      FROM v_dated_topics GROUP BY day, topic)""",
)
def topic_share_extended(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.topic_share_extended(topics.ontology_topics(messages(spark, folder)))


@query(
    "A09",
    """SELECT CAST(m.date AS DATE) AS day, count(*) AS total_posts, round_even(avg(s.sentiment_score), 3) AS avg_sentiment,
    round_even(max(s.toxicity_score), 3) AS max_toxicity, CAST(sum(coalesce(g.n, 0)) AS BIGINT) AS stance_edges_count,
    any_value(e.unique_entities) AS unique_entities, any_value(p.topic) AS top_topic
    FROM v_messages m JOIN v_scores s ON s.msg_id = m.msg_id
    LEFT JOIN (SELECT msg_id, count(*) AS n FROM v_edges GROUP BY msg_id) g ON g.msg_id = m.msg_id
    LEFT JOIN (SELECT CAST(x.date AS DATE) AS day, count(DISTINCT y.text) AS unique_entities
               FROM v_entities y JOIN v_messages x ON x.msg_id = y.msg_id GROUP BY 1) e ON e.day = CAST(m.date AS DATE)
    LEFT JOIN (SELECT day, topic, row_number() OVER (PARTITION BY day ORDER BY count(*) DESC, topic) AS r
               FROM v_dated_topics GROUP BY day, topic) p ON p.day = CAST(m.date AS DATE) AND p.r = 1
    GROUP BY 1""",
)
def daily_summary_extended(spark: SparkSession, folder: str) -> DataFrame:
    df = with_stance(messages(spark, folder))
    df = topics.ontology_topics(toxicity.score_toxicity(sentiment.score_sentiment(df)))
    return rollups.daily_summary_extended(df)


@query(
    "A11",
    """SELECT chat_id AS value, count(*) AS count, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share
    FROM v_texts GROUP BY chat_id""",
)
def channel_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.value_counts(texts(spark, folder), "chat_id")


@query(
    "U02 U03 J05",
    """SELECT chat_id, count(*) FILTER (msg_id IN (SELECT msg_id FROM v_edges)) AS with_stance,
    count(*) FILTER (msg_id NOT IN (SELECT msg_id FROM v_edges)) AS without_stance FROM v_texts GROUP BY chat_id""",
)
def stance_coverage(spark: SparkSession, folder: str) -> DataFrame:
    df = with_stance(texts(spark, folder))
    edges = stance.stance_rows(df, "msg_id")
    base = texts(spark, folder).select("msg_id", "chat_id")
    hit = base.join(edges.select("msg_id"), "msg_id", "left_semi").withColumn("hit", F.lit(True))
    miss = base.join(edges.select("msg_id"), "msg_id", "left_anti").withColumn("hit", F.lit(False))
    return hit.unionByName(miss).groupBy("chat_id").agg(
        F.count_if("hit").alias("with_stance"), F.count_if(~F.col("hit")).alias("without_stance")
    )
