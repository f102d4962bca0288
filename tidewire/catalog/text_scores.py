"""Sentiment and toxicity queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.messages import messages, texts
from tidewire.catalog.registry import query, view
from tidewire.functions import lexicons as lex
from tidewire.operators import rollups, sentiment, toxicity


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


def hits(words, array: str = "toks") -> str:
    return f"len(list_filter({array}, lambda x: x IN ({sql_list(words)})))"


view(
    "v_tokens",
    f"SELECT msg_id, text, {TOKENS} AS toks FROM v_texts",
)
view(
    "v_scores",
    f"""SELECT msg_id, text, toks,
    CASE WHEN p + n = 0 THEN 0.5 ELSE ((p - n)::DOUBLE / (p + n) + 1) / 2 END AS sentiment_score,
    CASE WHEN p + n = 0 THEN 'neutral'
         WHEN (p - n)::DOUBLE / (p + n) > 0.1 THEN 'positive'
         WHEN (p - n)::DOUBLE / (p + n) < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment,
    CASE WHEN p + n = 0 THEN NULL ELSE (p - n)::DOUBLE / (p + n) END AS raw,
    CASE WHEN len(toks) = 0 THEN 0.0 ELSE x::DOUBLE / len(toks) END AS toxicity_score
    FROM (SELECT *, {hits(lex.POSITIVE_WORDS)} AS p, {hits(lex.NEGATIVE_WORDS)} AS n,
                 {hits(lex.TOXIC_WORDS)} AS x FROM v_tokens)""",
)


@query(
    "T01 T04 S06",
    """SELECT msg_id, sentiment, round(sentiment_score, 6) AS sentiment_score,
    round(coalesce(raw, 0.0), 6) AS sentiment_polarity,
    round(CASE WHEN raw IS NULL THEN 0.33 ELSE sentiment_score END, 6) AS positive,
    round(CASE WHEN raw IS NULL THEN 0.34 ELSE 1 - abs(raw) END, 6) AS neutral,
    round(CASE WHEN raw IS NULL THEN 0.33 ELSE 1 - sentiment_score END, 6) AS negative
    FROM v_scores""",
)
def sentiment_scores(spark: SparkSession, folder: str) -> DataFrame:
    scored = sentiment.score_sentiment(texts(spark, folder))
    every = F.col("sentiment_all_scores")
    return scored.select(
        "msg_id",
        "sentiment",
        F.round("sentiment_score", 6).alias("sentiment_score"),
        F.round("sentiment_polarity", 6).alias("sentiment_polarity"),
        *[F.round(every[k], 6).alias(k) for k in ("positive", "neutral", "negative")],
    )


@query(
    "T05 A11",
    """SELECT sentiment, count(*) AS messages,
    round_even(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 2) AS percentage,
    round(avg(sentiment_score), 6) AS mean_score,
    CAST(sum(count(*)) OVER () AS BIGINT) AS total_messages,
    round(sum(sum(sentiment_score)) OVER () / sum(count(*)) OVER (), 6) AS overall_mean_score
    FROM v_scores GROUP BY sentiment""",
)
def sentiment_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return sentiment.sentiment_stats(sentiment.score_sentiment(texts(spark, folder)))


@query(
    "X01 X04",
    """SELECT count(*) AS total_messages,
    CAST(count(*) FILTER (toxicity_score >= 0.05) AS BIGINT) AS toxic_messages,
    round(count(*) FILTER (toxicity_score >= 0.05)::DOUBLE / count(*) * 100, 6) AS toxic_percentage,
    round(avg(toxicity_score), 6) AS avg_toxicity_score,
    round(max(toxicity_score), 6) AS max_toxicity_score, CAST(0.05 AS DOUBLE) AS toxicity_threshold
    FROM v_scores""",
)
def toxicity_statistics(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score_toxicity(texts(spark, folder), threshold=0.05)
    return toxicity.toxicity_stats(scored, threshold=0.05)


@query(
    "X05 N15 O02",
    """SELECT msg_id, date, toxicity_score, toxicity_score >= 0.5 AS is_toxic, text
    FROM v_scores JOIN (SELECT msg_id, date FROM v_messages) USING (msg_id)
    ORDER BY toxicity_score DESC, date, msg_id LIMIT 20""",
)
def most_toxic_messages(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.most_toxic(toxicity.score_toxicity(messages(spark, folder)), top_k=20)


@query(
    "A10",
    f"""SELECT msg_id, date, toxicity_score,
    array_to_string(list_sort(list_distinct(list_filter(toks, lambda x: x IN ({sql_list(lex.TOXIC_WORDS)})))), ',')
        AS toxic_words,
    CASE WHEN length(text) > 100 THEN text[1:100] || '...' ELSE text END AS message_preview
    FROM v_scores JOIN (SELECT msg_id, date FROM v_messages) USING (msg_id)
    ORDER BY toxicity_score DESC, date, msg_id LIMIT 20""",
)
def toxic_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    top = toxicity.toxic_leaderboard(toxicity.score_toxicity(messages(spark, folder)), top_k=20)
    return top.withColumn("toxic_words", F.array_join("toxic_words", ","))


def _model_scores(df: DataFrame) -> DataFrame:
    """Scores in the shape of a three-label model, derived from the lexicon; one
    message in seven has none, like a failed prediction."""
    base = sentiment.score_sentiment(df)
    s = F.col("sentiment_score")
    labels = F.array(
        *[
            F.struct(F.lit(name).alias("label"), score.alias("score"))
            for name, score in (("LABEL_0", (1 - s) * 0.9), ("Neutral", F.lit(0.46)), ("LABEL_2", s * 0.9))
        ]
    )
    none = F.length("text") % 7 == 0
    return base.withColumn("scores", F.when(~none, labels))


@query(
    "T02 T03",
    """SELECT msg_id,
    CASE WHEN length(text) % 7 = 0 THEN sentiment WHEN sentiment_score * 0.9 > 0.46 THEN 'positive'
         WHEN (1 - sentiment_score) * 0.9 > 0.46 THEN 'negative' ELSE 'neutral' END AS sentiment,
    round(CASE WHEN length(text) % 7 = 0 THEN sentiment_score
         ELSE greatest(sentiment_score * 0.9, (1 - sentiment_score) * 0.9, 0.46) END, 6) AS sentiment_score
    FROM v_scores""",
)
def sentiment_from_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    scored = sentiment.sentiment_from_scores(_model_scores(texts(spark, folder)))
    return scored.select("msg_id", "sentiment", F.round("sentiment_score", 6).alias("sentiment_score"))


@query(
    "X02 X03",
    """SELECT msg_id,
    round(CASE WHEN length(text) % 7 = 0 THEN toxicity_score ELSE least(toxicity_score * 4, 1.0) END, 6)
        AS toxicity_score,
    CASE WHEN length(text) % 7 = 0 THEN toxicity_score ELSE least(toxicity_score * 4, 1.0) END >= 0.1 AS is_toxic,
    round(1 - CASE WHEN length(text) % 7 = 0 THEN toxicity_score ELSE least(toxicity_score * 4, 1.0) END, 6)
        AS non_toxic
    FROM v_scores""",
)
def toxicity_from_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    base = toxicity.score_toxicity(texts(spark, folder))
    p = F.least(F.col("toxicity_score") * 4, F.lit(1.0))
    labels = F.array(
        F.struct(F.lit("NOT_TOXIC").alias("label"), (1 - p).alias("score")),
        F.struct(F.lit("Toxicity").alias("label"), p.alias("score")),
    )
    base = base.withColumn("scores", F.when(F.length("text") % 7 != 0, labels))
    scored = toxicity.toxicity_from_scores(base, threshold=0.1)
    return scored.select(
        "msg_id",
        F.round("toxicity_score", 6).alias("toxicity_score"),
        "is_toxic",
        F.round(F.col("toxicity_all_scores")["non_toxic"], 6).alias("non_toxic"),
    )
