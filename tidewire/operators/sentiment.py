"""Sentiment: lexicon scoring, model-score normalisation and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import lexicons as lex
from tidewire.functions.text import bind, col, count_in, tokens


def lexicon_polarity(text: Column | str) -> Column:
    """(positive - negative) / (positive + negative) over word tokens, null without hits."""
    hits = bind(
        tokens(text),
        lambda t: F.struct(
            count_in(t, lex.POSITIVE_WORDS).alias("pos"),
            count_in(t, lex.NEGATIVE_WORDS).alias("neg"),
        ),
    )
    return bind(
        hits,
        lambda h: F.try_divide(
            (h["pos"] - h["neg"]).cast("double"), (h["pos"] + h["neg"]).cast("double")
        ),
    )


def _label(raw: Column) -> Column:
    return (
        F.when(raw > 0.1, "positive").when(raw < -0.1, "negative").otherwise("neutral")
    )


def score_sentiment(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``sentiment``, ``sentiment_label``, ``sentiment_score``, ``sentiment_all_scores``
    and ``sentiment_polarity``.

    The score lies in [0, 1] with 0.5 as neutral; the polarity is the same
    quantity in [-1, 1], which is what the report bands expect.
    """
    raw = F.col("_polarity")
    score = F.coalesce((raw + 1) / 2, F.lit(0.5))
    scored = F.create_map(
        F.lit("positive"), score,
        F.lit("neutral"), F.lit(1.0) - F.abs(raw),
        F.lit("negative"), F.lit(1.0) - score,
    )
    unscored = F.create_map(
        F.lit("positive"), F.lit(0.33), F.lit("neutral"), F.lit(0.34), F.lit("negative"), F.lit(0.33)
    )
    return (
        df.withColumn("_polarity", lexicon_polarity(text))
        .withColumns(
            {
                "sentiment": _label(raw),
                "sentiment_label": _label(raw),
                "sentiment_score": score,
                "sentiment_all_scores": F.when(raw.isNull(), unscored).otherwise(scored),
                "sentiment_polarity": F.coalesce(raw, F.lit(0.0)),
            }
        )
        .drop("_polarity")
    )


def canonical_sentiment_label(label: Column | str) -> Column:
    """Map model label names to positive / neutral / negative; others are lower-cased."""
    pairs = [F.lit(x) for kv in lex.SENTIMENT_LABELS.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(col(label))), F.lower(col(label)))


def sentiment_from_scores(df: DataFrame, scores: str = "scores") -> DataFrame:
    """Take the best of ``array<struct<label, score>>`` per row; rows without
    scores keep the lexicon result already present in the frame."""
    best = F.array_max(F.transform(F.col(scores), lambda s: F.struct(s["score"].alias("score"), s["label"].alias("label"))))
    label = canonical_sentiment_label(best["label"])
    usable = F.size(F.coalesce(F.col(scores), F.array())) > 0
    all_scores = F.map_from_entries(
        F.transform(
            F.col(scores),
            lambda s: F.struct(canonical_sentiment_label(s["label"]), s["score"].cast("double")),
        )
    )
    return df.withColumns(
        {
            "sentiment": F.when(usable, label).otherwise(F.col("sentiment")),
            "sentiment_label": F.when(usable, label).otherwise(F.col("sentiment")),
            "sentiment_score": F.when(usable, best["score"].cast("double")).otherwise(F.col("sentiment_score")),
            "sentiment_all_scores": F.when(usable, all_scores).otherwise(F.col("sentiment_all_scores")),
        }
    )


def sentiment_stats(df: DataFrame) -> DataFrame:
    """Messages, share in percent and mean score per label, with totals on each row."""
    per_label = df.groupBy("sentiment").agg(
        F.count("*").alias("messages"), F.sum("sentiment_score").alias("_sum")
    )
    total = per_label.agg(
        F.sum("messages").alias("total_messages"), F.sum("_sum").alias("_total_sum")
    )
    # `total` is one row, so this join is a scalar lookup.
    return per_label.join(F.broadcast(total), F.lit(True)).select(
        "sentiment",
        "messages",
        F.bround(F.col("messages") / F.col("total_messages") * 100, 2).alias("percentage"),
        F.round(F.col("_sum") / F.col("messages"), 6).alias("mean_score"),
        "total_messages",
        F.round(F.col("_total_sum") / F.col("total_messages"), 6).alias("overall_mean_score"),
    )
