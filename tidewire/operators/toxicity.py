"""Toxicity: lexicon scoring, model-score normalisation, statistics and leaderboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import lexicons as lex
from tidewire.functions.text import bind, col, count_in, preview, tokens


def lexicon_toxicity(text: Column | str) -> Column:
    """Share of word tokens that are in the toxic list; 0 without tokens."""
    return bind(
        tokens(text),
        lambda t: F.coalesce(
            F.try_divide(count_in(t, lex.TOXIC_WORDS).cast("double"), F.size(t).cast("double")),
            F.lit(0.0),
        ),
    )


def score_toxicity(df: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Add ``toxicity_score``, ``is_toxic`` and ``toxicity_all_scores``."""
    return df.withColumn("toxicity_score", lexicon_toxicity(text)).withColumns(
        {
            "is_toxic": F.col("toxicity_score") >= threshold,
            "toxicity_all_scores": F.create_map(
                F.lit("toxic"), F.col("toxicity_score"),
                F.lit("non_toxic"), F.lit(1.0) - F.col("toxicity_score"),
            ),
        }
    )


def canonical_toxicity_label(label: Column | str) -> Column:
    pairs = [F.lit(x) for kv in lex.TOXIC_LABELS.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(col(label))), F.lower(col(label)))


def toxicity_from_scores(df: DataFrame, scores: str = "scores", threshold: float = 0.5) -> DataFrame:
    """Use the first toxic label's score of ``array<struct<label, score>>``; rows
    without scores keep the lexicon result already present in the frame."""
    toxic = F.get(
        F.filter(F.col(scores), lambda s: F.upper(s["label"]).isin(*lex.TOXIC_SCORE_LABELS)), F.lit(0)
    )
    usable = F.size(F.coalesce(F.col(scores), F.array())) > 0
    score = F.when(usable, F.coalesce(toxic["score"].cast("double"), F.lit(0.0))).otherwise(
        F.col("toxicity_score")
    )
    all_scores = F.map_from_entries(
        F.transform(
            F.col(scores),
            lambda s: F.struct(canonical_toxicity_label(s["label"]), s["score"].cast("double")),
        )
    )
    return df.withColumns(
        {
            "toxicity_all_scores": F.when(usable, all_scores).otherwise(F.col("toxicity_all_scores")),
            "is_toxic": score >= threshold,
            "toxicity_score": score,
        }
    )


def toxicity_stats(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: messages, toxic messages and percentage, mean and max score."""
    toxic = F.sum(F.col("is_toxic").cast("long"))
    return df.agg(
        F.count("*").alias("total_messages"),
        F.coalesce(toxic, F.lit(0)).alias("toxic_messages"),
        F.round(F.coalesce(toxic / F.count("*") * 100, F.lit(0.0)), 6).alias("toxic_percentage"),
        F.round(F.coalesce(F.avg("toxicity_score"), F.lit(0.0)), 6).alias("avg_toxicity_score"),
        F.round(F.coalesce(F.max("toxicity_score"), F.lit(0.0)), 6).alias("max_toxicity_score"),
    ).withColumn("toxicity_threshold", F.lit(threshold))


def most_toxic(df: DataFrame, top_k: int = 10, order: tuple[str, ...] = ("date", "msg_id")) -> DataFrame:
    """The ``top_k`` highest scores; ties go to the earliest message.

    ``orderBy().limit()`` runs as a per-task top-k followed by a merge, so no
    task sees more than ``top_k`` rows of each other task.
    """
    wanted = ["msg_id", "date", "toxicity_score", "is_toxic", "text"]
    keep = [c for c in wanted if c in df.columns]
    return df.orderBy(F.col("toxicity_score").desc(), *order).limit(top_k).select(*keep)


def toxic_leaderboard(df: DataFrame, top_k: int = 20, text: str = "text") -> DataFrame:
    """Top messages with the matched words and a preview."""
    found = bind(
        tokens(text), lambda t: F.array_sort(F.array_distinct(F.filter(t, lambda x: x.isin(*lex.TOXIC_WORDS))))
    )
    return most_toxic(df, top_k).select(
        "msg_id",
        F.col("date"),
        "toxicity_score",
        found.alias("toxic_words"),
        preview(text).alias("message_preview"),
    )
