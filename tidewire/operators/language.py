"""Language of a message from character-trigram profiles.

Profiles are learnt from labelled text and hold a fixed number of trigrams per
language, so the joined side has a known bound whatever the corpus size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewire.functions.text import col, strip

MIN_LENGTH = 10
PROFILE_SIZE = 300


def trigrams(text: Column | str) -> Column:
    """Overlapping three-character pieces of the lower-cased text."""
    return F.regexp_extract_all(F.lower(col(text)), F.lit("(?s)(?=(.{3}))"), F.lit(1))


def learn_profiles(df: DataFrame, lang: str, text: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """(lang, gram, log_p) for the ``size`` most frequent trigrams per language.

    Ranking uses a window limit, which keeps at most ``size`` rows per language
    and task before the shuffle. ``log_p`` is the add-one log share among them,
    and ``log_floor`` what any other trigram counts.
    """
    counts = df.select(F.col(lang).alias("lang"), F.explode(trigrams(text)).alias("gram")).groupBy(
        "lang", "gram"
    ).agg(F.count("*").alias("n"))
    rank = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = counts.withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= size)
    total = F.sum("n").over(W.partitionBy("lang")) + size
    return kept.select(
        "lang", "gram",
        F.log((F.col("n") + 1) / total).alias("log_p"),
        F.log(1.0 / total).alias("log_floor"),
    )


def save_profiles(profiles: DataFrame, path: str) -> DataFrame:
    """Write learnt profiles and read them back.

    A stored table has a known size, so Spark checks it against the broadcast
    threshold before choosing the join; the learning job is not repeated either.
    """
    profiles.coalesce(1).write.mode("overwrite").parquet(path)
    return profiles.sparkSession.read.parquet(path)


def _scorer(profiles: DataFrame) -> Callable[..., Column]:
    """An Arrow function of the lower-cased text: the best language and its score.

    The profiles hold a fixed number of trigrams per language, so they travel with the function.
    """
    weights: dict[str, list[tuple[str, float]]] = {}
    floors: dict[str, float] = {}
    for lang, gram, log_p, floor in profiles.select("lang", "gram", "log_p", "log_floor").collect():
        weights.setdefault(gram, []).append((lang, log_p - floor))
        floors[lang] = max(floor, floors.get(lang, floor))

    def best(text: str | None) -> tuple[str, float] | None:
        if text is None:
            return None
        scores: dict[str, float] = {}
        for gram, n in Counter(map("".join, zip(text, text[1:], text[2:]))).items():
            for lang, w in weights.get(gram, ()):
                scores[lang] = scores.get(lang, 0.0) + n * w
        if not scores:
            return None
        score, lang = min((-(w + (len(text) - 2) * floors[lang]), lang) for lang, w in scores.items())
        return lang, -score

    @F.pandas_udf("struct<language string, score double>")
    def detect(texts: pd.Series) -> pd.DataFrame:
        found = [best(t) or (None, None) for t in texts]
        return pd.DataFrame(found, columns=["language", "score"]).astype({"score": "float64"})

    return detect


def detect_language(df: DataFrame, profiles: DataFrame, key: str = "msg_id", text: str = "text") -> DataFrame:
    """(key, language, score) per message; ``unknown`` for short or unmatched text.

    A message's score for a language is the sum over its trigrams of
    log_p - log_floor, plus the floor for each trigram, which is the
    log-likelihood. Only languages with a trigram in the profile count. The
    trigrams meet the profiles, ``PROFILE_SIZE`` rows per language, in a broadcast join; a task adds them up before the
    shuffle, which gets one short row per message and language.
    """
    usable = F.length(strip(F.coalesce(F.col(text), F.lit("")))) > MIN_LENGTH
    grams = df.filter(usable).select(F.col(key).alias("_key"), F.length(text).alias("_n"), F.explode(trigrams(text)).alias("gram"))
    near = grams.join(F.broadcast(profiles.select("lang", "gram", "log_p", "log_floor")), "gram")
    scores = near.groupBy("_key", "lang").agg((F.sum(F.col("log_p") - F.col("log_floor")) + (F.max("_n") - 2) * F.max("log_floor")).alias("score"))
    best = scores.groupBy("_key").agg(F.max("score").alias("top"), F.min_by("lang", F.struct(-F.col("score"), F.col("lang"))).alias("lang"))
    named = df.select(F.col(key)).join(best, F.col(key) == F.col("_key"), "left")
    return named.select(key, F.coalesce("lang", F.lit("unknown")).alias("language"), F.col("top").alias("language_score"))


def cross_detected(df: DataFrame, lang: str, side: Column, store: Callable[[DataFrame], DataFrame], key: str = "msg_id", text: str = "text") -> DataFrame:
    """Languages of all messages by profiles of others: either ``side`` is scored by what was learnt on the other one."""
    sides = [df.filter(side), df.filter(~side)]
    return detect_language(sides[0], store(learn_profiles(sides[1], lang, text)), key, text).unionByName(
        detect_language(sides[1], store(learn_profiles(sides[0], lang, text)), key, text)
    )


def add_language(df: DataFrame, profiles: DataFrame | None, text: str = "text") -> DataFrame:
    """Add ``language``; without profiles every message is ``unknown``."""
    if profiles is None:
        return df.withColumn("language", F.lit("unknown"))
    usable = F.when(F.length(strip(F.coalesce(F.col(text), F.lit("")))) > MIN_LENGTH, F.lower(F.col(text)))
    return df.withColumn("language", F.coalesce(_scorer(profiles)(usable).getField("language"), F.lit("unknown")))


def language_distribution(df: DataFrame, top_k: int = 5) -> DataFrame:
    return df.groupBy("language").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "language").limit(top_k)


def confusion(df: DataFrame, truth: str, predicted: str = "language") -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("count"))
