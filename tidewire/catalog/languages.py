"""Language queries; profiles are learnt from the labelled documents themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.messages import texts
from tidewire.catalog.registry import query, view
from tidewire.operators import language
from tidewire.sources.tables import work_folder

view(
    "v_grams",
    """SELECT msg_id, lang_true, length(text) AS n, unnest(list_transform(range(1, len(c) - 1),
    lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram
    FROM (SELECT msg_id, lang_true, text, string_split(lower(text), '') AS c FROM v_texts)""",
)
view(
    "v_profile",
    """SELECT lang, gram, ln((n + 1)::DOUBLE / total) AS log_p, ln(1.0 / total) AS log_floor FROM (
    SELECT *, sum(n) OVER (PARTITION BY lang) + 300 AS total FROM (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS r FROM (
        SELECT lang_true AS lang, gram, count(*) AS n FROM v_grams GROUP BY ALL)) WHERE r <= 300)""",
)
view(
    "v_cross_language",
    """SELECT t.msg_id, t.lang_true, coalesce(b.lang, 'unknown') AS language FROM v_texts t LEFT JOIN (
    SELECT msg_id, lang, row_number() OVER (PARTITION BY msg_id ORDER BY score DESC, lang) AS r FROM (
      SELECT msg_id, lang, sum(log_p - log_floor) + any_value(n - 2) * any_value(log_floor) AS score FROM (
        SELECT *, md5(msg_id) < '8' AS side FROM v_grams) g JOIN (
        SELECT NOT side AS side, lang, gram, ln((n + 1)::DOUBLE / total) AS log_p, ln(1.0 / total) AS log_floor FROM (
          SELECT *, sum(n) OVER (PARTITION BY side, lang) + 300 AS total FROM (
            SELECT *, row_number() OVER (PARTITION BY side, lang ORDER BY n DESC, gram) AS r FROM (
              SELECT md5(msg_id) < '8' AS side, lang_true AS lang, gram, count(*) AS n FROM v_grams GROUP BY ALL)) WHERE r <= 300)) USING (side, gram) GROUP BY msg_id, lang)) b
    ON b.msg_id = t.msg_id AND r = 1""",
)
view(
    "v_language",
    """SELECT t.msg_id, t.lang_true, coalesce(b.lang, 'unknown') AS language, b.score FROM v_texts t LEFT JOIN (
    SELECT msg_id, lang, score, row_number() OVER (PARTITION BY msg_id ORDER BY score DESC, lang) AS r FROM (
      SELECT msg_id, lang, sum(log_p - log_floor) + any_value(n - 2) * any_value(log_floor) AS score
      FROM v_grams JOIN v_profile USING (gram) GROUP BY msg_id, lang)) b ON b.msg_id = t.msg_id AND r = 1""",
)


def detected(df: DataFrame) -> DataFrame:
    learnt = language.learn_profiles(df, "lang_true")
    stored = language.save_profiles(learnt, work_folder(df.sparkSession, "language-profiles"))
    return language.detect_language(df, stored)


@query("L01", "SELECT msg_id, language, round(score, 4) AS language_score FROM v_language")
def message_languages(spark: SparkSession, folder: str) -> DataFrame:
    return detected(texts(spark, folder)).withColumn("language_score", F.round("language_score", 4))


@query(
    "L02",
    "SELECT language, count(*) AS count FROM v_language GROUP BY language ORDER BY count DESC, language LIMIT 5",
)
def language_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_distribution(detected(texts(spark, folder)))


@query("L03", "SELECT lang_true AS truth, language AS predicted, count(*) AS count FROM v_cross_language GROUP BY ALL")
def language_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """Every message is scored by profiles that were learnt without it."""
    df = texts(spark, folder)

    def store(profiles: DataFrame) -> DataFrame:
        return language.save_profiles(profiles, work_folder(spark, "language-profiles"))

    found = language.cross_detected(df, "lang_true", F.md5(F.col("msg_id").cast("binary")) < "8", store)
    return language.confusion(df.select("msg_id", "lang_true").join(found, "msg_id"), "lang_true")
