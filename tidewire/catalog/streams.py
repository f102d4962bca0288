"""Streaming queries over the given tables, run to completion with availableNow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.entities import ALIASES
from tidewire.catalog.messages import _project
from tidewire.catalog.reduction import windows_sql
from tidewire.catalog.registry import query
from tidewire.operators import reduction, sentiment, toxicity
from tidewire.sources.tables import read_table, work_folder
from tidewire.streaming import jobs


def _run(spark: SparkSession, stream: DataFrame) -> DataFrame:
    folder = work_folder(spark, "stream")
    return jobs.run_available(stream, f"{folder}/out", f"{folder}/checkpoint")


@query(
    "M01",
    """SELECT msg_id, sentiment, round(sentiment_score, 6) AS sentiment_score, round(toxicity_score, 6) AS toxicity_score
    FROM v_scores""",
)
def streamed_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, jobs.enrich_stream(jobs.stream_table(spark, folder, "documents"), _scores))


def _scores(df: DataFrame) -> DataFrame:
    scored = toxicity.score_toxicity(sentiment.score_sentiment(_project(df)))
    return scored.select(
        "msg_id", "sentiment", F.round("sentiment_score", 6).alias("sentiment_score"),
        F.round("toxicity_score", 6).alias("toxicity_score"),
    )


@query(
    "M01 S07 S08",
    """SELECT msg_id, sentiment, round(sentiment_score, 6) AS sentiment_score, round(toxicity_score, 6) AS toxicity_score,
    CASE WHEN source < 'src2' THEN 1 ELSE 2 END AS run FROM v_scores JOIN (SELECT CAST(doc_id AS VARCHAR) AS msg_id, source FROM documents) USING (msg_id)""",
)
def resumed_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over one checkpoint. Files are added between them; the second run scores those alone, and every message comes out once."""
    documents, work = read_table(spark, folder, "documents"), work_folder(spark, "resumed")
    first = F.coalesce(F.col("source") < "src2", F.lit(False))
    for run, rows in ((1, documents.filter(first)), (2, documents.filter(~first))):
        rows.write.mode("append").parquet(f"{work}/in")
        stream = jobs.enrich_stream(jobs.stream_folder(spark, f"{work}/in", documents.schema), _scores).withColumn("run", F.lit(run))
        result = jobs.run_available(stream, f"{work}/out", f"{work}/checkpoint")
    return result


@query(
    "M02",
    """SELECT pair, date, event_id, user_id, event_type, value FROM (SELECT event_id // 2 AS pair, ts AS date, event_id, user_id, event_type, value,
      row_number() OVER (PARTITION BY event_id // 2 ORDER BY ts, CAST(event_id AS VARCHAR)) AS r FROM events) WHERE r = 1""",
)
def streamed_first_per_id(spark: SparkSession, folder: str) -> DataFrame:
    """The whole earliest row of every id, from a stream that is stopped and completed."""
    events = jobs.stream_table(spark, folder, "events").select(
        F.floor(F.col("event_id") / 2).alias("pair"), F.col("ts").cast("timestamp").alias("date"), "event_id", "user_id", "event_type", "value"
    )
    job = jobs.first_per_id(spark, work_folder(spark, "first"), events, "pair", "date")
    job.run(events)
    return job.completed().withColumn("date", F.col("date").cast("timestamp_ntz"))


@query(
    "M03 A01",
    """SELECT strftime(m.date, '%Y-%m-%d') AS date, count(*) AS message_count, round_even(avg(length(m.text)), 3) AS avg_text_length,
    round_even(avg(s.sentiment_score), 3) AS avg_sentiment, round_even(avg(s.toxicity_score), 3) AS avg_toxicity, round_even(max(s.toxicity_score), 3) AS max_toxicity
    FROM v_messages m JOIN v_scores s ON s.msg_id = m.msg_id GROUP BY 1""",
)
def streamed_daily_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The daily summary from a stream, its open days completed by a batch pass."""
    events = read_table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp").alias("date"))

    def dated(documents: DataFrame) -> DataFrame:
        rows = _project(documents).withColumn("event_id", F.col("doc_id") * 5).join(events, "event_id")
        return toxicity.score_toxicity(sentiment.score_sentiment(rows)).select("msg_id", "text", "date", "sentiment_score", "toxicity_score")

    closed = _run(spark, jobs.daily_rollup(dated(jobs.stream_table(spark, folder, "documents"))))
    return jobs.completed_rollup(closed, dated(read_table(spark, folder, "documents")))


@query(
    "M04",
    f"""WITH RECURSIVE ev AS (SELECT event_id, ts, event_type AS k0 FROM events),
    {windows_sql('ev', 'k0', 'ts', 'event_id', 6 * 3600)}
    SELECT k0 AS event_type, event_id FROM ranked WHERE r <= 3""",
)
def streamed_rate_cap(spark: SparkSession, folder: str) -> DataFrame:
    """Each event type's capped rows, from a stream that is stopped and completed."""
    job = jobs.cap_rate_stream(spark, work_folder(spark, "rate"), 6 * reduction.HOUR, 3)
    job.run(jobs.rate_rows(jobs.stream_table(spark, folder, "events"), "event_type", "ts", "event_id"))
    return job.completed().select(F.col("key").alias("event_type"), F.col("row_id").alias("event_id"))


@query(
    "M05 J01",
    """SELECT d.doc_id, a.canonical, a.alias_type FROM (SELECT doc_id, lower(regexp_extract(text,
      '(Obama|Biden|Trump|CNN)')) AS mention FROM v_texts) d LEFT JOIN v_aliases a ON a.alias_key = d.mention""",
)
def streamed_lookup(spark: SparkSession, folder: str) -> DataFrame:
    documents = _project(jobs.stream_table(spark, folder, "documents"))
    mention = F.lower(F.regexp_extract("text", "(Obama|Biden|Trump|CNN)", 1))
    dictionary = spark.createDataFrame(list(ALIASES), "mention string, canonical string, alias_type string, ord int").drop("ord")
    rows = documents.select(F.col("msg_id").cast("long").alias("doc_id"), mention.alias("mention"))
    return _run(spark, jobs.with_dictionary(rows, dictionary, "mention")).select("doc_id", "canonical", "alias_type")
