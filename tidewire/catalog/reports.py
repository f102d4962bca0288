"""Report queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.entities import ALIASES, with_entities
from tidewire.catalog.messages import messages, texts
from tidewire.catalog.registry import ENTRIES, query, view
from tidewire.catalog.rollups import scored
from tidewire.functions.text import safe_divide, truncate
from tidewire.operators import entities, reports, rollups, sentiment, style, topics, toxicity
from tidewire.plans import outputs
from tidewire.sources.tables import work_folder

view("v_daily", ENTRIES["daily_summary"].sql)


@query(
    "R01 N14",
    """SELECT CAST(sum(message_count) AS BIGINT) AS total_messages,
    round(sum(avg_sentiment * message_count) / sum(message_count), 6) AS avg_sentiment,
    round(sum(avg_toxicity * message_count) / sum(message_count), 6) AS avg_toxicity,
    min(date) || ' to ' || max(date) AS date_range, count(*) AS num_days FROM v_daily
    WHERE date NOT LIKE '%-05'""",
)
def period_totals(spark: SparkSession, folder: str) -> DataFrame:
    daily = rollups.daily_summary(scored(messages(spark, folder)))
    # One day of the month carries a malformed cell and has to be skipped.
    broken = F.when(F.col("date").endswith("-05"), "n/a").otherwise(F.col("avg_sentiment").cast("string"))
    return reports.period_totals(daily.withColumn("avg_sentiment", broken))


@query(
    "R02",
    """SELECT array_to_string(list_transform(string_split(replace(primary_topic, '_', ' '), ' '),
      lambda w: upper(w[1]) || w[2:]), ' ') AS topic, count(*) AS count,
    round(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 6) AS percentage FROM v_topics GROUP BY primary_topic""",
)
def topic_report(spark: SparkSession, folder: str) -> DataFrame:
    labelled = topics.ontology_topics(texts(spark, folder))
    return reports.topic_report(labelled.groupBy("primary_topic").agg(F.count("*").alias("count")))


@query(
    "R03",
    """SELECT text AS entity, count(*) AS count, round(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 6) AS percentage
    FROM v_entities GROUP BY text""",
)
def entity_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.entity_report(entities.entity_counts(with_entities(texts(spark, folder))))


@query(
    "R04",
    """SELECT m.msg_id, toxicity_score, m.date, m.author,
    CASE WHEN length(full_text) > 100 THEN full_text[1:100] || '...' ELSE full_text END AS text_preview
    FROM (SELECT *, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS full_text FROM v_scores) s
    JOIN v_messages m ON m.msg_id = s.msg_id WHERE toxicity_score > 0 AND full_text <> ''
    ORDER BY toxicity_score DESC, m.date, m.msg_id LIMIT 50""",
)
def toxic_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.toxic_report(toxicity.score_toxicity(messages(spark, folder)))


@query(
    "R04",
    """SELECT count(*) AS total_messages, round(max(toxicity_score), 6) AS max_toxicity,
    round(avg(toxicity_score), 6) AS avg_toxicity FROM v_scores WHERE toxicity_score > 0""",
)
def toxic_report_totals(spark: SparkSession, folder: str) -> DataFrame:
    return reports.toxic_report_totals(toxicity.score_toxicity(texts(spark, folder)))


_STYLE = ("word_count", "sentence_count", "formality_score", "emoji_count")
_TITLES = {c: c.replace("_", " ").title() for c in _STYLE}


@query(
    "R05 N17",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT 'Style.avg {t}' AS feature, printf('%.3f', round(avg({c}::DOUBLE), 6)) AS value FROM v_style"
        for c, t in _TITLES.items()
    )
    + " UNION ALL SELECT 'Total Messages', CAST(count(*) AS VARCHAR) FROM v_style)",
)
def style_key_values(spark: SparkSession, folder: str) -> DataFrame:
    stats = style.style_stats(style.style_features(texts(spark, folder)))
    nested = stats.select(
        "total_messages",
        F.struct(*[F.col(f"avg_{c}").alias(f"avg_{c}") for c in _STYLE]).alias("style"),
        F.lit("1.0.0").alias("processor_version"),
    )
    rows = reports.key_value_rows(nested)
    return rows.select(F.regexp_replace("feature", r"^Style\.[Aa]vg", "Style.avg").alias("feature"), "value")


@query(
    "R06",
    """SELECT run, run_time, count(*) AS files, coalesce(run_time = max(run_time) OVER (), false) AS is_latest FROM (
      SELECT run, coalesce(CASE WHEN msg % 3 = 0 THEN make_timestamp(2024, 1, CAST(1 + msg % 7 AS BIGINT), CAST(msg % 5 AS BIGINT), 30, 0)
        WHEN msg % 3 = 1 THEN make_timestamp(2024, 2, CAST(1 + msg % 7 AS BIGINT), 12, CAST(msg % 5 AS BIGINT), 0) END) AS run_time FROM (
        SELECT doc_id AS msg, CASE WHEN doc_id % 3 = 0 THEN printf('run-202401%02d-%02d30', 1 + doc_id % 7, doc_id % 5)
          WHEN doc_id % 3 = 1 THEN printf('run_2024-02-%02d_12-%02d', 1 + doc_id % 7, doc_id % 5)
          ELSE printf('test-run-209913%02d-0000', doc_id % 5 + 1) END AS run FROM documents)) GROUP BY run, run_time""",
)
def run_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("doc_id")
    run = (
        F.when(n % 3 == 0, F.format_string("run-202401%02d-%02d30", 1 + n % 7, n % 5))
        .when(n % 3 == 1, F.format_string("run_2024-02-%02d_12-%02d", 1 + n % 7, n % 5))
        .otherwise(F.format_string("test-run-209913%02d-0000", n % 5 + 1))
    )
    paths = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.concat(F.lit("/out/"), run, F.lit("/part-0.parquet")).alias("path")
    )
    runs = reports.run_catalogue(paths)
    return runs.withColumn("run_time", F.col("run_time").cast("timestamp_ntz"))


_RUNS = ("run-20240105-0830", "run_2024-02-03_12-15")


@query(
    "R06 S06 S09 A01",
    f"""WITH m AS (SELECT *, CASE WHEN chat_id < 'src2' THEN '{_RUNS[0]}' ELSE '{_RUNS[1]}' END AS run FROM v_messages),
    r AS (SELECT run, CASE WHEN run = '{_RUNS[0]}' THEN TIMESTAMP '2024-01-05 08:30:00' ELSE TIMESTAMP '2024-02-03 12:15:00' END AS run_time, run = '{_RUNS[1]}' AS is_latest,
      count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS c, count(DISTINCT CAST(date AS DATE)) AS days FROM m GROUP BY 1)
    SELECT run, run_time, is_latest, output, CASE WHEN output = 'daily_summary.csv' THEN days WHEN output = 'totals.json' THEN 1 ELSE n END AS rows,
    CASE WHEN output = 'daily_summary.csv' THEN n ELSE c END AS total
    FROM r, (SELECT unnest(['messages.parquet', 'messages.csv', 'messages.json', 'daily_summary.csv', 'totals.json']) AS output)""",
)
def run_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs with all their files, found again by the catalogue and read back: rows and characters, for the summary days and messages."""
    root = work_folder(spark, "runs")
    rows = entities.rule_entities(toxicity.score_toxicity(sentiment.score_sentiment(messages(spark, folder))), ALIASES)
    first = F.coalesce(F.col("chat_id") < "src2", F.lit(False))
    for run, part in zip(_RUNS, (rows.filter(first), rows.filter(~first)), strict=True):
        outputs.write_run(part, root, run)
    found = outputs.list_runs(spark, root).withColumn("run_time", F.col("run_time").cast("timestamp_ntz"))
    parts = []
    for run in [r["run"] for r in found.select("run").collect()]:
        for name in (*outputs.MESSAGES, outputs.SUMMARY, outputs.TOTALS):
            measure = {outputs.SUMMARY: "sum(cast(message_count as bigint))", outputs.TOTALS: "max(characters)"}.get(name, "sum(length(text))")
            read = outputs.read_output(spark, root, run, name).agg(F.count("*").alias("rows"), F.expr(measure).alias("total"))
            parts.append(read.select(F.lit(run).alias("run"), F.lit(name).alias("output"), "rows", "total"))
    return reduce(lambda a, b: a.unionByName(b), parts).join(found.select("run", "run_time", "is_latest"), "run")


def _band_sql(value: str, limits, lowest: str) -> str:
    return "CASE " + " ".join(f"WHEN {value} >= {a} THEN '{b}'" for a, b in limits) + f" ELSE '{lowest}' END"


@query(
    "R07",
    f"""SELECT sentiment_band, toxicity_band, confidence_band, count(*) AS messages FROM (SELECT
    {_band_sql('coalesce(raw, 0.0)', reports.SENTIMENT_BANDS, 'very_negative')} AS sentiment_band,
    {_band_sql('toxicity_score', reports.TOXICITY_BANDS, 'minimal')} AS toxicity_band,
    {_band_sql('confidence', reports.CONFIDENCE_BANDS, 'very_low')} AS confidence_band
    FROM v_scores JOIN v_topics USING (msg_id)) GROUP BY ALL""",
)
def score_bands(spark: SparkSession, folder: str) -> DataFrame:
    df = topics.ontology_topics(toxicity.score_toxicity(sentiment.score_sentiment(texts(spark, folder))))
    names = ["sentiment_band", "toxicity_band", "confidence_band"]
    return reports.bands(df).groupBy(*names).agg(F.count("*").alias("messages"))


@query(
    "R07",
    f"""SELECT primary_topic, count, {_band_sql('count::DOUBLE / max(count) OVER ()', reports.RELATIVE_COUNT_BANDS, 'lowest')} AS relative_band,
    {_band_sql('count', reports.ABSOLUTE_COUNT_BANDS, 'lowest')} AS absolute_band
    FROM (SELECT primary_topic, count(*) AS count FROM v_topics GROUP BY 1)""",
)
def topic_count_bands(spark: SparkSession, folder: str) -> DataFrame:
    labelled = topics.ontology_topics(texts(spark, folder))
    return reports.count_bands(labelled.groupBy("primary_topic").agg(F.count("*").alias("count")))


@query(
    "R08",
    """SELECT event_id, CASE kind WHEN 4 THEN 'about noon' WHEN 5 THEN 'Unknown' ELSE strftime(day, '%Y-%m-%d') END AS shown,
    CASE kind WHEN 4 THEN 'about noon' WHEN 5 THEN 'Unknown' ELSE strftime(day, '%m/%d') END AS short
    FROM (SELECT event_id, event_id % 6 AS kind, CASE WHEN event_id % 6 = 3 AND day(ts) <= 12
      THEN make_date(year(ts), day(ts), month(ts)) ELSE CAST(ts AS DATE) END AS day FROM events)""",
)
def formatted_dates(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.read.parquet(f"{folder}/events.parquet")
    kind = F.col("event_id") % 6
    raw = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 2, F.date_format("ts", "MM/dd/yyyy"))
        .when(kind == 3, F.date_format("ts", "dd/MM/yyyy"))  # read month first where the day is 12 or less
        .when(kind == 4, F.lit("about noon today"))
    )
    rows = events.select("event_id", raw.alias("raw"))
    return rows.select("event_id", reports.format_date("raw").alias("shown"), reports.format_date("raw", True).alias("short"))


@query(
    "R09",
    """SELECT doc_id, CASE WHEN length(text) <= 50 THEN text ELSE text[1:47] || '...' END AS short_text,
    coalesce(round(n_chars::DOUBLE / nullif(doc_id % 4, 0), 6), -1.0) AS ratio FROM documents""",
)
def truncated_texts(spark: SparkSession, folder: str) -> DataFrame:
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return documents.select(
        "doc_id", truncate("text", 50).alias("short_text"),
        F.round(safe_divide("n_chars", F.col("doc_id") % 4, -1.0), 6).alias("ratio"),
    )
