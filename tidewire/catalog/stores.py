"""Source, normalisation and stage queries. Exports are written from the documents
and read back through the loaders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.entities import ALIASES
from tidewire.catalog.evaluation import gold
from tidewire.catalog.messages import messages, texts
from tidewire.catalog.quotes import with_quotes
from tidewire.catalog.registry import query, view
from tidewire.catalog.stance import with_stance
from tidewire.plans import enrich
from tidewire.sources import dictionaries, stores
from tidewire.sources import messages as loader
from tidewire.sources.tables import read_table, work_folder

RAW = "seq bigint, id bigint, message string, timestamp string, sender_id string, media_type string"


def raw_export(spark: SparkSession, folder: str) -> DataFrame:
    """An untidy export: second copies, blank copies, missing ids, dates in four
    formats (one unreadable), span lists and escaped line breaks in the text."""
    docs = read_table(spark, folder, "documents")
    n = F.col("doc_id")
    day = F.expr("date_add(DATE'2024-01-01', cast(doc_id % 28 AS int))")
    stamp = (
        F.when(n % 5 == 0, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10:00:00")))
        .when(n % 5 == 1, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:00:00Z")))
        .when(n % 5 == 2, F.concat(F.date_format(day, "dd.MM.yyyy"), F.lit(" 10:00")))
        .when(n % 25 == 3, F.lit("yesterday"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    text = (
        F.when(n % 6 == 0, F.concat(F.lit('[{"type":"plain","text":"part '), n.cast("string"), F.lit('"},{"text": "two"}]')))
        .when(n % 6 == 1, F.concat(F.lit("  line\\none\\ttab "), n.cast("string"), F.lit("\n")))
        .when(n % 17 == 0, F.lit("  "))
        .otherwise(F.col("text"))
    )
    first = docs.select(
        n.alias("seq"),
        F.when(n % 40 != 39, n).alias("id"),
        text.alias("message"),
        stamp.alias("timestamp"),
        F.when(n % 3 != 0, F.col("source")).alias("sender_id"),
        F.when(n % 7 == 0, F.lit("photo")).alias("media_type"),
    )
    second = first.filter(F.col("seq") % 10 == 4).withColumns(
        {"seq": F.col("seq") + 1_000_000_000, "message": F.lit("second copy")}
    )
    return first.unionByName(second)


_DAY = "(DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER))"
view(
    "v_raw",
    f"""SELECT doc_id AS n, doc_id AS seq, CASE WHEN doc_id % 40 <> 39 THEN doc_id END AS id,
    CASE WHEN doc_id % 6 = 0 THEN 'part ' || doc_id || ' two' WHEN doc_id % 6 = 1 THEN 'line' || chr(10) || 'one' || chr(9) || 'tab ' || doc_id
      WHEN doc_id % 17 = 0 THEN '' ELSE trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) END AS text,
    CASE WHEN doc_id % 5 < 3 THEN {_DAY} + INTERVAL 10 HOUR WHEN doc_id % 25 = 3 THEN NULL ELSE {_DAY} + INTERVAL 0 HOUR END AS date,
    CASE WHEN doc_id % 3 <> 0 THEN source END AS sender, CASE WHEN doc_id % 7 = 0 THEN 'photo' END AS media_type FROM documents""",
)
view(
    "v_raw_all",
    """SELECT * FROM v_raw UNION ALL SELECT n, n + 1000000000, id, 'second copy', date, sender, media_type FROM v_raw WHERE n % 10 = 4""",
)
_NORMAL = """SELECT CAST(id AS VARCHAR) AS msg_id, text, strftime(date, '%Y-%m-%d %H:%M:%S') AS date,
    coalesce(sender, 'unknown') AS chat_id, media_type, CAST(NULL AS VARCHAR) AS forwarded_from FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS r FROM v_raw_all
      WHERE id IS NOT NULL AND date IS NOT NULL{extra}) WHERE r = 1 AND text <> ''"""


def _shown(df: DataFrame) -> DataFrame:
    return df.select(
        "msg_id", "text", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), "chat_id", "media_type", "forwarded_from"
    )


@query("S05 N01 N02 N03 N04 N05 N07 N08 N09 N10 N11", _NORMAL.format(extra=""))
def normalised_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = loader.normalise(raw_export(spark, folder), order_col="seq")
    return _shown(rows).orderBy("date")


@query(
    "N06",
    "SELECT msg_id, length(text) AS n_chars, right(text, 5) AS tail FROM (SELECT msg_id, text[1:100] AS text FROM ("
    + _NORMAL.format(extra="") + "))",
)
def truncated_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = loader.normalise(raw_export(spark, folder), order_col="seq", max_text_length=100)
    return rows.select("msg_id", F.length("text").cast("long").alias("n_chars"), F.right("text", F.lit(5)).alias("tail"))


@query(
    "N07 N09 N10",
    """SELECT (SELECT count(*) FROM v_raw_all) AS rows, (SELECT count(*) FROM v_raw_all WHERE id IS NULL) AS missing_id,
    (SELECT count(*) FROM v_raw_all WHERE id IS NOT NULL AND date IS NULL) AS bad_date,
    CAST(sum(n - 1) AS BIGINT) AS duplicate_id, count(*) FILTER (first_text = '') AS blank_text FROM (
      SELECT id, count(*) AS n, arg_min(text, seq) AS first_text FROM v_raw_all
      WHERE id IS NOT NULL AND date IS NOT NULL GROUP BY id)""",
)
def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    return loader.reject_counts(raw_export(spark, folder), order_col="seq")


@query("S02 S04", _NORMAL.format(extra=" AND NOT (n % 50 = 7 AND seq < 1000000000)"))
def jsonl_source(spark: SparkSession, folder: str) -> DataFrame:
    """JSONL export with blank lines and lines cut in the middle."""
    path = work_folder(spark, "export-jsonl")
    raw = raw_export(spark, folder)
    line = F.to_json(F.struct(*raw.columns))
    broken = (F.col("seq") % 50 == 7) & (F.col("seq") < 1_000_000_000)
    lines = raw.select(F.when(broken, F.substring(line, 1, 12)).otherwise(F.concat(line, F.lit("\n"))).alias("value"))
    lines.write.text(path)
    return _shown(loader.load_messages(spark, path, "jsonl", schema=RAW, order_col="seq"))


@query("S03 S04", _NORMAL.format(extra=""))
def csv_source(spark: SparkSession, folder: str) -> DataFrame:
    """CSV export with quoted line breaks and quotes in the text."""
    path = work_folder(spark, "export-csv")
    raw_export(spark, folder).write.option("header", True).option("escape", '"').csv(path)
    rows = loader.load_messages(spark, path, "csv", schema=RAW, order_col="seq")
    return _shown(rows)


@query("S01 S04", _NORMAL.format(extra=""))
def json_source(spark: SparkSession, folder: str) -> DataFrame:
    """JSON documents of the form {"messages": [...]}, one file per slice of 4096 ids."""
    path = work_folder(spark, "export-json")
    raw = raw_export(spark, folder)
    slices = raw.groupBy(F.floor(F.col("seq") / 4096).alias("slice")).agg(
        F.to_json(F.struct(F.collect_list(F.struct(*raw.columns)).alias("messages"))).alias("value")
    )
    slices.write.option("maxRecordsPerFile", 1).partitionBy("slice").text(path)
    schema = f"messages array<struct<{RAW.replace(' bigint', ':bigint').replace(' string', ':string')}>>"
    return _shown(loader.load_messages(spark, path, "json", schema=schema, order_col="seq"))


@query(
    "S12 S13",
    """SELECT msg_id, text, '2023-01-01 00:00:00' AS date FROM v_texts WHERE doc_id % 10 <> 9""",
)
def gold_input(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark, "gold")
    gold(with_quotes(with_stance(texts(spark, folder)))).write.json(path)
    annotated = spark.read.schema(dictionaries.GOLD_JSON).json(path)
    rows = dictionaries.gold_messages(annotated)
    return rows.select("msg_id", "text", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"))


@query("S06 S07 S08")
def staged_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    """Enrichment with two stored stages, continued from the second by a new run."""
    store = stores.StageStore(spark, work_folder(spark, "stages"))
    keep = ("data_loading", "entity_extraction", "link_extraction")
    df = messages(spark, folder)
    store.save("data_loading", df)
    enrich.enrich_in_stages(df, store, keep, aliases=ALIASES)
    done = enrich.enrich_in_stages(df, store, keep, aliases=ALIASES)
    return done.groupBy("language", "sentiment", "primary_topic").agg(
        F.count("*").alias("messages"), F.sum("span_count").alias("spans"), F.sum("entity_count").alias("entities"),
        F.sum("stance_edge_count").alias("edges"), F.sum("total_links").alias("links"),
        F.round(F.avg("formality_score"), 4).alias("formality"),
    )
