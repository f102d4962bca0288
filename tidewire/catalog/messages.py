"""The message views the queries run on, plus normalisation queries.

The generated documents are pseudo-words, so every document gets one realistic
phrase chosen by its number; the same view is declared for SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.registry import query, view
from tidewire.sources.tables import read_table

# Fixed test phrases, in order of doc_id % 12.
PHRASES = (
    "I love this! It's absolutely wonderful!",
    "This is terrible and disappointing.",
    'Barack Obama said: "we will win this together" and left.',
    "> the whole report was a disaster",
    "Forwarded from CNN: breaking news about the election",
    "I don't support Joe Biden on immigration and the border.",
    "We might endorse Donald Trump, perhaps.",
    "see https://www.foo.com/a,b(c)?x=1#frag",
    "news.bbc.co.uk/x or www.x.com/y).",
    "WOW!!! Maybe we can't win. Obviously this is the best plan, folks.",
    "#maga @joe why is inflation so high??",
    "Jobs report 😀 microsoft.com whitehouse.gov",
)


def _phrase(doc_id: Column) -> Column:
    return F.get(F.array(*[F.lit(p) for p in PHRASES]), (doc_id % len(PHRASES)).cast("int"))


def _project(documents: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id")
    return documents.select(
        doc_id,
        doc_id.cast("string").alias("msg_id"),
        F.col("source").alias("chat_id"),
        F.concat(F.col("text"), F.lit("\n"), _phrase(doc_id)).alias("text"),
        F.when(doc_id % len(PHRASES) == 4, F.concat(F.lit("@"), F.col("source"))).alias("forwarded_from"),
        F.col("lang").alias("lang_true"),
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Messages without date and author: no join is needed for them."""
    return _project(read_table(spark, folder, "documents")).drop("doc_id")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages with the date and author of event ``doc_id * 5``."""
    events = read_table(spark, folder, "events").select(
        F.col("event_id"), F.col("ts").alias("date"), F.col("user_id").cast("string").alias("author")
    )
    base = _project(read_table(spark, folder, "documents"))
    return base.join(events, base["doc_id"] * 5 == events["event_id"]).drop("doc_id", "event_id")


_SQL_PHRASES = ", ".join("'" + p.replace("'", "''") + "'" for p in PHRASES)
view(
    "v_texts",
    f"""SELECT CAST(doc_id AS VARCHAR) AS msg_id, doc_id, source AS chat_id,
    text || chr(10) || ([{_SQL_PHRASES}])[doc_id % 12 + 1] AS text,
    CASE WHEN doc_id % 12 = 4 THEN '@' || source END AS forwarded_from, lang AS lang_true
    FROM documents""",
)
view(
    "v_messages",
    """SELECT t.msg_id, t.doc_id, t.chat_id, t.text, t.forwarded_from, t.lang_true,
    e.ts AS date, CAST(e.user_id AS VARCHAR) AS author
    FROM v_texts t JOIN events e ON e.event_id = t.doc_id * 5""",
)
