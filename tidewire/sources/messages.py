"""Message sources: JSON, JSONL, CSV and Parquet into one typed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.text import col, strip

MAX_TEXT_LENGTH = 8192
CORRUPT = "_corrupt_record"
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssXXX", "dd/MM/yyyy HH:mm", "dd.MM.yyyy HH:mm", "yyyy/MM/dd")
# Target column and the names it may have, first present wins.
OPTIONAL_COLUMNS = (
    ("chat_id", ("chat_id", "channel_id", "sender_id")),
    ("media_type", ("media_type",)),
    ("media_url", ("media_url",)),
    ("forwarded_from", ("forwarded_from", "forward_from")),
)


def read_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A JSON list of rows, an object with ``messages``, or one object per file.

    A document is one task's work; land very large exports as JSONL.
    """
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    df = (reader.schema(schema) if schema else reader).json(path)
    if not df.columns or df.columns == [CORRUPT]:
        raise ValueError("JSON must contain a list or an object with messages")
    if "messages" in df.columns:
        return df.select(F.inline("messages"))
    return df


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """One object per line; blank and unreadable lines are skipped.

    Pass a schema on large inputs: inferring one reads the data twice.
    """
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is None:
        schema = reader.json(path).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    fields = [f for f in schema.fields if f.name != CORRUPT]
    if not fields:
        raise ValueError("no valid records found in JSONL input")
    full = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    df = reader.schema(full).json(path)
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
    return (reader.schema(schema) if schema else reader).csv(path)


READERS = {"json": read_json, "jsonl": read_jsonl, "csv": read_csv}


def read_raw(spark: SparkSession, path: str, fmt: str = "json", schema: str | None = None) -> DataFrame:
    fmt = fmt.lower()
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt not in READERS:
        raise ValueError(f"unsupported format: {fmt}")
    return READERS[fmt](spark, path, schema)


def map_columns(df: DataFrame, text_col: str = "text", id_col: str = "msg_id", date_col: str = "date") -> DataFrame:
    """Rename the first candidate present for each contract column; extras stay."""
    required = (
        ("text", (text_col, "message", "content")),
        ("msg_id", (id_col, "id", "message_id")),
        ("date", (date_col, "timestamp", "created_at")),
    )
    chosen: dict[str, str] = {}
    for target, candidates in required:
        source = next((c for c in candidates if c in df.columns), None)
        if source is None:
            raise ValueError(f"no column for {target}: tried {', '.join(candidates)}")
        chosen[target] = source
    for target, candidates in OPTIONAL_COLUMNS:
        source = next((c for c in candidates if c in df.columns and c not in chosen.values()), None)
        if source is not None:
            chosen[target] = source
    extras = [c for c in df.columns if c not in chosen.values() and c not in chosen]
    return df.select(*[F.col(s).alias(t) for t, s in chosen.items()], *extras)


def plain_text(c: Column | str, kind: T.DataType) -> Column:
    """Text of a string, of a JSON list of spans in a string, or of a real array."""
    value = col(c)
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StructType):
            parts = F.transform(value, lambda x: x["text"])
        else:
            parts = F.transform(value, lambda x: F.coalesce(F.get_json_object(x, "$.text"), x))
        return F.array_join(parts, " ")
    text = F.coalesce(value.cast("string"), F.lit(""))
    pieces = F.regexp_extract_all(text, F.lit(r'"text":\s*"([^"]*)"'), F.lit(1))
    is_spans = text.startswith("[{") & F.contains(text, F.lit("text"))
    return F.when(is_spans & (F.size(pieces) > 0), F.array_join(pieces, " ")).otherwise(text)


def clean_message_text(text: Column, max_length: int | None) -> Column:
    """Unescape literal \\n and \\t, strip, optionally truncate."""
    clean = strip(F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t")))
    return clean if max_length is None else F.substring(clean, 1, max_length)


def parse_date(c: Column | str) -> Column:
    """Each row on its own: standard forms first, then the format list."""
    value = col(c)
    text = value.cast("string")
    return F.coalesce(value.try_cast("timestamp"), *[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS])


def _typed(df: DataFrame, max_text_length: int | None) -> DataFrame:
    kind = df.schema["text"].dataType
    defaults = {t: F.lit(None).cast("string") for t, _ in OPTIONAL_COLUMNS if t not in df.columns}
    return df.withColumns(defaults).withColumns(
        {
            "msg_id": F.col("msg_id").cast("string"),
            "text": clean_message_text(plain_text("text", kind), max_text_length),
            "date": parse_date("date"),
            "chat_id": F.coalesce(F.col("chat_id").cast("string"), F.lit("unknown")),
        }
    )


def normalise(
    df: DataFrame,
    text_col: str = "text",
    id_col: str = "msg_id",
    date_col: str = "date",
    max_text_length: int | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """Typed messages: dated rows, first row per id, then non-blank text.

    A blank first copy hides a later one, because duplicates are dropped before
    blanks. ``order_col`` gives the input order; without it, file order is used.
    The "first row" filter limits each task's output per id before the shuffle.
    """
    mapped = map_columns(df, text_col, id_col, date_col)
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    typed = _typed(mapped.withColumn("_order", order), max_text_length)
    valid = typed.filter(F.col("msg_id").isNotNull() & F.col("date").isNotNull())
    first = F.row_number().over(W.partitionBy("msg_id").orderBy("_order"))
    kept = valid.withColumn("_n", first).filter("_n = 1").filter(F.length("text") > 0)
    return kept.drop("_n", "_order")


def reject_counts(df: DataFrame, text_col: str = "text", id_col: str = "msg_id", date_col: str = "date", order_col: str | None = None) -> DataFrame:
    """How many rows normalisation drops, by reason."""
    mapped = map_columns(df, text_col, id_col, date_col)
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    typed = _typed(mapped.withColumn("_order", order), None)
    no_id, no_date = F.col("msg_id").isNull(), F.col("date").isNull()
    invalid = typed.agg(
        F.count("*").alias("rows"),
        F.count_if(no_id).alias("missing_id"),
        F.count_if(~no_id & no_date).alias("bad_date"),
    )
    per_id = typed.filter(~no_id & ~no_date).groupBy("msg_id").agg(
        F.count("*").alias("n"), F.min_by(F.length("text") == 0, "_order").alias("blank")
    )
    later = per_id.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_id"), F.count_if("blank").alias("blank_text")
    )
    return invalid.join(F.broadcast(later), F.lit(True))


def load_messages(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    text_col: str = "text",
    id_col: str = "msg_id",
    date_col: str = "date",
    max_text_length: int | None = None,
    schema: str | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """Read and normalise an export."""
    return normalise(read_raw(spark, path, fmt, schema), text_col, id_col, date_col, max_text_length, order_col)
