"""Report tables: period totals, shares, leader lists, bands, run catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import band, col, first_present, preview, strip

SENTIMENT_BANDS = ((0.3, "very_positive"), (0.1, "positive"), (-0.1, "neutral"), (-0.3, "negative"))
TOXICITY_BANDS = ((0.8, "severe"), (0.6, "high"), (0.4, "medium"), (0.2, "low"))
CONFIDENCE_BANDS = ((0.8, "very_high"), (0.6, "high"), (0.4, "medium"), (0.2, "low"))
RELATIVE_COUNT_BANDS = ((0.8, "top"), (0.6, "high"), (0.4, "medium"), (0.2, "low"))
ABSOLUTE_COUNT_BANDS = ((100, "top"), (50, "high"), (20, "medium"), (5, "low"))
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy")


def numeric_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast the columns to double and drop rows where one of them is not a number."""
    cast = df.withColumns({c: F.col(c).try_cast("double") for c in columns})
    return cast.dropna(subset=columns)


def period_totals(daily: DataFrame) -> DataFrame:
    """Message-weighted means over daily rows, the date range and number of days."""
    rows = numeric_rows(daily, ["message_count", "avg_sentiment", "avg_toxicity", "max_toxicity"])
    n = F.floor("message_count")

    def weighted(c: str) -> Column:
        return F.round(F.coalesce(F.try_divide(F.sum(F.col(c) * n), F.sum(n)), F.lit(0.0)), 6)

    first, last = F.min("date"), F.max("date")
    return rows.agg(
        F.sum(n).cast("long").alias("total_messages"),
        weighted("avg_sentiment").alias("avg_sentiment"),
        weighted("avg_toxicity").alias("avg_toxicity"),
        F.when(first == last, first).otherwise(F.concat(first, F.lit(" to "), last)).alias("date_range"),
        F.count("*").alias("num_days"),
    )


def topic_report(distribution: DataFrame) -> DataFrame:
    """Title-cased topics with counts and share of all messages, from (primary_topic, count)."""
    total = distribution.agg(F.sum("count").alias("_total"))
    return distribution.join(F.broadcast(total), F.lit(True)).select(
        F.initcap(F.replace("primary_topic", F.lit("_"), F.lit(" "))).alias("topic"),
        "count",
        F.round(F.col("count") / F.col("_total") * 100, 6).alias("percentage"),
    )


def entity_report(counts: DataFrame) -> DataFrame:
    """Trimmed entities with a positive count and their share of all mentions."""
    clean = counts.select(strip("entity").alias("entity"), F.col("count").try_cast("long").alias("count")).filter(
        "entity <> '' AND count > 0"
    )
    total = clean.agg(F.sum("count").alias("_total"))
    return clean.join(F.broadcast(total), F.lit(True)).select(
        "entity", "count", F.round(F.col("count") / F.col("_total") * 100, 6).alias("percentage")
    )


def toxic_report(df: DataFrame, top_k: int = 50) -> DataFrame:
    """Highest scores above zero with an id from whichever id column exists."""
    ids = [F.col(c).cast("string") for c in ("msg_id", "message_id", "id") if c in df.columns]
    author = F.col("author") if "author" in df.columns else F.lit(None).cast("string")
    rows = df.select(
        first_present(*ids).alias("msg_id"),
        F.col("toxicity_score").try_cast("double").alias("toxicity_score"),
        "date",
        F.coalesce(author, F.lit("Unknown")).alias("author"),
        strip("text").alias("full_text"),
    ).filter("toxicity_score > 0 AND full_text <> ''")
    return rows.orderBy(F.desc("toxicity_score"), "date", "msg_id").limit(top_k).select(
        "msg_id", "toxicity_score", "date", "author", preview("full_text").alias("text_preview")
    )


def toxic_report_totals(df: DataFrame) -> DataFrame:
    return df.filter((F.col("toxicity_score") > 0) & (F.length(strip("text")) > 0)).agg(
        F.count("*").alias("total_messages"),
        F.round(F.coalesce(F.max("toxicity_score"), F.lit(0.0)), 6).alias("max_toxicity"),
        F.round(F.coalesce(F.avg("toxicity_score"), F.lit(0.0)), 6).alias("avg_toxicity"),
    )


def key_value_rows(df: DataFrame, skip: tuple[str, ...] = ("extraction_date", "processor_version", "channel_name")) -> DataFrame:
    """Flatten one wide row of statistics into (feature, value, raw_value).

    Nested structs become dotted names; names are shown in title case, fractions
    with three decimals.
    """

    def leaves(schema, prefix: str = "") -> list[tuple[str, str]]:
        found = []
        for field in schema.fields:
            name = f"{prefix}{field.name}"
            if field.dataType.typeName() == "struct":
                found += leaves(field.dataType, name + ".")
            elif field.dataType.typeName() in ("double", "float", "integer", "long", "string", "short"):
                found.append((name, field.dataType.typeName()))
        return found

    def entry(name: str, kind: str) -> Column:
        value = F.col(name)
        shown = F.format_string("%.3f", value.cast("double")) if kind in ("double", "float") else value.cast("string")
        title = F.initcap(F.replace(F.lit(name), F.lit("_"), F.lit(" ")))
        return F.struct(title.alias("feature"), shown.alias("value"), value.cast("string").alias("raw_value"))

    entries = [entry(n, k) for n, k in leaves(df.schema) if n not in skip]
    return df.select(F.inline(F.array(*entries)))


def run_catalogue(paths: DataFrame, path: str = "path") -> DataFrame:
    """Run name and timestamp parsed from file paths, with a flag for the newest run.

    Names carry ``yyyyMMdd-HHmm`` or ``yyyy-MM-dd_HH-mm``.
    """
    name = F.regexp_extract(path, r"([^/]*(?:\d{8}-\d{4}|\d{4}-\d{2}-\d{2}_\d{2}-\d{2})[^/]*)/", 1)
    compact = F.regexp_extract("run", r"(\d{8}-\d{4})", 1)
    dashed = F.regexp_extract("run", r"(\d{4}-\d{2}-\d{2}_\d{2}-\d{2})", 1)
    runs = paths.select(name.alias("run")).filter("run <> ''").groupBy("run").agg(F.count("*").alias("files"))
    stamped = runs.withColumn(
        "run_time",
        F.coalesce(
            F.try_to_timestamp(compact, F.lit("yyyyMMdd-HHmm")), F.try_to_timestamp(dashed, F.lit("yyyy-MM-dd_HH-mm"))
        ),
    )
    newest = stamped.agg(F.max("run_time").alias("_newest"))
    return stamped.join(F.broadcast(newest), F.lit(True)).select(
        "run", "run_time", "files", F.coalesce(F.col("run_time") == F.col("_newest"), F.lit(False)).alias("is_latest")
    )


def bands(df: DataFrame) -> DataFrame:
    """Band names for polarity, toxicity and confidence columns that are present."""
    chosen = {
        "sentiment_polarity": ("sentiment_band", SENTIMENT_BANDS, "very_negative"),
        "toxicity_score": ("toxicity_band", TOXICITY_BANDS, "minimal"),
        "primary_topic_confidence": ("confidence_band", CONFIDENCE_BANDS, "very_low"),
    }
    return df.withColumns(
        {name: band(c, limits, lowest, "unknown") for c, (name, limits, lowest) in chosen.items() if c in df.columns}
    )


def count_bands(df: DataFrame, count: str = "count") -> DataFrame:
    """Band of each count relative to the largest and on the absolute scale."""
    top = df.agg(F.max(count).alias("_top"))
    return df.join(F.broadcast(top), F.lit(True)).withColumns(
        {
            "relative_band": band(F.try_divide(F.col(count).cast("double"), F.col("_top").cast("double")), RELATIVE_COUNT_BANDS, "lowest", "unknown"),
            "absolute_band": band(count, ABSOLUTE_COUNT_BANDS, "lowest", "unknown"),
        }
    ).drop("_top")


def format_date(c: Column | str, short: bool = False) -> Column:
    """Date text in several formats as yyyy-MM-dd or MM/dd; other text is cut to ten
    characters and missing text is "Unknown"."""
    text = col(c)
    day = F.regexp_extract(text, r"^([^T]*)", 1)
    parsed = F.coalesce(*[F.try_to_timestamp(day, F.lit(f)) for f in DATE_FORMATS])
    shown = F.date_format(parsed, "MM/dd" if short else "yyyy-MM-dd")
    return F.when(text.isNull() | (text == ""), "Unknown").otherwise(F.coalesce(shown, F.substring(text, 1, 10)))

