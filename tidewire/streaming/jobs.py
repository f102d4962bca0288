"""Incremental enrichment, de-duplication, daily rollup and rate cap on streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewire.operators import rollups
from tidewire.streaming.increments import RATE_OUTPUT, RATE_STATE, Increments, capped_rows, first_rows


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Stream over the Parquet table ``folder/name.parquet``, a file or a folder of files (a pattern names either)."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def run_available(stream: DataFrame, output: str, checkpoint: str) -> DataFrame:
    """Process what is there, append it to Parquet, and read the result.

    Started again with the same checkpoint, it continues after the last
    committed batch.
    """
    started = (
        stream.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).outputMode("append").start()
    )
    started.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(output)


def stream_folder(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Stream over all Parquet files that are or will be in a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def enrich_stream(stream: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stateless steps are the batch functions themselves."""
    return step(stream)


def first_per_id(spark: SparkSession, folder: str, stream: DataFrame, key: str = "msg_id", at: str = "date", delay_hours: float = 1) -> Increments:
    """The whole earliest row of each id (``increments.first_rows``); ``run`` it on the stream, any number of times."""
    schema = stream.schema
    return Increments(spark, folder, first_rows(key, at), schema, schema, at, int(delay_hours * 3_600_000_000))


def daily_rollup(stream: DataFrame, at: str = "date", delay: str = "1 day") -> DataFrame:
    """The daily summary on a stream: a day is written once, when the watermark
    has passed its end, and later rows for it are dropped."""
    timed = stream.withWatermark(at, delay)
    parts = rollups.summary_parts(stream.columns)
    return timed.groupBy(F.window(at, "1 day").alias("w")).agg(*[v.alias(k) for k, v in parts.items()]).select(
        F.date_format("w.start", "yyyy-MM-dd").alias("date"), *parts
    )


def completed_rollup(closed: DataFrame, rows: DataFrame, at: str = "date") -> DataFrame:
    """Closed days as written, and the days after the last of them from a batch pass over the rows the watermark has not passed.

    The bound is a literal, so only those rows are read where the table is stored by time.
    """
    last = closed.agg(F.max("date")).first()[0]
    rest = rows if last is None else rows.filter(F.col(at) >= F.date_add(F.lit(last).cast("date"), 1).cast("timestamp"))
    return closed.unionByName(rollups.daily_summary(rest.withColumn("date", F.col(at))))


def with_dictionary(stream: DataFrame, dictionary: DataFrame, on: str) -> DataFrame:
    """Left join with a static dictionary."""
    return stream.join(dictionary, on, "left")


def cap_rate_stream(spark: SparkSession, folder: str, window_us: int, limit: int, delay_hours: float = 1) -> Increments:
    """At most ``limit`` rows per key and anchored window; ``run`` it on ``rate_rows``."""
    return Increments(spark, folder, capped_rows(window_us, limit), RATE_STATE, RATE_OUTPUT, "at", int(delay_hours * 3_600_000_000))


def rate_rows(stream: DataFrame, key: str, at: str, row_id: str) -> DataFrame:
    return stream.select(F.col(key).cast("string").alias("key"), F.col(at).cast("timestamp").alias("at"), F.col(row_id).cast("long").alias("row_id")).withColumn("ts_us", F.unix_micros("at"))
