"""The files of a run: enriched messages in every format, sidecars, and the catalogue of runs read from the files themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import reports, rollups
from tidewire.sources import stores

#: Files of a run, by what they hold.
MESSAGES = ("messages.parquet", "messages.csv", "messages.json")
SUMMARY, TOTALS = "daily_summary.csv", "totals.json"


def write_run(df: DataFrame, root: str, run: str) -> None:
    """Write enriched messages as Parquet, CSV and JSON below ``root/run``, and the daily summary and the totals as sidecars.

    The messages are computed once; everything else is made from the Parquet files.
    """
    folder = f"{root.rstrip('/')}/{run}"
    stores.write_enriched(df, f"{folder}/{MESSAGES[0]}")
    written = df.sparkSession.read.parquet(f"{folder}/{MESSAGES[0]}")
    for name in MESSAGES[1:]:
        stores.write_enriched(written, f"{folder}/{name}")
    stores.write_table(rollups.daily_summary(written), f"{folder}/{SUMMARY}", "csv")
    stores.write_table(written.agg(F.count("*").alias("messages"), F.sum(F.length("text")).alias("characters")), f"{folder}/{TOTALS}", "json")


def read_output(spark: SparkSession, root: str, run: str, name: str) -> DataFrame:
    """One output of a run by its suffix; CSV text may hold line breaks."""
    path = f"{root.rstrip('/')}/{run}/{name}"
    if name.endswith(".parquet"):
        return spark.read.parquet(path)
    if name.endswith(".csv"):
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return spark.read.json(path)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths of all files below ``root``, without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(root).select("path")


def list_runs(spark: SparkSession, root: str) -> DataFrame:
    """Run, time, number of files and whether it is the newest, from the folders that hold files."""
    return reports.run_catalogue(list_files(spark, root))
