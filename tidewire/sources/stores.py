"""Sinks and stage snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.lexicons import STAGES


def flatten_complex(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for formats without nesting."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields]
    )


def write_enriched(df: DataFrame, path: str, by_day: bool = False) -> None:
    """Write by suffix: .parquet, .csv or .json. ``by_day`` partitions Parquet by date."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        if by_day:
            df.withColumn("day", F.to_date("date")).write.mode("overwrite").partitionBy("day").parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
    elif suffix == "csv":
        flatten_complex(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    elif suffix == "json":
        df.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss").json(path)
    else:
        raise ValueError(f"unsupported output format: {path}")


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A rollup as one file; rollups are bounded by days, entities or domains."""
    writer = flatten_complex(df).coalesce(1).write.mode("overwrite") if fmt == "csv" else df.coalesce(1).write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.json(path)


class StageStore:
    """Named stage snapshots below one folder.

    A stage is complete when its ``_SUCCESS`` marker exists, which Spark writes
    only after every task has committed.
    """

    def __init__(self, spark: SparkSession, folder: str, stages: Sequence[str] = STAGES) -> None:
        self.spark, self.folder, self.stages = spark, folder.rstrip("/"), tuple(stages)

    def _path(self, stage: str) -> str:
        if stage not in self.stages:
            raise ValueError(f"unknown stage: {stage}")
        return f"{self.folder}/stage={stage}"

    def completed(self, stage: str) -> bool:
        jvm = self.spark._jvm
        marker = jvm.org.apache.hadoop.fs.Path(f"{self._path(stage)}/_SUCCESS")
        return marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(marker)

    def save(self, stage: str, df: DataFrame) -> DataFrame:
        """Write a stage and return it read back, which also ends the lineage."""
        df.write.mode("overwrite").parquet(self._path(stage))
        return self.load(stage)

    def load(self, stage: str) -> DataFrame:
        if not self.completed(stage):
            raise FileNotFoundError(f"stage not complete: {stage}")
        return self.spark.read.parquet(self._path(stage))

    def save_stats(self, stage: str, name: str, df: DataFrame) -> None:
        df.coalesce(1).write.mode("overwrite").json(f"{self.folder}/stats={stage}/{name}")

    def last_completed(self) -> str | None:
        return next((s for s in reversed(self.stages) if self.completed(s)), None)

    def resume_point(self) -> str | None:
        """The stage after the last complete one; None before the first or after the last."""
        last = self.last_completed()
        if last is None:
            return None
        following = self.stages.index(last) + 1
        return self.stages[following] if following < len(self.stages) else None

    def summary(self) -> DataFrame:
        """One row per stage with totals, for a progress report."""
        done = [self.completed(s) for s in self.stages]
        rows = [(i, s, d, len(done), sum(done), sum(done) / len(done) * 100) for i, (s, d) in enumerate(zip(self.stages, done))]
        return self.spark.createDataFrame(
            rows, "ord int, stage string, is_complete boolean, total_steps int, completed_steps int, progress_percent double"
        )
