"""Stateful steps on streams whose state is a table: no group of rows ever meets in one task."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewire.functions.order import anchored_windows
from tidewire.sources.tables import cut_lineage

#: ``step(rows, state, done, since, until) -> (finished rows, next state)``; times in microseconds, ``until`` None at the end of the input.
Step = Callable[[DataFrame, DataFrame, DataFrame, int | None, int | None], tuple[DataFrame, DataFrame]]


class Increments:
    """A stream worked off in micro-batches by batch operators.

    Every batch gets its rows, the state and the output so far, and writes what is finished and
    the next state into folders of its number. A batch that is repeated after a
    failure writes the same folders again, and only batches that the next one
    has seen completed count, so every row has its effect once. ``since`` and ``until`` bound the event times that
    become final with the batch: ``until`` is the latest time seen less ``delay``
    microseconds; rows older than ``since`` came too late.
    """

    def __init__(self, spark: SparkSession, folder: str, step: Step, state_schema: StructType | str, output_schema: StructType | str, at: str, delay: int) -> None:
        self.spark, self.folder, self.step, self.at, self.delay = spark, folder.rstrip("/"), step, at, delay
        self.state_schema, self.output_schema = state_schema, output_schema

    def _path(self, kind: str, batch: int) -> str:
        return f"{self.folder}/{kind}/batch={batch}"

    def _exists(self, path: str) -> bool:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return there.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(there)

    def _last(self, before: int | None = None) -> int | None:
        """The last completed batch: its bound is written after everything else."""
        base = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/bound")
        files = base.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(base):
            return None
        numbers = [int(s.getPath().getName().split("=")[1]) for s in files.listStatus(base)]
        numbers = [n for n in numbers if (before is None or n < before) and self._exists(f"{self._path('bound', n)}/_SUCCESS")]
        return max(numbers, default=None)

    def _read(self, kind: str, batch: int | None, schema: StructType | str) -> DataFrame:
        if batch is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(kind, batch))

    def _bound(self, batch: int | None) -> int | None:
        return None if batch is None else self.spark.read.json(self._path("bound", batch)).first()["until"]

    def _done(self, last: int | None) -> DataFrame:
        """Finished rows of all batches up to ``last``."""
        folders = [] if last is None else [p for p in (self._path("out", n) for n in range(last + 1)) if self._exists(f"{p}/_SUCCESS")]
        return self.spark.read.schema(self.output_schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.output_schema)

    def _work(self, rows: DataFrame, batch: int) -> None:
        last = self._last(batch)
        since = self._bound(last)
        latest = rows.agg(F.max(F.unix_micros(self.at))).first()[0]
        seen = [t for t in (since, None if latest is None else latest - self.delay) if t is not None]
        until = max(seen, default=0)
        out, state = self.step(rows, self._read("state", last, self.state_schema), self._done(last), since, until)
        out.write.mode("overwrite").parquet(self._path("out", batch))
        state.write.mode("overwrite").parquet(self._path("state", batch))
        self.spark.createDataFrame([(until,)], "until long").coalesce(1).write.mode("overwrite").json(self._path("bound", batch))

    def run(self, stream: DataFrame) -> None:
        """Work off what is there. Started again on the same folder, the stream goes on after the last completed batch."""
        started = (
            stream.writeStream.foreachBatch(self._work).option("checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start()
        )
        started.awaitTermination()

    def finished(self) -> DataFrame:
        """Rows that later input cannot change."""
        return self._done(self._last())

    def completed(self) -> DataFrame:
        """Finished rows and, by a batch pass over the state, what would follow if no more rows came. Nothing is committed: the stream may go on."""
        last = self._last()
        done = self._done(last)
        nothing = self._read("state", None, self.state_schema)
        rows, _ = self.step(nothing, self._read("state", last, self.state_schema), done, self._bound(last), None)
        return done.unionByName(rows)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_rows(key: str, at: str) -> Step:
    """The whole earliest row of each key; of equal times the row that is smallest as JSON.

    A key waits in the state, one row each, until ``until`` has passed its time. What came out once stays: the output itself tells which keys are done.
    """

    def step(rows: DataFrame, state: DataFrame, done: DataFrame, since: int | None, until: int | None) -> tuple[DataFrame, DataFrame]:
        whole = F.struct(*[F.col(c) for c in done.columns])
        new = _union([rows.select(*done.columns), state.select(*done.columns)]).filter(F.col(at).isNotNull())
        fresh = new.join(done.select(F.col(key).alias("_done")).distinct(), F.col(key).eqNullSafe(F.col("_done")), "left_anti")
        best = fresh.groupBy(F.col(key).alias("_key")).agg(F.min_by(whole, F.struct(F.col(at), F.to_json(whole))).alias("_row")).select("_row.*")
        if until is None:
            return best, best.limit(0)
        best = cut_lineage(best)
        ready = F.unix_micros(at) < until
        return best.filter(ready), best.filter(~ready)

    return step


RATE_STATE = "key string, ts_us long, row_id long, kept long"
RATE_OUTPUT = "key string, ts_us long, row_id long"


def capped_rows(window_us: int, limit: int) -> Step:
    """At most ``limit`` rows per key and anchored window, as in batch.

    Rows wait until ``until`` has passed them. The state holds them and, per key, the start of
    its open window with the number of rows kept in it (``row_id`` null). The open start
    stands first among the rows of its key, so the batch operator finds the following
    windows; it works in cells of time, and the rank filter is applied per task
    before the shuffle, so a key with most of the rows is spread. Rows that come after their time was final are left out.
    """

    def step(rows: DataFrame, state: DataFrame, done: DataFrame, since: int | None, until: int | None) -> tuple[DataFrame, DataFrame]:
        new = rows.select("key", "ts_us", "row_id").filter("ts_us IS NOT NULL")
        if since is not None:
            new = new.filter(F.col("ts_us") >= since)
        waiting = cut_lineage(_union([new, state.filter("row_id IS NOT NULL")]).select("key", "ts_us", "row_id"))
        seeds = cut_lineage(state.filter("row_id IS NULL").select("key", "ts_us", "row_id", "kept"))
        ready = waiting if until is None else waiting.filter(F.col("ts_us") < until)
        points = _union([ready.withColumn("kept", F.lit(0).cast("long")), seeds])
        points = points.withColumnRenamed("key", "of")
        placed = cut_lineage(anchored_windows(points, ["of"], F.col("ts_us"), window_us).withColumnRenamed("of", "key"))
        before = placed.filter("row_id IS NULL").select("key", "window_start", F.col("kept").alias("before"))
        rank = F.row_number().over(W.partitionBy("key", "window_start").orderBy("ts_us", "row_id"))
        first = placed.filter("row_id IS NOT NULL").select("key", "ts_us", "row_id", "window_start").withColumn("rank", rank).filter(F.col("rank") <= limit)
        kept = cut_lineage(first.join(before, ["key", "window_start"], "left").filter(F.col("rank") + F.coalesce("before", F.lit(0)) <= limit))
        out = kept.select("key", "ts_us", "row_id")
        if until is None:
            return out, state.limit(0)
        last = placed.groupBy("key").agg(F.max("window_start").alias("window_start"))
        held = kept.groupBy("key", "window_start").agg(F.count(F.lit(1)).alias("n"))
        opened = last.join(held, ["key", "window_start"], "left").join(before, ["key", "window_start"], "left")
        opened = opened.select("key", F.col("window_start").alias("ts_us"), F.lit(None).cast("long").alias("row_id"), (F.coalesce("n", F.lit(0)) + F.coalesce("before", F.lit(0))).alias("kept"))
        later = waiting.filter(F.col("ts_us") >= until).withColumn("kept", F.lit(None).cast("long"))
        return out, later.unionByName(opened)

    return step
