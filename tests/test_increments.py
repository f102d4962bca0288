import random
from datetime import datetime, timedelta, timezone

import pytest

from tidewire.sources.tables import work_folder
from tidewire.streaming import jobs

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def write(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def capped(rows, window, limit):
    """Sequential rate cap."""
    out, state = [], {}
    for key, at, row_id in sorted(rows, key=lambda r: (r[1], r[2])):
        start, n = state.get(key, (None, 0))
        if start is None or at >= start + window:
            start, n = at, 0
        if n < limit:
            out.append((key, row_id))
        state[key] = (start, n + 1)
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 4])
def test_rate_cap_over_several_runs(spark, parts):
    rng = random.Random(parts)
    rows = []
    for i in range(900):
        # one key holds a third of all rows, many of them at the same time
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(12)}"
        at = START + timedelta(minutes=rng.choice([0, 1, 1, 2]) if key == "hot" and rng.random() < 0.3 else rng.randrange(6000))
        rows.append((key, at, i))
    rows.sort(key=lambda r: r[1])
    folder = work_folder(spark, "test-rate")
    schema = "kind string, ts timestamp, id long"
    write(spark, rows[:1], schema, f"{folder}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema).parquet(f"{folder}/in")
    size = -(-len(rows) // parts)
    finished = 0
    for p in range(parts):
        part = rows[max(1, p * size) : (p + 1) * size]
        rng.shuffle(part)
        write(spark, part, schema, f"{folder}/in")
        job = jobs.cap_rate_stream(spark, f"{folder}/job", 3_600_000_000, 3, delay_hours=1)
        job.run(jobs.rate_rows(stream, "kind", "ts", "id"))
        seen = rows[: (p + 1) * size]
        want = capped(seen, timedelta(hours=1), 3)
        assert sorted((r["key"], r["row_id"]) for r in job.completed().collect()) == want
        # what is finished stays, and is never more than what is complete
        n = job.finished().count()
        assert finished <= n <= len(want)
        finished = n
    assert job.finished().dropDuplicates(["key", "row_id"]).count() == finished > 0


def test_repeated_batch_writes_the_same_folders(spark):
    folder = work_folder(spark, "test-repeat")
    rows = spark.createDataFrame([("a", START + timedelta(minutes=i), i) for i in range(200)], "kind string, ts timestamp, id long")
    job = jobs.cap_rate_stream(spark, folder, 3_600_000_000, 2)
    batch = jobs.rate_rows(rows, "kind", "ts", "id")
    job._work(batch, 0)
    once = sorted(r["row_id"] for r in job.completed().collect())
    job._work(batch, 0)
    assert sorted(r["row_id"] for r in job.completed().collect()) == once == [0, 1, 60, 61, 120, 121, 180, 181]


def test_first_rows_come_out_whole_and_once(spark):
    folder = work_folder(spark, "test-first")
    schema = "msg_id long, date timestamp, text string"
    runs = [
        [(1, START + timedelta(hours=2), "later"), (1, START + timedelta(hours=1), "first"), (2, START, "b"), (None, START, "no id"), (5, None, "no date")],
        [(1, START + timedelta(minutes=30), "earlier yet"), (3, START + timedelta(days=1), "c"), (3, START + timedelta(days=1), "bb")],
        [(3, START + timedelta(hours=23, minutes=30), "earlier"), (2, START + timedelta(days=3), "again")],
    ]
    write(spark, runs[0], schema, f"{folder}/in")
    stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
    job = jobs.first_per_id(spark, f"{folder}/job", stream)
    job.run(stream)
    assert {(r["msg_id"], r["text"]) for r in job.completed().collect()} == {(1, "first"), (2, "b"), (None, "no id")}
    for rows in runs[1:]:
        write(spark, rows, schema, f"{folder}/in")
        job.run(stream)
    got = [(r["msg_id"], r["text"]) for r in job.completed().collect()]
    # message 1 was still waiting when its earlier row came; 2 was done
    assert sorted(got, key=str) == sorted([(1, "earlier yet"), (2, "b"), (3, "earlier"), (None, "no id")], key=str)
    assert job.finished().count() <= len(got)
