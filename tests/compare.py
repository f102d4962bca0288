"""Compare a Spark result with its SQL twin, as sorted rows of plain values.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


TIMES: dict[str, tuple[float, ...]] = {}  # build, run, SQL twin


def duck(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if hasattr(value, "item"):
        return value.item()
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: [str(v) for v in r])


def compare(spark, connection, name: str, run, sql: str, folder: str) -> str | None:
    """None when equal, otherwise a description of the first difference."""
    clock = [time.time()]
    df = run(spark, folder)
    got_columns = df.columns
    clock.append(time.time())
    got = rows_of(got_columns, df.collect())
    clock.append(time.time())
    cursor = connection.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = rows_of(want_columns, cursor.fetchall())
    clock.append(time.time())
    TIMES[name] = tuple(round(b - a, 2) for a, b in zip(clock, clock[1:]))
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{sorted(got_columns)}\n  spark {g}\n  sql   {w}"
    return None


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidewire-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    import __spark_entry__ as contract

    folder, names = sys.argv[1], sys.argv[2:]
    runnable, oracle = contract.queries(), contract.oracle_sql()
    chosen = [n for n in runnable if not names or any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in names)]
    spark, connection, bad = session(), duck(folder), 0
    for name in chosen:
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, connection, name, runnable[name], oracle[name], folder)
                label = "ok  " if problem is None else "DIFF"
            else:
                rows = runnable[name](spark, folder).collect()
                problem, label = None, f"rows {len(rows)}"
        except Exception as error:  # noqa: BLE001
            problem, label = str(error)[:1500], "FAIL"
        bad += problem is not None
        print(f"{label} {time.time() - start:6.2f}s {TIMES.get(name, '')} {name}" + (f"\n  {problem}" if problem else ""), flush=True)
    print(f"{len(chosen)} queries, {bad} bad")


if __name__ == "__main__":
    main()
