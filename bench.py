"""Time the headline queries on local cores and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8). Each
table is written in several files before the clock starts, as a table of any
size is; a Parquet file of one row group would be read by one task.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidewire import catalog  # noqa: E402

HEADLINE = (
    "daily_summary", "sentiment_scores", "toxicity_statistics", "style_features", "link_statistics", "top_domains",
    "entity_mentions", "canonical_mentions", "message_languages", "quote_spans", "stance_edges", "entity_stance_daily",
    "topic_share_daily", "topic_words", "reposts_reduced", "rate_limited", "event_rate_capped", "prefix_duplicates_dropped",
    "entity_scores", "page_sections", "normalised_messages", "streamed_scores", "near_duplicate_clusters", "staged_enrichment",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewire-bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidewire-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = tempfile.mkdtemp(prefix="tidewire-tables-")
    for path in Path(folder).glob("*.parquet"):
        spark.read.parquet(str(path)).repartition(2 * int(cores)).write.parquet(f"{tables}/{path.name}")
    runnable = catalog.runnable()
    runnable["dataset_summary"](spark, tables).collect()  # start-up
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.time()
        runnable[name](spark, tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": folder.rsplit("sf", 1)[-1]}
        )
    )


if __name__ == "__main__":
    main()
