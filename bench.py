"""Headline queries, timed.

    BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
    BENCH_CPUS     local threads (default 8)
    BENCH_RUNS     timed runs per query, the best counts (default 2)

Prints one JSON line.  Each query is run once before it is timed; batch
queries write all their rows to the noop sink.  The tables that mails are made of are
one file of one row group each, so a copy of as many files as a large table would have
tasks for is made first, and not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mailgauge.sources.mailfiles import MAIL_OPEN_COST, OPEN_COST  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "avg_mail_stats_by_sender",
    "avg_mail_stats",
    "avg_stored_mail_by_sender",
    "avg_raw_mail_by_sender",
    "mail_features",
    "interval_filter_stored",
    "append_mail",
    "order_by_date",
    "sender_totals",
    "top_senders_both",
    "word_frequency",
    "top_words_window",
    "mail_parse",
    "mail_quarantine",
    "scan_mail_files",
    "load_parquet_multi",
    "parquet_roundtrip",
    "json_document",
    "stream_top_senders",
    "stream_top_words_window",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config(OPEN_COST, MAIL_OPEN_COST)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    copy = tempfile.mkdtemp(prefix="bench-")
    for table in ("documents", "conversations"):
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        rows.repartition(2 * int(cpus)).write.parquet(f"{copy}/{table}.parquet")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, copy).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        once(name)
        seconds[name] = round(min(once(name) for _ in range(runs)), 3)
    result = {
        "metric": "total_headline_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
