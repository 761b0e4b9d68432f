"""Times of the headline queries; prints one line of JSON.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores and
``BENCH_RUNS`` the timed runs per query, of which the median counts. Each query is
run twice before that. Results go to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tallystream.functions import clean_text  # noqa: E402
from tallystream.session import build_session  # noqa: E402
from tallystream.workload import QUERIES  # noqa: E402
from tallystream.workload.domain import table  # noqa: E402

WARM_UP = 2

HEADLINE = (
    "clean_strings",
    "gold_counts",
    "gold_counts_part",
    "locale_number",
    "json_parse",
    "json_props",
    "envelope_sink",
    "replay_publish",
    "topic_decode",
    "enrich_join",
    "enrich_join_shuffled",
    "enrich_agg",
    "enrich_agg_shuffled",
    "csv_landing_scan",
    "bronze_snapshot_scan",
    "run_silver",
    "run_medallion",
    "jdbc_scan",
    "stream_enrich_agg",
    "stream_resume",
)


def clean_long_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column of whole documents."""
    return table(spark, sf_dir, "documents").select(clean_text("text").alias("text"))


def clean_short_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column of short strings, one per line item."""
    words = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    return table(spark, sf_dir, "lineitem").select(clean_text(words).alias("text"))


def timed(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        conf={
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cases = {"clean_long_text": clean_long_text, "clean_short_text": clean_short_text}
    cases.update({name: QUERIES[name] for name in HEADLINE})
    seconds = {}
    for name, query in cases.items():
        for _ in range(WARM_UP):
            timed(query, spark, sf_dir)
        times = [timed(query, spark, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    line = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(Path(sf_dir).name.removeprefix("sf") or 0),
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
