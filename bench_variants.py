"""Our expressions against plainer ways to write the same, on the same data.

Prints one line of JSON per pair: median seconds of each way, and whether the results
are equal. ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_RUNS`` as in ``bench.py``.
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

from tallystream.functions import clean_text, parse_envelope, to_envelope  # noqa: E402
from tallystream.operators import (  # noqa: E402
    clean_biography,
    enrich_agg,
    enrich_join,
    latest_per_key,
)
from tallystream.schemas import RESULT_EVENT, TALLY_KEYS  # noqa: E402
from tallystream.scratch import new_dir  # noqa: E402
from tallystream.session import build_session  # noqa: E402
from tallystream.sinks import replay_publish  # noqa: E402
from tallystream.sources import file_topic  # noqa: E402
from tallystream.workload import domain  # noqa: E402

COPIES = 10


def stored(df: DataFrame, label: str) -> DataFrame:
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def pairs(spark: SparkSession, sf_dir: str):
    """(name, {variant: function giving a DataFrame or None}); the first variant is ours."""
    documents = domain.table(spark, sf_dir, "documents")
    lines = domain.table(spark, sf_dir, "lineitem")
    words = [c for c in lines.columns if c != "l_shipdate"]
    short = stored(lines.select(F.concat_ws("-", *words).alias("text")), "short")
    for name, df in (("clean long text", documents), ("clean short text", short)):
        yield name, {"native": lambda df=df: df.select(clean_text("text").alias("t"))}

    results = domain.results(spark, sf_dir, f"explode(sequence(1, {COPIES})) AS copy").drop("copy")
    results = stored(results, "results")
    records = stored(to_envelope(results, ["athlete_id"]), "records")
    biography = stored(clean_biography(domain.biographies(spark, sf_dir)), "bio")

    def flattened() -> DataFrame:
        parsed = F.from_json("value", RESULT_EVENT).alias("json")
        return enrich_agg(records.select(parsed).select("json.*"), biography).drop("timestamp")

    def inlined() -> DataFrame:
        parsed = parse_envelope(records, RESULT_EVENT, ["athlete_id", "sport", "medal"])
        return enrich_agg(parsed, biography).drop("timestamp")

    yield "parse, join, aggregate", {"inline": inlined, "select json.*": flattened}

    def over_rows() -> DataFrame:
        rows = enrich_join(results, biography)
        return rows.groupBy(*TALLY_KEYS).agg(
            F.avg("height").alias("avg_height"),
            F.avg("weight").alias("avg_weight"),
            F.count("*").alias("athlete_count"),
        )

    yield (
        "join, aggregate",
        {
            "profiles": lambda: enrich_agg(results, biography).drop("timestamp"),
            "joined rows": over_rows,
        },
    )

    batches = enrich_agg(results.withColumn("medal", F.concat("sport", "pos")), biography)
    versions = F.explode(F.sequence(F.lit(1), F.lit(100))).alias("batch_id")
    log = stored(batches.select("*", versions), "log")

    def newest_struct() -> DataFrame:
        rest = [c for c in log.columns if c not in TALLY_KEYS]
        newest = F.max_by(F.struct(*rest), "batch_id").alias("newest")
        return log.groupBy(*TALLY_KEYS).agg(newest).select(*TALLY_KEYS, "newest.*")

    yield (
        "latest version",
        {"max_by per column": lambda: latest_per_key(log), "max_by of a struct": newest_struct},
    )

    def distributed() -> None:
        replay_publish(results, file_topic(new_dir(spark, "published")))

    yield "publish", {"distributed": distributed}


def checksum(df: DataFrame) -> int:
    columns = [F.round(c, 6) if t == "double" else F.col(c) for c, t in df.dtypes]
    return df.agg(F.sum(F.xxhash64(*columns) % 1_000_003)).first()[0]


def timed(variant) -> float:
    start = time.perf_counter()
    df = variant()
    if df is not None:
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "variants",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        conf={"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name, variants in pairs(spark, sf_dir):
        times: dict[str, list[float]] = {v: [] for v in variants}
        for turn in range(runs + 1):
            for variant, function in variants.items():
                seconds = timed(function)
                if turn:
                    times[variant].append(seconds)
        line = {"pair": name, **{v: round(statistics.median(t), 3) for v, t in times.items()}}
        frames = [f() for f in variants.values()] if name != "publish" else []
        line["equal"] = len({checksum(df) for df in frames}) <= 1
        print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
