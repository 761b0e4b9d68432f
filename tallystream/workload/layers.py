"""Landing, snapshots and the batch jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.functions import clean_strings
from tallystream.plans import (
    Layers,
    gold_of_increments,
    increments,
    read_increments,
    run_bronze,
    run_gold,
    run_medallion,
    run_silver,
    run_silver_increment,
)
from tallystream.plans.medallion import BIOGRAPHY, RESULTS
from tallystream.scratch import new_dir
from tallystream.sinks import overwrite_day, publish_version, write_snapshot, write_version
from tallystream.sources import csv_landing_scan, latest_snapshot, read_day, read_snapshots
from tallystream.sources.paths import remove
from tallystream.workload import domain
from tallystream.workload.domain import clean_sql, table

MORNING = datetime(2024, 8, 4, 8, 0, 0)
EVENING = datetime(2024, 8, 4, 20, 30, 15)
NEXT_DAY = datetime(2024, 8, 5, 0, 0, 1)
LATER = datetime(2024, 8, 5, 18, 0, 0)


def _landed(
    spark: SparkSession, sf_dir: str, label: str, tables: tuple[str, ...] = (BIOGRAPHY, RESULTS)
) -> Layers:
    layers = Layers.below(new_dir(spark, label))
    sources = {BIOGRAPHY: domain.biographies, RESULTS: domain.results}
    for name in tables:
        landing = sources[name](spark, sf_dir)
        landing.write.option("header", "true").csv(layers.landing_file(name))
    return layers


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _landed(spark, sf_dir, "csv", (RESULTS,))
    return csv_landing_scan(spark, layers.landing_file(RESULTS))


def csv_scan_bios(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _landed(spark, sf_dir, "csv", (BIOGRAPHY,))
    return csv_landing_scan(spark, layers.landing_file(BIOGRAPHY))


def _two_snapshots(spark: SparkSession, sf_dir: str) -> str:
    """Two different snapshots of one day, and one of the next."""
    layers = Layers.below(new_dir(spark, "snapshots"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    write_snapshot(part, layers.bronze_snapshot("part", MORNING))
    evening = part.withColumn("p_size", F.col("p_size") + 100)
    write_snapshot(evening, layers.bronze_snapshot("part", EVENING))
    write_snapshot(part.withColumn("p_size", F.lit(0)), layers.bronze_snapshot("part", NEXT_DAY))
    return f"{layers.bronze}/part"


def snapshot_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers.below(new_dir(spark, "snapshot"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return spark.read.parquet(write_snapshot(orders, layers.bronze_snapshot("orders", MORNING)))


def snapshots_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_snapshots(spark, _two_snapshots(spark, sf_dir), MORNING)


def snapshots_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_snapshots(spark, _two_snapshots(spark, sf_dir), MORNING, snapshots="latest")


def newest_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(latest_snapshot(spark, _two_snapshots(spark, sf_dir)))


def silver_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day folder written twice holds the second run only."""
    layers = Layers.below(new_dir(spark, "silver"))
    path = layers.silver_day("part", MORNING)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    overwrite_day(part, path)
    overwrite_day(clean_strings(part), path)
    return read_day(spark, path)


def silver_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An absent day is skipped, a present one is read."""
    layers = Layers.below(new_dir(spark, "guard"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    overwrite_day(part, layers.silver_day("part", MORNING))
    paths = [layers.silver_day("part", day) for day in (MORNING, NEXT_DAY)]
    days = [read_day(spark, path, missing="skip") for path in paths]
    present = [day for day in days if day is not None]
    return present[0].withColumn("days_present", F.lit(len(present)))


def overwrite_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An overwrite fails in some of its tasks: the day is what it was."""
    layers = Layers.below(new_dir(spark, "broken"))
    path = layers.silver_day("part", MORNING)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    overwrite_day(part, path)
    fails = F.expr("IF(p_partkey % 97 = 5, CAST(raise_error('broken') AS INT), p_size + 1)")
    failed = False
    try:
        overwrite_day(part.repartition(8, "p_partkey").withColumn("p_size", fails), path)
    except PySparkException:
        failed = True
    return read_day(spark, path).withColumn("failed", F.lit(failed))


def overwrite_cut_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A process ends after naming a new version and before putting it in place: it counts."""
    layers = Layers.below(new_dir(spark, "cut"))
    path = layers.silver_day("part", MORNING)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    overwrite_day(part, path)
    publish_version(spark, path, write_version(clean_strings(part), path))
    return read_day(spark, path)


def guard_unfinished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day whose writer has not ended is as good as absent."""
    layers = Layers.below(new_dir(spark, "unfinished"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    paths = [layers.silver_day("part", day) for day in (MORNING, NEXT_DAY)]
    overwrite_day(part, paths[0])
    part.write.parquet(paths[1])
    remove(spark, f"{paths[1]}/_SUCCESS")
    days = [read_day(spark, path, missing="skip") for path in paths]
    present = [day for day in days if day is not None]
    return present[0].withColumn("days_present", F.lit(len(present)))


def bronze_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _landed(spark, sf_dir, "bronze")
    written = run_bronze(spark, layers, MORNING)
    return spark.read.parquet(written[BIOGRAPHY])


def bronze_job_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other table of the same job."""
    layers = _landed(spark, sf_dir, "bronze")
    written = run_bronze(spark, layers, MORNING)
    return spark.read.parquet(written[RESULTS])


def silver_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _landed(spark, sf_dir, "silver")
    run_bronze(spark, layers, MORNING)
    written = run_silver(spark, layers, EVENING)
    return read_day(spark, written[RESULTS])


def gold_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold over a silver day that was cleaned directly."""
    layers = Layers.below(new_dir(spark, "gold"))
    cleaned = clean_strings(domain.results(spark, sf_dir))
    overwrite_day(cleaned, layers.silver_day(RESULTS, MORNING))
    return read_day(spark, run_gold(spark, layers, MORNING)).drop("timestamp")


def gold_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold made twice on one day holds the counts of the second run."""
    layers = Layers.below(new_dir(spark, "gold"))
    cleaned = clean_strings(domain.results(spark, sf_dir))
    for table_rows in (cleaned.unionAll(cleaned), cleaned):
        overwrite_day(table_rows, layers.silver_day(RESULTS, MORNING))
        path = run_gold(spark, layers, MORNING)
    return read_day(spark, path).drop("timestamp")


def medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _landed(spark, sf_dir, "medallion")
    return read_day(spark, run_medallion(spark, layers, MORNING)).drop("timestamp")


def medallion_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings of one day count double with all snapshots."""
    layers = _landed(spark, sf_dir, "twice")
    run_medallion(spark, layers, MORNING)
    return read_day(spark, run_medallion(spark, layers, EVENING)).drop("timestamp")


def medallion_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _landed(spark, sf_dir, "latest")
    run_medallion(spark, layers, MORNING)
    gold = run_medallion(spark, layers, EVENING, snapshots="latest")
    return read_day(spark, gold).drop("timestamp")


def medallion_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run breaks after bronze; run again, it does the two steps that are left."""
    layers = _landed(spark, sf_dir, "resumed")

    def breaks(step: str, _) -> None:
        if step == f"bronze-{RESULTS}":
            raise InterruptedError(step)

    try:
        run_medallion(spark, layers, MORNING, watch=breaks)
    except InterruptedError:
        pass
    steps = []
    gold = run_medallion(spark, layers, MORNING, watch=lambda step, _: steps.append(step))
    return read_day(spark, gold).drop("timestamp").withColumn("steps", F.lit(len(steps)))


def medallion_late_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run stops half-way through bronze, as a file has not landed, and goes on when it has."""
    layers = _landed(spark, sf_dir, "late", (BIOGRAPHY,))
    try:
        run_medallion(spark, layers, MORNING)
    except PySparkException:
        landing = domain.results(spark, sf_dir)
        landing.write.option("header", "true").csv(layers.landing_file(RESULTS))
    steps = []
    gold = run_medallion(spark, layers, MORNING, watch=lambda step, _: steps.append(step))
    return read_day(spark, gold).drop("timestamp").withColumn("steps", F.lit(len(steps)))


def _increments(spark: SparkSession, sf_dir: str) -> Layers:
    """Three landings, the last two on one day, and five runs: each landing is cleaned once."""
    layers = Layers.below(new_dir(spark, "increments"))
    rows = domain.results(spark, sf_dir, f"{domain.WAVE} AS wave")
    for wave, moment in enumerate((MORNING, NEXT_DAY, LATER)):
        landing = rows.filter(F.col("wave") == wave)
        write_snapshot(landing, layers.bronze_snapshot(RESULTS, moment))
        if wave != 1:  # two landings wait for one run
            run_silver_increment(spark, layers)
            run_silver_increment(spark, layers)
    run_silver_increment(spark, layers)
    return layers


def silver_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with the snapshot that it is from."""
    layers = _increments(spark, sf_dir)
    snapshot = F.regexp_extract("source_file", r"(\d{8}_\d{6})/[^/]*$", 1)
    rows = read_increments(spark, layers).withColumn("snapshot", snapshot)
    return rows.withColumn("increments", F.lit(len(increments(spark, layers)))).drop("source_file", "landed_at")


def gold_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_of_increments(spark, _increments(spark, sf_dir)).drop("timestamp")


QUERIES = {
    "run_silver_increment": silver_increments,
    "gold_of_increments": gold_increments,
    "csv_landing_scan": csv_scan,
    "csv_landing_scan_bios": csv_scan_bios,
    "bronze_snapshot_write": snapshot_written,
    "bronze_snapshot_scan": snapshots_all,
    "bronze_snapshot_latest": snapshots_latest,
    "latest_snapshot": newest_folder,
    "silver_write": silver_written,
    "silver_scan_guarded": silver_guarded,
    "silver_scan_unfinished": guard_unfinished,
    "silver_overwrite_broken": overwrite_broken,
    "silver_overwrite_cut_short": overwrite_cut_short,
    "run_bronze": bronze_job,
    "run_bronze_results": bronze_job_results,
    "run_silver": silver_job,
    "run_gold": gold_job,
    "gold_write": gold_written,
    "run_medallion": medallion,
    "run_medallion_two_landings": medallion_twice,
    "run_medallion_latest": medallion_latest,
    "run_medallion_resumed": medallion_resumed,
    "run_medallion_late_landing": medallion_late_landing,
}

# A CSV file cannot tell an empty text from a missing one: both read as NULL.
_TEXT_RESULTS = ", ".join(
    f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in domain.RESULTS
)
# The CSV writer trims blanks around a value by default.
_TEXT_BIOS = ", ".join(
    f"nullif(trim(CAST({c} AS VARCHAR)), '') AS {c}" for c in domain.BIOGRAPHIES
)
_CLEANED = ", ".join(f"{clean_sql(f'CAST({c} AS VARCHAR)')} AS {c}" for c in domain.RESULTS)


def _gold_sql(times: int) -> str:
    return (
        f"SELECT {clean_sql('sport')} AS sport, {clean_sql('country_noc')} AS country_noc, "
        f"{clean_sql('medal')} AS medal, {times} * count(*) AS medal_count "
        f"FROM ({domain.RESULTS_SQL}) GROUP BY 1, 2, 3"
    )


# What each column is cleaned to, by its type.
_CLEANED_TYPED = ", ".join(
    c if c in ("edition_id", "athlete_id") else f"{clean_sql(c)} AS {c}" for c in domain.RESULTS
)

ORACLES = {
    "run_silver_increment": (
        f"SELECT wave, {_CLEANED_TYPED}, CASE wave WHEN 0 THEN '20240804_080000' "
        "WHEN 1 THEN '20240805_000001' ELSE '20240805_180000' END AS snapshot, "
        f"CAST(2 AS INTEGER) AS increments FROM ({domain.RESULTS_SQL})"
    ),
    "gold_of_increments": _gold_sql(1),
    "csv_landing_scan": f"SELECT {_TEXT_RESULTS} FROM ({domain.RESULTS_SQL})",
    "csv_landing_scan_bios": f"SELECT {_TEXT_BIOS} FROM ({domain.BIOGRAPHIES_SQL})",
    "bronze_snapshot_write": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "bronze_snapshot_scan": (
        "SELECT p_partkey, p_name, p_size FROM part UNION ALL "
        "SELECT p_partkey, p_name, p_size + 100 AS p_size FROM part"
    ),
    "bronze_snapshot_latest": "SELECT p_partkey, p_name, p_size + 100 AS p_size FROM part",
    "latest_snapshot": "SELECT p_partkey, p_name, CAST(0 AS INTEGER) AS p_size FROM part",
    "silver_write": (
        f"SELECT p_partkey, {clean_sql('p_name')} AS p_name, {clean_sql('p_brand')} AS p_brand "
        "FROM part"
    ),
    "silver_scan_guarded": (
        "SELECT p_partkey, p_name, CAST(1 AS INTEGER) AS days_present FROM part"
    ),
    "silver_scan_unfinished": (
        "SELECT p_partkey, p_name, CAST(1 AS INTEGER) AS days_present FROM part"
    ),
    "silver_overwrite_broken": "SELECT p_partkey, p_name, p_size, true AS failed FROM part",
    "silver_overwrite_cut_short": f"SELECT p_partkey, {clean_sql('p_name')} AS p_name FROM part",
    "run_bronze": f"SELECT {_TEXT_BIOS} FROM ({domain.BIOGRAPHIES_SQL})",
    "run_bronze_results": f"SELECT {_TEXT_RESULTS} FROM ({domain.RESULTS_SQL})",
    "run_silver": f"SELECT {_CLEANED} FROM ({domain.RESULTS_SQL})",
    "run_gold": _gold_sql(1),
    "gold_write": _gold_sql(1),
    "run_medallion": _gold_sql(1),
    "run_medallion_two_landings": _gold_sql(2),
    "run_medallion_latest": _gold_sql(1),
    "run_medallion_resumed": f"SELECT *, CAST(2 AS INTEGER) AS steps FROM ({_gold_sql(1)})",
    "run_medallion_late_landing": f"SELECT *, CAST(3 AS INTEGER) AS steps FROM ({_gold_sql(1)})",
}
