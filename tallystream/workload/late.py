"""The enrichment when biographies come later than results, in waves."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.operators import latest_per_key
from tallystream.sinks import log_sink, replay_publish
from tallystream.sources import stream_topic
from tallystream.streaming import (
    expiring_tallies,
    start_enrichment,
    start_expiring,
    start_joining,
    tally_stream,
    wait_for_biographies,
)
from tallystream.workload import domain
from tallystream.workload.joins import rounded
from tallystream.workload.streams import NOW, Job

# Sports that have no results in the second wave, and are alone in the third.
IDLE = "sport < 'd'"

# Every third athlete's biography comes one wave after the athlete's first results, every
# seventh's two waves; copies of a biography come together.
_WAVE = "CASE WHEN CAST(athlete_id AS INT) % 7 = 0 THEN 2 WHEN CAST(athlete_id AS INT) % 3 = 0 THEN 1 ELSE 0 END"


def _joined(spark: SparkSession, sf_dir: str, **options) -> tuple[Job, DataFrame]:
    """Three waves of results and biographies, each followed by a run of both queries."""
    job = Job(spark, sf_dir, "late")
    bios = domain.biographies(spark, sf_dir)
    folder, joined_rows = f"{job.base}/bios", f"{job.base}/joined"
    for wave in range(domain.WAVES):
        job.publish(range(wave, wave + 1))
        bios.filter(f"{_WAVE} = {wave}").write.mode("append").parquet(folder)
        joined = wait_for_biographies(
            stream_topic(spark, job.topic), spark.readStream.schema(bios.schema).parquet(folder),
            carry=["result_id"], **options,
        )
        start_joining(joined, joined_rows, f"{job.base}/joining", trigger=NOW).awaitTermination()
        tallies = tally_stream(spark, joined_rows, joined.schema)
        sink = log_sink(f"{job.log}/run={wave}")
        start_enrichment(tallies, [sink], f"{job.base}/checkpoint", trigger=NOW).awaitTermination()
    return job, spark.read.schema(joined.schema).parquet(joined_rows)


def late_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals as if all biographies had been there from the start."""
    job, _ = _joined(spark, sf_dir)
    return rounded(latest_per_key(spark.read.parquet(job.log)).drop("run", "batch_id"))


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined rows themselves, each once, results spread over salts, with a limit that nobody meets."""
    _, rows = _joined(spark, sf_dir, patience="30 days", spread=4)
    return rows.drop("athlete_id", "matched")


def expiring_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of some sports are idle while others go on, and are forgotten; when they come back
    they start from nothing. With the number of groups that the state holds in the end."""
    job = Job(spark, sf_dir, "expiring")
    rows = domain.results(spark, sf_dir, f"{domain.WAVE} AS wave", "event_id AS offset")
    for wave, sports in enumerate(("true", f"NOT ({IDLE})", IDLE)):
        replay_publish(rows.filter(f"wave = {wave} AND {sports}").drop("wave"), job.topic, keep=["offset"])
        tallies = expiring_tallies(
            stream_topic(spark, job.topic), domain.biographies(spark, sf_dir), idle_seconds=0.5
        )
        query = start_expiring(
            tallies, [log_sink(f"{job.log}/run={wave}")], f"{job.base}/checkpoint", trigger=NOW
        )
        query.awaitTermination()
        time.sleep(1)
    groups = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    log = spark.read.parquet(job.log).withColumn("batch_id", F.col("run"))
    return rounded(latest_per_key(log).drop("run", "batch_id")).withColumn("state_rows", F.lit(groups))


QUERIES = {
    "stream_enrich_expiring": expiring_totals,
    "stream_enrich_late": late_totals, "stream_join_late": late_rows}

_PHASED = f"""
    SELECT *, max(wave) OVER (PARTITION BY sport, medal, sex, bio_country_noc) AS newest
    FROM ({domain.JOINED_SQL}) WHERE wave = 0 OR (wave = 2) = ({IDLE})
"""

ORACLES = {
    "stream_enrich_expiring": f"""
        SELECT {domain.TALLY_COLUMNS_SQL},
               (SELECT count(*) FROM (SELECT DISTINCT sport, medal, sex, bio_country_noc FROM ({_PHASED}) WHERE wave = 2)) AS state_rows
        FROM ({_PHASED}) WHERE wave = newest OR NOT ({IDLE})
        GROUP BY sport, medal, sex, bio_country_noc
    """,
    "stream_enrich_late": domain.TALLY_SQL,
    "stream_join_late": (
        "SELECT sport, medal, result_id, sex, bio_country_noc, height, weight "
        f"FROM ({domain.JOINED_SQL})"
    ),
}
