"""Records to and from topics, with Parquet folders standing in for topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.functions import decode_topic, parse_envelope, to_envelope
from tallystream.schemas import ENRICHED_TALLY, RESULT_EVENT
from tallystream.scratch import new_dir
from tallystream.sinks import replay_publish, topic_sink
from tallystream.operators.versions import not_yet_present, tally_keys
from tallystream.sources import file_topic, read_topic, stream_topic
from tallystream.streaming import follow_topic
from tallystream.workload import domain
from tallystream.workload.joins import rounded, tallies


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["sport", "medal", "edition_id", "athlete_id", "event"]
    return to_envelope(domain.results(spark, sf_dir).select(*columns), ["sport"])


def envelope_full_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = domain.results(spark, sf_dir).select("sport", "medal", "edition_id")
    return to_envelope(rows, ["sport", "medal"])


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result table, written to a topic by all tasks and read back."""
    topic = file_topic(new_dir(spark, "replay"))
    replay_publish(domain.results(spark, sf_dir), topic)
    records = read_topic(spark, topic).selectExpr("CAST(key AS STRING) AS key", "value")
    return parse_envelope(records, RESULT_EVENT, keep=["key"])


def decoded_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = file_topic(new_dir(spark, "decode"))
    rows = domain.results(spark, sf_dir, "CAST(event_id % 4 AS INT) AS partition")
    replay_publish(rows, topic, keep=["partition"])
    decoded = decode_topic(read_topic(spark, topic), RESULT_EVENT)
    return decoded.select("partition", "key", "value.*")


def decoded_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = file_topic(new_dir(spark, "tallies"))
    topic_sink(topic)(tallies(spark, sf_dir), 0)
    decoded = decode_topic(read_topic(spark, topic), ENRICHED_TALLY)
    return rounded(decoded.select("key", "value.*"))


def followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of a topic, followed in several micro-batches and a restart."""
    folder = new_dir(spark, "follow")
    topic = file_topic(f"{folder}/topic")
    output = f"{folder}/records"
    for wave in range(domain.WAVES):
        rows = domain.results(spark, sf_dir, "CAST(event_id % 4 AS INT) AS partition", "event_id")
        replay_publish(rows.filter(f"{domain.WAVE} = {wave}").drop("event_id"), topic, keep=["partition"])
        if wave != 1:  # the second wave waits for the third
            follow_topic(
                stream_topic(spark, topic), RESULT_EVENT, f"{folder}/checkpoint", output,
                trigger={"availableNow": True},
            ).awaitTermination()
    return spark.read.parquet(output).select("partition", "key", "value.*")


def windows_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of windowed counts that is half present when it comes again."""
    keys = ["sport", "medal", "sex", "bio_country_noc", "window_start"]
    counts = (
        domain.results(spark, sf_dir, "event_id")
        .selectExpr("sport", "medal", "'F' AS sex", "country_noc AS bio_country_noc", "event_id % 5 AS window_start")
        .groupBy(*keys).agg(F.count("*").alias("athlete_count"))
    )
    present = counts.filter("window_start < 2")
    missing = not_yet_present(counts, present, tally_keys(counts))
    return present.withColumn("again", F.lit(False)).unionByName(missing.withColumn("again", F.lit(True)))


QUERIES = {
    "follow_topic": followed,
    "sink_completes_windows": windows_completed,
    "envelope_sink": envelope,
    "envelope_sink_full_key": envelope_full_key,
    "replay_publish": published,
    "topic_decode": decoded_results,
    "topic_decode_tallies": decoded_tallies,
}

_COLUMNS = ", ".join(domain.RESULTS)
_MEDAL = """CASE WHEN medal IS NULL THEN '' ELSE concat('"medal":"', medal, '",') END"""

ORACLES = {
    "follow_topic": (
        "SELECT CAST(event_id % 4 AS INTEGER) AS partition, CAST(athlete_id AS STRING) AS key, "
        f"{_COLUMNS} FROM ({domain.RESULTS_SQL})"
    ),
    "sink_completes_windows": (
        "SELECT sport, medal, 'F' AS sex, country_noc AS bio_country_noc, event_id % 5 AS window_start, "
        "count(*) AS athlete_count, event_id % 5 >= 2 AS again "
        f"FROM ({domain.RESULTS_SQL}) GROUP BY ALL"
    ),
    "envelope_sink": (
        f"""SELECT sport AS key, concat('{{"sport":"', sport, '",', {_MEDAL}, '"edition_id":', """
        f"""edition_id, ',"athlete_id":', athlete_id, ',"event":"', event, '"}}') AS value """
        f"FROM ({domain.RESULTS_SQL})"
    ),
    "envelope_sink_full_key": (
        """SELECT concat('{"sport":"', sport, '"', CASE WHEN medal IS NULL THEN '' """
        """ELSE concat(',"medal":"', medal, '"') END, '}') AS key, """
        f"""concat('{{"sport":"', sport, '",', {_MEDAL}, '"edition_id":', edition_id, '}}') """
        f"AS value FROM ({domain.RESULTS_SQL})"
    ),
    "replay_publish": (
        f"SELECT CAST(athlete_id AS STRING) AS key, {_COLUMNS} FROM ({domain.RESULTS_SQL})"
    ),
    "topic_decode": (
        "SELECT CAST(event_id % 4 AS INTEGER) AS partition, CAST(athlete_id AS STRING) AS key, "
        f"{_COLUMNS} FROM ({domain.RESULTS_SQL})"
    ),
    "topic_decode_tallies": f"SELECT sport AS key, * FROM ({domain.TALLY_SQL})",
}
