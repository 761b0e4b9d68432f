"""Topics with records that cannot be read, derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.functions import judge_envelope, to_envelope
from tallystream.operators import clean_biography, enrich_agg
from tallystream.schemas import RESULT_EVENT
from tallystream.scratch import new_dir
from tallystream.sinks import log_sink, write_topic
from tallystream.sources import file_topic, stream_topic
from tallystream.streaming import (
    MetricsLog,
    enrichment_stream,
    read_metrics,
    split_topic,
    start_enrichment,
)
from tallystream.workload import domain
from tallystream.workload.joins import rounded

# By the number of the event: what stands in for its record, and what is wrong with that.
_DAMAGE = {
    1: ("'not json at all'", "not_json"),
    2: ("concat('{\"athlete_id\":', event_id)", "not_json"),
    3: ("'  '", "empty"),
    4: ("CAST(NULL AS STRING)", "empty"),
    5: ("concat('[', event_id, ']')", "not_object"),
    6: ("'null'", "not_object"),
    7: ("concat('{\"sport\":\"judo\",\"athlete_id\":\"', event_id, 'x\"}')", "wrong_type"),
    8: ("'{\"sport\":\"judo\"}'", "missing_field"),
}
_EVERY = 23
_WHICH = f"event_id % {_EVERY}"
_VALUE = f"CASE {_WHICH} {' '.join(f'WHEN {k} THEN {v}' for k, (v, _) in _DAMAGE.items())} ELSE value END"
_FAULT = f"CASE {_WHICH} {' '.join(f"WHEN {k} THEN '{f}'" for k, (_, f) in _DAMAGE.items())} END"

FIELDS = ["athlete_id", "sport", "medal", "edition"]


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = domain.results(spark, sf_dir, "event_id")
    sent = to_envelope(rows, ["athlete_id"], keep=["event_id"])
    return sent.selectExpr("key", f"{_VALUE} AS value", "event_id AS offset")


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with each record."""
    rows = judge_envelope(_damaged(spark, sf_dir), RESULT_EVENT, FIELDS, ["offset"], ["athlete_id"])
    faulty = F.col("fault").isNotNull()
    return rows.select(
        "offset", "fault", F.when(faulty, F.col("value")).alias("value"),
        *[F.when(~faulty, F.col(c)).alias(c) for c in FIELDS],
    )


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Accepted and quarantined records of a topic, followed in several waves and restarts."""
    base = new_dir(spark, "quarantine")
    topic = file_topic(f"{base}/topic")
    accepted, quarantined = f"{base}/accepted", f"{base}/quarantined"
    for wave in range(domain.WAVES):
        write_topic(_damaged(spark, sf_dir).filter(f"offset % {domain.WAVES} = {wave}"), topic)
        split_topic(
            stream_topic(spark, topic), RESULT_EVENT, log_sink(accepted), log_sink(quarantined),
            f"{base}/checkpoint", fields=FIELDS, required=["athlete_id"], trigger={"availableNow": True},
        ).awaitTermination()
    return spark.read.parquet(accepted), spark.read.parquet(quarantined)


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two sides together: all records, each once."""
    accepted, quarantined = _split(spark, sf_dir)
    good = accepted.select("offset", F.lit(None).cast("string").alias("fault"), F.lit(None).cast("string").alias("value"), *FIELDS)
    return good.unionByName(quarantined.select("offset", "fault", "value"), allowMissingColumns=True)


def tallies_of_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment over the accepted side."""
    accepted, _ = _split(spark, sf_dir)
    return rounded(enrich_agg(accepted, clean_biography(domain.biographies(spark, sf_dir))))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of three waves had and what of it led to nothing, as a listener has kept it."""
    base = new_dir(spark, "metrics")
    topic, folder = file_topic(f"{base}/topic"), f"{base}/metrics"
    listener = MetricsLog(spark, folder, "enrichment")
    spark.streams.addListener(listener)
    try:
        for wave in range(domain.WAVES):
            write_topic(_damaged(spark, sf_dir).filter(f"offset % {domain.WAVES} = {wave}"), topic)
            tallies = enrichment_stream(
                stream_topic(spark, topic), domain.biographies(spark, sf_dir), metrics="enrichment"
            )
            query = start_enrichment(
                tallies, [log_sink(f"{base}/log/run={wave}")], f"{base}/checkpoint", trigger={"availableNow": True}
            )
            query.awaitTermination()
            listener.complete(query)
    finally:
        spark.streams.removeListener(listener)
    counts = ["records", "malformed", "without_athlete", "unmatched", "late"]
    return read_metrics(spark, folder).select(F.col("batch_id").alias("wave"), *counts)


QUERIES = {
    "stream_metrics": metrics,
    "records_judged": judged,
    "stream_quarantine": split,
    "enrich_agg_accepted": tallies_of_accepted,
}

_SPLIT = f"""
    SELECT event_id AS offset, {_FAULT} AS fault,
           CASE WHEN {_FAULT} IS NOT NULL THEN {_VALUE.replace("ELSE value", "ELSE NULL")} END AS value,
           {", ".join(f"CASE WHEN {_FAULT} IS NULL THEN {c} END AS {c}" for c in FIELDS)}
    FROM ({domain.RESULTS_SQL})
"""

_UNUSABLE = "('not_json', 'empty', 'not_object', 'wrong_type')"

ORACLES = {
    "stream_metrics": f"""
        SELECT wave, count(*) AS records,
               count(*) FILTER (fault IN {_UNUSABLE}) AS malformed,
               count(*) FILTER (fault = 'missing_field') AS without_athlete,
               count(*) FILTER (fault IS NULL AND athlete_id NOT IN (SELECT athlete_id FROM ({domain.CLEAN_BIO_SQL}))) AS unmatched,
               CAST(0 AS BIGINT) AS late
        FROM (SELECT *, {_FAULT} AS fault FROM ({domain.RESULTS_SQL})) GROUP BY wave
    """,
    "records_judged": _SPLIT,
    "stream_quarantine": _SPLIT,
    "enrich_agg_accepted": domain.TALLY_SQL.replace(
        domain.RESULTS_SQL, f"SELECT * FROM ({domain.RESULTS_SQL}) WHERE {_FAULT} IS NULL"
    ),
}
