"""The continuous job, fed in waves from the ``events`` table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.functions import parse_envelope
from tallystream.operators import clean_biography, enrich_agg, hot_athletes, latest_per_key
from tallystream.operators.enrich import KEY
from tallystream.schemas import ENRICHED_TALLY, RESULT_EVENT, STAMPED_TALLY
from tallystream.scratch import new_dir
from tallystream.sinks import log_sink, replay_publish, topic_sink
from tallystream.sources import Topic, file_topic, read_topic, stream_topic
from tallystream.sources.paths import file_count
from tallystream.streaming import enrichment_stream, follow_topic, start_enrichment
from tallystream.workload import domain
from tallystream.workload.joins import rounded

NOW = {"availableNow": True}

# A result record that carries its own time.
RECORD = T.StructType([*RESULT_EVENT.fields, T.StructField("at", T.StringType())])


class Job:
    """Folders of one run of the continuous job."""

    def __init__(self, spark: SparkSession, sf_dir: str, label: str, skewed: bool = False) -> None:
        self.spark, self.sf_dir, self.skewed = spark, sf_dir, skewed
        self.base = new_dir(spark, label)
        self.topic = file_topic(f"{self.base}/in")
        self.out = file_topic(f"{self.base}/out")
        self.log = f"{self.base}/log"

    def publish(self, waves: range) -> None:
        """Publish the rows of some waves; each row of ``events`` belongs to one wave."""
        rows = domain.results(
            self.spark,
            self.sf_dir,
            f"{domain.WAVE} AS wave",
            "event_id AS offset",
            "concat(CAST(ts AS STRING), 'Z') AS at",
        )
        if self.skewed:
            rows = domain.skewed_records(rows)
        chosen = rows.filter(F.col("wave").between(waves.start, waves.stop - 1)).drop("wave")
        replay_publish(chosen, self.topic, keep=["offset"])

    def run(
        self, run: int = 0, topic: Topic | None = None, output_mode: str = "update", **options
    ) -> None:
        """Consume what the topic holds, from where the last run stopped.

        The log tells the runs apart. If the biographies are too large to broadcast,
        the records of athletes that hold over 1% of them are salted.
        """
        records = parse_envelope(read_topic(self.spark, self.topic), RECORD, [KEY])
        tallies = enrichment_stream(
            stream_topic(self.spark, topic or self.topic),
            domain.biographies(self.spark, self.sf_dir),
            schema=RECORD,
            **{"hot": partial(hot_athletes, records), **options},
        )
        sinks = [topic_sink(self.out), log_sink(f"{self.log}/run={run}")]
        query = start_enrichment(
            tallies, sinks, f"{self.base}/checkpoint", trigger=NOW, output_mode=output_mode
        )
        query.awaitTermination()

    def totals(self) -> DataFrame:
        log = self.spark.read.parquet(self.log)
        return rounded(latest_per_key(log).drop("run", "batch_id"))


def streamed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of a topic, followed as a stream, parsed and stored."""
    job = Job(spark, sf_dir, "records")
    job.publish(range(domain.WAVES))
    records = stream_topic(spark, job.topic).selectExpr("CAST(value AS STRING)")
    parsed = parse_envelope(records, RESULT_EVENT)
    writer = parsed.writeStream.format("parquet").trigger(**NOW)
    query = writer.option("checkpointLocation", f"{job.base}/checkpoint").start(job.log)
    query.awaitTermination()
    return spark.read.parquet(job.log)


def final_totals(
    spark: SparkSession, sf_dir: str, skewed: bool = False, stored: bool = False, **options
) -> DataFrame:
    """One run that takes the topic in several micro-batches."""
    job = Job(spark, sf_dir, "stream", skewed)
    if stored:
        options["profiles"] = f"{job.base}/profiles"
    for wave in range(domain.WAVES):
        job.publish(range(wave, wave + 1))
    files = file_count(spark, job.topic.path) // domain.WAVES
    topic = file_topic(job.topic.path, maxFilesPerTrigger=str(max(files, 1)))
    job.run(topic=topic, **options)
    return job.totals()


def final_totals_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, without a broadcast and with salts for all athletes."""
    return final_totals(spark, sf_dir, broadcast_limit=0, hot=None)


def final_totals_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a broadcast, a third of the records being one athlete's; only the dominant
    athletes are salted, and the biographies are cleaned and grouped once."""
    return final_totals(spark, sf_dir, skewed=True, stored=True, broadcast_limit=0)


def final_totals_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, the biographies stored in the buckets in which the join takes them."""
    return final_totals(
        spark, sf_dir, skewed=True, stored=True, broadcast_limit=0, profile_buckets=8
    )


def resumed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, more records, and a second run from the same checkpoint."""
    job = Job(spark, sf_dir, "resume")
    job.publish(range(0, 1))
    job.run()
    job.publish(range(1, domain.WAVES))
    job.run(1)
    return job.totals()


def update_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each wave emitted: the groups it touched, with running totals."""
    job = Job(spark, sf_dir, "updates")
    for wave in range(domain.WAVES):
        job.publish(range(wave, wave + 1))
        job.run(wave)
    log = spark.read.parquet(job.log).drop("batch_id")
    return rounded(log.withColumn("wave", F.col("run").cast("long")).drop("run"))


def closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tallies per day of the records' own time, each emitted once its day is over."""
    job = Job(spark, sf_dir, "windows")
    job.publish(range(domain.WAVES))
    job.run(output_mode="append", window="1 day", watermark="1 minute", event_time="at")
    log = spark.read.parquet(job.log).drop("run", "batch_id")
    days = log.withColumn("day", F.unix_seconds("window_start"))
    return rounded(days.drop("window_start", "window_end"))


def fanned_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each emitted row arrived at either sink of the fan-out."""
    job = Job(spark, sf_dir, "fanout")
    for wave in range(domain.WAVES):
        job.publish(range(wave, wave + 1))
        job.run(wave)
    columns = ["sport", "medal", "sex", "bio_country_noc", "athlete_count"]
    log = spark.read.parquet(job.log)
    logged = log.select(*columns, F.lit(1).alias("log"), F.lit(0).alias("topic"))
    records = parse_envelope(read_topic(spark, job.out), ENRICHED_TALLY)
    sent = records.select(*columns, F.lit(0).alias("log"), F.lit(1).alias("topic"))
    return (
        logged.unionAll(sent)
        .groupBy(*columns)
        .agg(F.sum("log").alias("in_log"), F.sum("topic").alias("in_topic"))
    )


def sent_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of each wave, sent to a topic; two batches are sent again, one of them after the
    next. The reader, restarted in between, keeps each record once."""
    job = Job(spark, sf_dir, "twice")
    biography = clean_biography(domain.biographies(spark, sf_dir))
    results = domain.results(spark, sf_dir, f"{domain.WAVE} AS wave")
    sink = topic_sink(job.out, stamped=True)
    output = f"{job.base}/followed"
    for waves in ((0, 0), (1, 0), (2, 1, 2)):
        for wave in waves:
            sink(enrich_agg(results.filter(f"wave <= {wave}"), biography), wave)
        follow_topic(
            stream_topic(spark, job.out), STAMPED_TALLY, f"{job.base}/checkpoint", output,
            once_within="1 hour", trigger=NOW,
        ).awaitTermination()
    rows = spark.read.parquet(output).select("value.*").drop("record_id")
    return rounded(rows.withColumnRenamed("batch_id", "wave"))


QUERIES = {
    "topic_once": sent_twice,
    "topic_stream": streamed_records,
    "stream_enrich_agg": final_totals,
    "stream_enrich_agg_salted": final_totals_salted,
    "stream_enrich_agg_hot": final_totals_hot,
    "stream_enrich_agg_bucketed": final_totals_bucketed,
    "stream_resume": resumed_totals,
    "stream_update_log": update_log,
    "stream_windowed_agg": closed_windows,
    "fanout_batch": fanned_out,
}

_UPDATES = f"""
    SELECT w.wave, {domain.TALLY_COLUMNS_SQL}
    FROM (SELECT DISTINCT {domain.WAVE} AS wave FROM events) w
    JOIN ({domain.JOINED_SQL}) j ON j.wave <= w.wave
    GROUP BY w.wave, sport, medal, sex, bio_country_noc
    HAVING max(j.wave) = w.wave
"""

_DAY = "CAST(floor(epoch(ts) / 86400) * 86400 AS BIGINT)"

ORACLES = {
    "topic_once": f"""
        SELECT w.wave, {domain.TALLY_COLUMNS_SQL}
        FROM (SELECT DISTINCT {domain.WAVE} AS wave FROM events) w
        JOIN ({domain.JOINED_SQL}) j ON j.wave <= w.wave
        GROUP BY w.wave, sport, medal, sex, bio_country_noc
    """,
    "topic_stream": f"SELECT {', '.join(domain.RESULTS)} FROM ({domain.RESULTS_SQL})",
    "stream_enrich_agg": domain.TALLY_SQL,
    "stream_enrich_agg_salted": domain.TALLY_SQL,
    "stream_enrich_agg_hot": domain.SKEWED_TALLY_SQL,
    "stream_enrich_agg_bucketed": domain.SKEWED_TALLY_SQL,
    "stream_resume": domain.TALLY_SQL,
    "stream_update_log": _UPDATES,
    "stream_windowed_agg": f"""
        SELECT {_DAY} AS day, {domain.TALLY_COLUMNS_SQL}
        FROM ({domain.JOINED_SQL}) j JOIN events e ON j.result_id = CAST(e.event_id AS VARCHAR)
        GROUP BY day, sport, medal, sex, bio_country_noc
        HAVING {_DAY} + 86400 <= (SELECT epoch(max(ts)) - 60 FROM events)
    """,
    "fanout_batch": f"""
        SELECT sport, medal, sex, bio_country_noc, athlete_count,
               count(*) AS in_log, count(*) AS in_topic
        FROM ({_UPDATES}) GROUP BY ALL
    """,
}
