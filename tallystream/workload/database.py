"""Scans and appends of an external database.

The database is the one named by ``spark.tallystream.jdbc.url`` and ``.driver`` (and
``.user``, ``.password``). Without that setting, and on a single machine only, the
in-memory database that ships with Spark serves, inside Spark's own process; the
executors of a cluster could not see it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.operators import clean_biography, enrich_agg, latest_per_key
from tallystream.scratch import new_dir
from tallystream.sinks import JdbcLedger, jdbc_append, jdbc_sink, replay_publish, topic_sink
from tallystream.sources import Database, file_topic, jdbc_scan, stream_topic
from tallystream.streaming import enrichment_stream, start_enrichment
from tallystream.workload import domain
from tallystream.workload.joins import rounded

SETTING = "spark.tallystream.jdbc"


def configured_database(spark: SparkSession) -> Database:
    url = spark.conf.get(f"{SETTING}.url", None)
    if url:
        return Database(
            url,
            spark.conf.get(f"{SETTING}.driver"),
            spark.conf.get(f"{SETTING}.user", ""),
            spark.conf.get(f"{SETTING}.password", ""),
        )
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {SETTING}.url and .driver to a database all executors reach")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    return Database(
        "jdbc:derby:memory:tallystream;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    )


def _table(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results appended to a database table and read back in ranges of their number."""
    database, name = configured_database(spark), _table("results")
    rows = domain.results(spark, sf_dir, "event_id")
    jdbc_append(rows, database, name)
    return jdbc_scan(spark, database, name, partition_column="event_id")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tallies over a biography table that lives in the database."""
    database, name = configured_database(spark), _table("bio")
    raw = domain.biographies(spark, sf_dir)
    jdbc_append(raw.withColumn("athlete_id", F.col("athlete_id").cast("int")), database, name)
    biography = jdbc_scan(spark, database, name, partition_column="athlete_id")
    return rounded(enrich_agg(domain.results(spark, sf_dir), clean_biography(biography)))


def appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of running totals, the second delivered again after a restart."""
    database, name = configured_database(spark), _table("tallies")
    biography = clean_biography(domain.biographies(spark, sf_dir))
    results = domain.results(spark, sf_dir, f"{domain.WAVE} AS wave")
    first = enrich_agg(results.filter("wave = 0"), biography)
    everything = enrich_agg(results, biography)
    sink = jdbc_sink(database, name)
    sink(first, 0)
    sink(everything, 1)
    jdbc_sink(database, name)(everything, 1)
    log = jdbc_scan(spark, database, name, partition_column="batch_id")
    versions = log.groupBy("batch_id").agg(F.count("*").alias("rows_in_batch"))
    newest = latest_per_key(log)
    return rounded(newest.join(versions, "batch_id").drop("batch_id"))


def continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole continuous job: results replayed out of a table into a topic, followed
    as a stream, joined to a biography table, and delivered to a topic and a table."""
    database = configured_database(spark)
    bio, results, totals = _table("bio"), _table("results"), _table("totals")
    raw = domain.biographies(spark, sf_dir)
    jdbc_append(raw.withColumn("athlete_id", F.col("athlete_id").cast("int")), database, bio)
    jdbc_append(domain.results(spark, sf_dir, "event_id"), database, results)

    base = new_dir(spark, "continuous")
    topic, out = file_topic(f"{base}/in"), file_topic(f"{base}/out")
    table = jdbc_scan(spark, database, results, partition_column="event_id")
    replay_publish(table.withColumnRenamed("event_id", "offset"), topic, keep=["offset"])
    biography = jdbc_scan(spark, database, bio, partition_column="athlete_id")
    tallies = enrichment_stream(stream_topic(spark, topic), biography)
    sinks = [topic_sink(out), jdbc_sink(database, totals)]
    query = start_enrichment(tallies, sinks, f"{base}/checkpoint", trigger={"availableNow": True})
    query.awaitTermination()
    log = jdbc_scan(spark, database, totals)
    return rounded(latest_per_key(log).drop("batch_id"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of running totals: a task writes its rows twice, an attempt ends before it is
    committed, a batch comes again after a restart. The table holds each row once."""
    database, name = configured_database(spark), _table("ledger")
    biography = clean_biography(domain.biographies(spark, sf_dir))
    results = domain.results(spark, sf_dir, f"{domain.WAVE} AS wave")
    waves = [enrich_agg(results.filter(f"wave <= {w}"), biography) for w in range(domain.WAVES)]
    first = JdbcLedger(database, name)
    first(waves[0], 0)
    first.stage(waves[1].filter("sport < 'm'"), 1)  # ends here, with half of the batch
    again = JdbcLedger(database, name)
    again.stage(waves[1], 1)
    again.append_staged(waves[1].filter("medal = 'Gold'"), 1)  # tasks that were run again
    again.commit(waves[1], 1)
    again.commit(waves[1], 1)
    for sink in (again, JdbcLedger(database, name)):
        for wave in (1, 2):
            sink(waves[wave], wave)
    return rounded(jdbc_scan(spark, database, name).drop("job").withColumnRenamed("batch_id", "wave"))


QUERIES = {
    "jdbc_ledger": ledger,
    "jdbc_scan": scanned,
    "jdbc_enrich_agg": enriched,
    "jdbc_append": appended,
    "stream_enrich_jdbc": continuous,
}

ORACLES = {
    "jdbc_ledger": f"""
        SELECT w.wave, {domain.TALLY_COLUMNS_SQL}
        FROM (SELECT DISTINCT {domain.WAVE} AS wave FROM events) w
        JOIN ({domain.JOINED_SQL}) j ON j.wave <= w.wave
        GROUP BY w.wave, sport, medal, sex, bio_country_noc
    """,
    "jdbc_scan": f"SELECT event_id, {', '.join(domain.RESULTS)} FROM ({domain.RESULTS_SQL})",
    "jdbc_enrich_agg": domain.TALLY_SQL,
    "stream_enrich_jdbc": domain.TALLY_SQL,
    "jdbc_append": f"""
        SELECT *, (SELECT count(*) FROM ({domain.TALLY_SQL})) AS rows_in_batch
        FROM ({domain.TALLY_SQL})
    """,
}
