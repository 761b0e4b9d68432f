"""What batches report, and groups that leave the state."""

import json
import time

import pytest

from tallystream.functions import parse_envelope
from tallystream.operators import clean_biography, enrich_agg, latest_per_key
from tallystream.schemas import RESULT_EVENT
from tallystream.sinks import log_sink, write_topic
from tallystream.sources import file_topic, read_topic, stream_topic
from tallystream.streaming import (
    MetricsLog,
    batch_metrics,
    enrichment_stream,
    expiring_tallies,
    read_metrics,
    start_enrichment,
    start_expiring,
)
from pyspark.sql import types as T

NOW = {"availableNow": True}
BIO = "athlete_id string, height string, weight string, sex string, country_noc string"
BIOS = [("1", "1,80", "75,5", "F", "UKR"), ("2", "", None, "M", "UKR"), ("4", "180", "80", "M", "POL"), ("4", "181", "82", "M", "POL")]
TIMED = T.StructType([*RESULT_EVENT.fields, T.StructField("at", T.StringType())])


def record(athlete, sport="judo", medal="Gold", **more):
    return json.dumps({"athlete_id": athlete, "sport": sport, "medal": medal, **more})


class Job:
    def __init__(self, spark, base):
        self.spark, self.base = spark, f"file:{base}"
        self.topic, self.bio = file_topic(f"{self.base}/in"), spark.createDataFrame(BIOS, BIO)
        self.runs = 0

    def send(self, *values):
        frame = self.spark.createDataFrame([("k", v) for v in values], "key string, value string")
        write_topic(frame.coalesce(1), self.topic)

    def run(self, tallies, start=start_enrichment):
        sink = log_sink(f"{self.base}/log/run={self.runs}")
        self.runs += 1
        query = start(tallies, [sink], f"{self.base}/cp", trigger=NOW)
        assert query.awaitTermination(90), "the query should end by itself"
        return query

    def totals(self):
        rows = latest_per_key(self.spark.read.parquet(f"{self.base}/log"), version="run").collect()
        return {(r["sport"], r["medal"]): r["athlete_count"] for r in rows}


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, tmp_path)


FIRST = [record(1), record(1), record(4, medal=None), record(2), record(9), record(None), "not json", "", record("1")]


@pytest.mark.parametrize("options", [{}, {"broadcast_limit": 0}, {"broadcast_limit": 0, "hot": [1]}])
def test_counts_of_a_batch(job, spark, options):
    job.send(*FIRST)
    tallies = enrichment_stream(stream_topic(spark, job.topic), job.bio, metrics="m", **options)
    query = job.run(tallies)
    counts = batch_metrics(query.recentProgress[0], "m")
    kept = {k: counts[k] for k in ("records", "malformed", "without_athlete", "unmatched", "late", "state_rows")}
    assert kept == {"records": 9, "malformed": 3, "without_athlete": 1, "unmatched": 2, "late": 0, "state_rows": 2}
    assert job.totals() == {("judo", "Gold"): 2, ("judo", None): 2}
    assert batch_metrics(query.recentProgress[0], "another") is None


def test_a_listener_keeps_them_over_restarts(job, spark):
    folder = f"{job.base}/metrics"
    listener = MetricsLog(spark, folder, "m")
    spark.streams.addListener(listener)
    try:
        for values in (FIRST, [record(1), record(9)]):
            job.send(*values)
            query = job.run(enrichment_stream(stream_topic(spark, job.topic), job.bio, metrics="m"))
            listener.complete(query)
            listener.complete(query)
    finally:
        spark.streams.removeListener(listener)
    rows = sorted(tuple(r)[1:2] + tuple(r)[3:7] for r in read_metrics(spark, folder).collect())
    assert rows == [(0, 9, 3, 1, 2), (1, 2, 0, 0, 1)]


def test_late_rows_are_counted(job, spark):
    seen = []
    for at in ("10:01", "12:00", "10:02"):
        job.send(record(1, at=f"2024-08-04 {at}:00"))
        tallies = enrichment_stream(
            stream_topic(spark, job.topic), job.bio, schema=TIMED, event_time="at", window="10 minutes", metrics="m"
        )
        query = job.run(tallies)
        seen.append(sum(m["late"] for m in (batch_metrics(p, "m") for p in query.recentProgress) if m))
    assert seen == [0, 0, 1]


def test_nothing_is_observed_unless_asked_for(job, spark, capsys):
    job.send(record(1))
    enrichment_stream(stream_topic(spark, job.topic), job.bio, broadcast_limit=1 << 20).explain()
    assert "CollectMetrics" not in capsys.readouterr().out


@pytest.mark.parametrize("options", [{}, {"broadcast_limit": 0}, {"broadcast_limit": 0, "hot": [1], "spread": 3}])
def test_expiring_totals_are_those_of_the_batch(job, spark, options):
    for values in (FIRST, [record(1), record(4, sport=None), "[1]"]):
        job.send(*values)
        job.run(expiring_tallies(stream_topic(spark, job.topic), job.bio, 3600, **options), start_expiring)
    log = latest_per_key(spark.read.parquet(f"{job.base}/log"), version="run").drop("run", "batch_id", "timestamp")
    everything = parse_envelope(read_topic(spark, job.topic), RESULT_EVENT)
    want = enrich_agg(everything, clean_biography(job.bio)).drop("timestamp")
    assert sorted(map(str, log.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_idle_groups_leave_the_state(job, spark):
    def run(*values):
        job.send(*values)
        query = job.run(expiring_tallies(stream_topic(spark, job.topic), job.bio, 2), start_expiring)
        return query.recentProgress[0]["stateOperators"][0]["numRowsTotal"]

    assert run(record(1), record(1, sport="luge"), record(1, sport="golf")) == 3
    time.sleep(3)
    run(record(1))
    assert job.totals() == {("judo", "Gold"): 2, ("luge", "Gold"): 1, ("golf", "Gold"): 1}  # goes on
    assert run(record(1)) <= 1  # the others have left
    time.sleep(3)
    run(record(1, sport="luge"), record(1, sport="luge"))
    assert job.totals()["luge", "Gold"] == 2  # from nothing


def test_timers_fire_without_records(job, spark):
    job.send(record(1))
    tallies = expiring_tallies(stream_topic(spark, job.topic), job.bio, 1)
    query = start_expiring(tallies, [log_sink(f"{job.base}/log")], f"{job.base}/cp", trigger={"processingTime": "1 second"})
    try:
        end = time.time() + 60
        while time.time() < end:
            state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
            if 1 in state and state[-1] == 0:
                break
            time.sleep(0.5)
        assert 1 in state and state[-1] == 0
    finally:
        query.stop()


def test_rows_reach_the_state_summed_up(job, spark, capsys):
    job.send(record(1))
    expiring_tallies(stream_topic(spark, job.topic), job.bio, 60).explain()
    plan = capsys.readouterr().out
    assert plan.index("FlatMapGroupsInPandasWithState") < plan.index("MapInArrow") < plan.index("Join")
    with pytest.raises(ValueError):
        expiring_tallies(stream_topic(spark, job.topic), job.bio, 0)
