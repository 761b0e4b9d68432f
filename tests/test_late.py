"""Results and biographies in any order."""

import json
import time

import pytest

from tallystream.operators import clean_biography, enrich_agg, enrich_join, latest_per_key
from tallystream.functions import parse_envelope
from tallystream.schemas import RESULT_EVENT
from tallystream.sinks import log_sink, write_topic
from tallystream.sources import file_topic, read_topic, stream_topic
from tallystream.streaming import start_enrichment, start_joining, tally_stream, wait_for_biographies

NOW = {"availableNow": True}
BIO = "athlete_id string, height string, weight string, sex string, country_noc string"


def bio(athlete, height="1,80", sex="F"):
    return (str(athlete), height, "75,5", sex, "UKR")


def record(athlete, medal="Gold"):
    return json.dumps({"athlete_id": athlete, "sport": "judo", "medal": medal})


class Job:
    def __init__(self, spark, base):
        self.spark, self.base = spark, f"file:{base}"
        self.topic, self.bios = file_topic(f"{self.base}/in"), f"{self.base}/bios"
        self.output = f"{self.base}/joined"
        self.receive([])

    def send(self, values):
        frame = self.spark.createDataFrame([("k", v) for v in values], "key string, value string")
        write_topic(frame.coalesce(1), self.topic)

    def receive(self, bios):
        self.spark.createDataFrame(bios, BIO).coalesce(1).write.mode("append").parquet(self.bios)

    def joined(self, **options):
        schema = self.spark.createDataFrame([], BIO).schema
        streams = stream_topic(self.spark, self.topic), self.spark.readStream.schema(schema).parquet(self.bios)
        return wait_for_biographies(*streams, **options)

    def run(self, **options):
        joined = self.joined(**options)
        start_joining(joined, self.output, f"{self.base}/cp", trigger=NOW).awaitTermination()
        self.schema = joined.schema

    def rows(self):
        return self.spark.read.schema(self.schema).parquet(self.output)

    def seen(self):
        columns = ["athlete_id", "medal", "sex", "matched"]
        return sorted((tuple(r) for r in self.rows().select(*columns).collect()), key=str)


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, tmp_path)


@pytest.mark.parametrize("options", [{}, {"spread": 3}, {"spread": 3, "hot": [1]}])
def test_either_side_may_come_first(job, spark, options):
    job.receive([bio(1)])
    job.send([record(1), record(2), record(3), "not json"])
    job.run(**options)
    assert job.seen() == [(1, "Gold", "F", True)]
    job.receive([bio(2), bio(2, height="1,90", sex="M"), bio(3, height="")])  # two copies, one unreadable
    job.run(**options)
    job.send([record(2, medal=None), record(1, medal="Silver")])
    job.run(**options)
    everything = parse_envelope(read_topic(spark, job.topic), RESULT_EVENT)
    biography = clean_biography(spark.read.parquet(job.bios))
    want = enrich_join(everything, biography)
    assert sorted(map(tuple, job.rows().select(*want.columns).collect()), key=str) == sorted(
        map(tuple, want.collect()), key=str
    )
    assert job.rows().count() == 6


def test_totals_are_those_of_the_batch(job, spark):
    log = f"{job.base}/log"
    for run, (records, bios) in enumerate([([record(1), record(2)], [bio(1)]), ([record(1)], [bio(2)]), ([], [])]):
        if records:
            job.send(records)
            job.receive(bios)
        job.run()
        tallies = tally_stream(spark, job.output, job.schema)
        start_enrichment(tallies, [log_sink(f"{log}/run={run}")], f"{job.base}/cp2", trigger=NOW).awaitTermination()
    totals = latest_per_key(spark.read.parquet(log)).drop("run", "batch_id", "timestamp")
    everything = parse_envelope(read_topic(spark, job.topic), RESULT_EVENT)
    want = enrich_agg(everything, clean_biography(spark.read.parquet(job.bios))).drop("timestamp")
    assert totals.select(*want.columns).collect() == want.collect()
    assert totals.first()["athlete_count"] == 3


def test_patience_ends(job):
    """A result waits for some seconds and is given up then, once, whatever comes."""
    job.receive([bio(1)])
    job.send([record(1), record(2), record(3)])
    job.run(patience="8 seconds")
    assert job.seen() == [(1, "Gold", "F", True)]
    job.receive([bio(2)])
    job.run(patience="8 seconds")
    assert job.seen() == [(1, "Gold", "F", True), (2, "Gold", "F", True)]
    time.sleep(9)
    for medal in ("Silver", "Bronze"):  # the clock moves on with any record
        job.send([record(1, medal=medal)])
        job.run(patience="8 seconds")
    job.receive([bio(3)])  # too late to be of use, but for new results
    job.send([record(3, medal="Silver")])
    job.run(patience="8 seconds")
    assert job.seen() == [
        (1, "Bronze", "F", True), (1, "Gold", "F", True), (1, "Silver", "F", True),
        (2, "Gold", "F", True), (3, "Gold", None, False), (3, "Silver", "F", True),
    ]


def test_the_setting_of_the_session_stays(job, spark):
    policy = "spark.sql.streaming.multipleWatermarkPolicy"
    before = spark.conf.get(policy)
    job.send([record(1)])
    job.run(patience="1 hour")
    assert spark.conf.get(policy) == before


def test_the_join_runs_on_the_jvm(job, capsys):
    job.send([record(1)])
    job.joined(patience="1 hour", spread=4, hot=[1]).explain()
    plan = capsys.readouterr().out
    assert "StreamingSymmetricHashJoin" in plan and "LeftOuter" in plan and "salt" in plan
    assert "Python" not in plan


def test_missing_columns_are_an_error(job, spark):
    job.send([record(1)])
    bios = spark.readStream.schema("athlete_id string, height string").parquet(job.bios)
    with pytest.raises(ValueError, match="lacks the columns"):
        wait_for_biographies(stream_topic(spark, job.topic), bios)
