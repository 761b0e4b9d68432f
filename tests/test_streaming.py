"""Real streaming queries over a folder that stands in for a topic."""

import json
from functools import partial

import pytest
from pyspark.sql import types as T

from tallystream.functions import parse_envelope
from tallystream.operators import clean_biography, enrich_agg, hot_athletes, latest_per_key
from tallystream.schemas import ENRICHED_TALLY, RESULT_EVENT, TOPIC_RECORD
from tallystream.sinks import fanout_batch, log_sink, replay_publish, topic_sink, write_topic
from tallystream.sources import file_topic, kafka_topic, read_topic, stream_topic
from tallystream.streaming import (
    enrichment_stream,
    follow_topic,
    keep_enriching,
    start_enrichment,
)

NOW = {"availableNow": True}
BIO = "athlete_id string, height string, weight string, sex string, country_noc string"
BIOS = [
    ("1", "1,80", "75,5", "F", "UKR"),
    ("2", "", None, "M", "UKR"),
    ("4", "180", "80", "M", "POL"),
    ("4", "181", "82", "M", "POL"),
]


def record(athlete, sport="judo", medal="Gold", **more):
    return json.dumps({"athlete_id": athlete, "sport": sport, "medal": medal, **more})


FIRST = [record(1), record(1), record(4, medal=None), record(2), "not json", "", "null", record("1")]
SECOND = [record(1, extra={"a": 1})]
GARBAGE = ["not json", "[1]", record("7")]


class Stage:
    """Topic, biography and log of one test."""

    def __init__(self, spark, base):
        self.spark = spark
        self.base = f"file:{base}"
        self.topic = file_topic(f"{self.base}/in")
        self.bio = spark.createDataFrame(BIOS, BIO)

    def send(self, values):
        df = self.spark.createDataFrame([("k", v) for v in values], "key string, value string")
        write_topic(df.coalesce(1), self.topic)

    def tallies(self, **options):
        return enrichment_stream(stream_topic(self.spark, self.topic), self.bio, **options)

    def run(self, sinks, output_mode="update", **options):
        query = start_enrichment(
            self.tallies(**options), sinks, f"{self.base}/cp", trigger=NOW, output_mode=output_mode
        )
        query.awaitTermination()
        return query


@pytest.fixture
def stage(spark, tmp_path):
    return Stage(spark, tmp_path)


def collector(into):
    def sink(df, batch_id):
        into.append({(r["sport"], r["medal"]): r["athlete_count"] for r in df.collect()})

    return sink


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_updates_are_running_totals_of_touched_groups(stage, limit):
    seen = []
    for batch in (FIRST, SECOND, GARBAGE):
        stage.send(batch)
        stage.run([collector(seen)], broadcast_limit=limit)
    assert seen == [{("judo", "Gold"): 2, ("judo", None): 2}, {("judo", "Gold"): 3}]


def test_a_restart_may_choose_the_other_join(stage):
    """State and offsets do not depend on whether the biography was broadcast."""
    seen = []
    for batch, limit in ((FIRST, 1 << 20), (SECOND, 0), (SECOND, 1 << 20)):
        stage.send(batch)
        stage.run([collector(seen)], broadcast_limit=limit)
    assert [s["judo", "Gold"] for s in seen] == [2, 3, 4]


def test_the_job_is_defined_anew_every_so_often(stage, spark):
    """The second round sees an athlete whose biography came after the first."""
    seen = []
    waiting = [(FIRST, BIOS), ([record(9)], [*BIOS, ("9", "170", "70", "F", "UKR")])]

    def define():
        values, bios = waiting.pop(0)
        stage.send(values)
        stage.bio = spark.createDataFrame(bios, BIO)
        return stage.tallies()

    keep_enriching(define, [collector(seen)], f"{stage.base}/cp", seconds=12, rounds=2)
    assert seen == [{("judo", "Gold"): 2, ("judo", None): 2}, {("judo", "Gold"): 3}]
    assert not spark.streams.active


def test_a_job_that_ends_by_itself_is_not_restarted(stage):
    stage.send(FIRST)
    calls = []

    def define():
        calls.append(1)
        return stage.tallies()

    keep_enriching(define, [], f"{stage.base}/cp", seconds=60, trigger=NOW)
    assert calls == [1]


def test_partitions_of_a_batch_are_merged(stage, spark):
    parts = []
    deliver = fanout_batch(
        [lambda df, _: parts.append(df.rdd.getNumPartitions())], rows_per_task=10
    )
    for rows in (0, 5, 25):
        deliver(spark.range(rows).repartition(8), rows)
    assert parts == [1, 3]


def test_several_batches_in_one_run(stage):
    for batch in (FIRST, SECOND, GARBAGE):
        stage.send(batch)
    stage.topic = file_topic(f"{stage.base}/in", maxFilesPerTrigger="1")
    seen = []
    query = stage.run([collector(seen)])
    assert seen == [{("judo", "Gold"): 2, ("judo", None): 2}, {("judo", "Gold"): 3}]
    assert query.lastProgress["batchId"] >= 2


def test_a_failed_batch_is_repeated_without_duplicates(stage, spark):
    """The second sink fails after the first has written; a restart repeats the batch."""
    log = f"{stage.base}/log"
    stage.send(FIRST)
    stage.run([log_sink(log)])
    stage.send(SECOND)

    def broken(df, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        stage.run([log_sink(log), broken])
    assert spark.read.parquet(log).select("batch_id").distinct().count() == 2
    stage.run([log_sink(log)])

    rows = spark.read.parquet(log)
    assert rows.count() == 3
    final = {(r["sport"], r["medal"]): r for r in latest_per_key(rows).collect()}
    everything = parse_envelope(read_topic(spark, stage.topic), RESULT_EVENT)
    batch = enrich_agg(everything, clean_biography(stage.bio)).collect()
    assert len(final) == len(batch)
    for row in batch:
        got = final[row["sport"], row["medal"]]
        for column in ("avg_height", "avg_weight", "athlete_count", "sex", "bio_country_noc"):
            assert got[column] == row[column]


def test_window_and_watermark_expire_state(stage):
    """Event time from the record: append mode emits a window once it is closed."""
    schema = T.StructType([*RESULT_EVENT.fields, T.StructField("at", T.StringType())])
    emitted = []

    def sink(df, batch_id):
        emitted.extend((r["window_start"].minute, r["athlete_count"]) for r in df.collect())

    run = partial(
        stage.run, [sink], output_mode="append", window="10 minutes", event_time="at", schema=schema
    )
    stage.send([record(1, at="2024-08-04 10:01:00"), record(1, at="2024-08-04 10:02:00")])
    run()
    assert emitted == []
    stage.send([record(1, at="2024-08-04 10:31:00"), record(1, at="soon")])
    run()
    stage.send([record(1, at="2024-08-04 10:32:00"), record(1, at="2024-08-04 10:03:00")])
    run()
    assert emitted == [(0, 2)]


def test_unwindowed_append_is_refused(stage):
    stage.send(FIRST)
    with pytest.raises(Exception, match="STREAMING_OUTPUT_MODE"):
        stage.run([], output_mode="append")


def test_salts_depend_on_the_topic_position(stage, capsys):
    """Without a broadcast the rows of one athlete go to many join partitions."""
    stage.send(FIRST)
    stage.tallies(broadcast_limit=0, spread=8).explain()
    plan = capsys.readouterr().out
    assert "pmod(xxhash64(partition" in plan and "offset" in plan
    assert "Generate explode(" in plan and "salt" in plan
    assert "SortMergeJoin" in plan


def test_only_hot_athletes_are_salted(stage, capsys):
    seen = []
    for batch in (FIRST, SECOND):
        stage.send(batch)
        stage.run([collector(seen)], broadcast_limit=0, hot=[1], spread=4)
    assert seen == [{("judo", "Gold"): 2, ("judo", None): 2}, {("judo", "Gold"): 3}]
    results = parse_envelope(read_topic(stage.spark, stage.topic), RESULT_EVENT)
    assert hot_athletes(results, 0.5) == [1]
    assert sorted(hot_athletes(results, 0.1)) == [1, 2, 4]


def test_large_biographies_are_stored_once(stage, capsys):
    """Micro-batches read the stored copy; its exchange is the only one of the biographies."""
    profiles = f"{stage.base}/profiles"
    seen = []
    for batch in (FIRST, SECOND):
        stage.send(batch)
        stage.run([collector(seen)], broadcast_limit=0, hot=[1], profiles=profiles)
    assert seen == [{("judo", "Gold"): 2, ("judo", None): 2}, {("judo", "Gold"): 3}]
    capsys.readouterr()
    stage.tallies(broadcast_limit=0, hot=[1], profiles=profiles).explain()
    plan = capsys.readouterr().out
    assert "bio_country_noc:string,sum_height:double" in plan  # what the scan reads
    assert plan.count("Exchange hashpartitioning(athlete_id") == 2  # one for each side


@pytest.mark.parametrize("hot", [None, [1]])
def test_bucketed_biographies_are_not_moved(stage, capsys, hot):
    """Of a micro-batch's join only the records pass an exchange, and into the buckets."""
    options = {"broadcast_limit": 0, "hot": hot, "spread": 3, "profile_buckets": 5}
    options["profiles"] = f"{stage.base}/profiles"
    seen = []
    for batch in (FIRST, SECOND):
        stage.send(batch)
        stage.run([collector(seen)], **options)
    assert seen == [{("judo", "Gold"): 2, ("judo", None): 2}, {("judo", "Gold"): 3}]
    capsys.readouterr()
    stage.tallies(**options).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning(athlete_id") == 1
    assert "Bucketed: true" in plan and "salt" in plan
    join, rest = plan[: plan.index("SortMergeJoin")], plan[plan.index("SortMergeJoin") :]
    assert rest.count("Exchange") == 1 and ", 5)" in rest[rest.index("Exchange") :].splitlines()[0]
    assert join.count("Exchange hashpartitioning(sport") == 1


def test_small_biographies_are_not_stored(stage):
    profiles = f"{stage.base}/profiles"
    stage.send(FIRST)
    stage.tallies(profiles=profiles)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        stage.spark.read.parquet(profiles)


def test_fan_out_delivers_equal_rows_and_skips_empty_batches(stage, spark, capsys):
    out, log = file_topic(f"{stage.base}/out"), f"{stage.base}/log"
    deliver = fanout_batch([topic_sink(out), log_sink(log)], preview_rows=5)
    rows = spark.createDataFrame(
        [("judo", None, 1), (None, "Gold", 2)], "sport string, medal string, athlete_count long"
    )
    deliver(rows.limit(0), 0)
    deliver(rows, 1)
    assert "athlete_count" in capsys.readouterr().out
    records = read_topic(spark, out)
    assert {r["key"] and bytes(r["key"]) for r in records.collect()} == {b"judo", None}
    sent = parse_envelope(records, ENRICHED_TALLY, ["sport", "medal", "athlete_count"])
    assert sorted(map(str, sent.collect())) == sorted(map(str, rows.collect()))
    assert spark.read.parquet(log).select("batch_id").distinct().collect() == [(1,)]
    assert not rows.is_cached


def test_replay_allows_missing_ids(spark, tmp_path):
    topic = file_topic(f"file:{tmp_path}/t")
    rows = spark.createDataFrame([(1, "judo"), (None, "luge")], "athlete_id int, sport string")
    replay_publish(rows, topic)
    records = read_topic(spark, topic).selectExpr("CAST(key AS STRING) k", "CAST(value AS STRING) v")
    assert {tuple(r) for r in records.collect()} == {
        ("1", '{"athlete_id":1,"sport":"judo"}'),
        (None, '{"sport":"luge"}'),
    }
    assert read_topic(spark, topic).schema == TOPIC_RECORD


def test_follow_topic_remembers_its_position(stage, spark):
    cp = f"{stage.base}/follow"
    for expected in (8, 1):
        stage.send(FIRST if expected == 8 else SECOND)
        query = follow_topic(
            stream_topic(spark, stage.topic), RESULT_EVENT, cp, f"{stage.base}/followed", trigger=NOW
        )
        query.awaitTermination()
        assert sum(p["numInputRows"] for p in query.recentProgress) == expected
    assert spark.read.parquet(f"{stage.base}/followed").count() == 9


def test_a_table_of_a_topic_starts_with_the_first_record():
    topic = kafka_topic("a:9092", "results", starting_offsets="latest")
    assert topic.read_options["startingOffsets"] == "latest"
    assert topic.table_options() == {**topic.read_options, "startingOffsets": "earliest"}
    given = kafka_topic("a:9092", "results", starting_offsets='{"results":{"0":5}}')
    assert given.table_options() == given.read_options


def test_kafka_options_are_on_the_side_that_reads_them():
    topic = kafka_topic(
        "a:9092,b:9092", "results", security_protocol="SASL_SSL",
        read_options={"maxOffsetsPerTrigger": "1000000"},
    )
    tolerant = kafka_topic("a:9092", "results", fail_on_data_loss=False)
    assert tolerant.read_options["failOnDataLoss"] == "false"
    assert topic.format == "kafka" and topic.path is None and topic.schema is None
    assert topic.read_options == {
        "kafka.bootstrap.servers": "a:9092,b:9092",
        "kafka.security.protocol": "SASL_SSL",
        "subscribe": "results",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "1000000",
    }
    assert topic.write_options == {
        "kafka.bootstrap.servers": "a:9092,b:9092",
        "kafka.security.protocol": "SASL_SSL",
        "topic": "results",
        "kafka.retries": "5",
        "kafka.request.timeout.ms": "60000",
    }
