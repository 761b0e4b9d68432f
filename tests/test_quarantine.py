"""Records that cannot be read are kept, and told apart."""

import json

import pytest

from tallystream import cli
from tallystream.functions import FAULTS, judge_envelope
from tallystream.schemas import RESULT_EVENT
from tallystream.sinks import log_sink, write_topic
from tallystream.sources import file_topic, stream_topic
from tallystream.streaming import split_records, split_topic

NOW = {"availableNow": True}
FIELDS = ["athlete_id", "sport", "edition", "isTeamSport"]

# value -> fault, athlete_id
RECORDS = [
    ('{"athlete_id":1}', None, 1),
    (' {"athlete_id":2,"extra":[1]}', None, 2),
    ('{"athlete_id":3,"edition":{"a":1},"isTeamSport":true}', None, 3),
    ("{'athlete_id':4}", None, 4),
    ('{"athlete_id":5,"pos":{"not":"in use"}}', None, 5),
    ("not json", "not_json", None),
    ('{"athlete_id":1', "not_json", None),
    ("", "empty", None),
    (" \t", "empty", None),
    (None, "empty", None),
    ("null", "not_object", None),
    ("[1]", "not_object", None),
    ('[{"athlete_id":1}]', "not_object", None),
    ('"s"', "not_object", None),
    ('{"athlete_id":"7"}', "wrong_type", None),
    ('{"athlete_id":12.7}', "wrong_type", None),
    ('{"athlete_id":99999999999}', "wrong_type", None),
    ('{"sport":"judo"}', "missing_field", None),
    ('{"athlete_id":null}', "missing_field", None),
    ("{}", "missing_field", None),
]


def frame(spark, records=RECORDS):
    rows = [(f"k{i}", r[0], i) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "key string, value string, offset long")


def test_each_record_has_its_fault(spark):
    judged = judge_envelope(frame(spark), RESULT_EVENT, FIELDS, ["offset"], ["athlete_id"])
    got = {r["offset"]: (r["value"], r["fault"], None if r["fault"] else r["athlete_id"]) for r in judged.collect()}
    assert got == dict(enumerate(RECORDS))
    assert {r[1] for r in RECORDS if r[1]} == set(FAULTS)
    lenient = judge_envelope(frame(spark), RESULT_EVENT, FIELDS)
    assert lenient.filter("fault IS NULL").count() == 8


def test_every_record_is_on_one_side(spark):
    accepted, quarantined = split_records(frame(spark), RESULT_EVENT, FIELDS, ["offset"], ["athlete_id"])
    assert accepted.columns == ["offset", *FIELDS]
    assert quarantined.columns == ["offset", "value", "fault"]
    both = [r["offset"] for side in (accepted, quarantined) for r in side.collect()]
    assert sorted(both) == list(range(len(RECORDS)))


def test_records_are_parsed_once(spark, capsys):
    accepted, _ = split_records(frame(spark), RESULT_EVENT, FIELDS, ["offset"], ["athlete_id"])
    accepted.explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json") == 1 and "PythonUDF" not in plan


@pytest.fixture
def topic(tmp_path):
    return file_topic(f"file:{tmp_path}/in")


def test_sides_without_records_are_not_delivered(spark, tmp_path, topic):
    seen = []

    def sink(name):
        return lambda df, batch_id: seen.append((name, batch_id, df.count(), df.rdd.getNumPartitions()))

    def run():
        split_topic(
            stream_topic(spark, topic), RESULT_EVENT, sink("accepted"), sink("quarantined"),
            f"file:{tmp_path}/cp", fields=FIELDS, required=["athlete_id"], trigger=NOW,
        ).awaitTermination()

    for records in (RECORDS, RECORDS[:5], RECORDS[5:9]):
        write_topic(frame(spark, records), topic)
        run()
    run()
    assert seen == [
        ("accepted", 0, 5, 1), ("quarantined", 0, 15, 1), ("accepted", 1, 5, 1), ("quarantined", 2, 4, 1),
    ]


def test_a_failed_batch_comes_again_whole(spark, tmp_path, topic):
    accepted, quarantined = f"file:{tmp_path}/accepted", f"file:{tmp_path}/quarantined"
    write_topic(frame(spark), topic)

    def run(last):
        split_topic(
            stream_topic(spark, topic), RESULT_EVENT, log_sink(accepted), last,
            f"file:{tmp_path}/cp", fields=FIELDS, required=["athlete_id"], trigger=NOW,
        ).awaitTermination()

    def broken(df, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        run(broken)
    run(log_sink(quarantined))
    assert spark.read.parquet(accepted).count() == 5
    assert spark.read.parquet(quarantined).count() == 15


@pytest.mark.parametrize("both", [True, False])
def test_command_line(spark, tmp_path, monkeypatch, both):
    monkeypatch.setattr(cli, "kafka_topic", lambda servers, name, **_: file_topic(f"file:{tmp_path}/{name}"))
    real = split_topic
    monkeypatch.setattr(cli, "split_topic", lambda *a, **k: real(*a, **k, trigger=NOW))
    good = json.dumps({"athlete_id": 1, "sport": "judo"})
    write_topic(frame(spark, [(good,), ("not json",), (good,)]), file_topic(f"file:{tmp_path}/in"))
    folder = f"file:{tmp_path}"
    more = ["--accepted", f"{folder}/good"] if both else []
    cli.main(
        ["quarantine", "--servers", "a:1", "--topic", "in", "--output", f"{folder}/bad", "--checkpoint", f"{folder}/cp", *more]
    )
    assert [r["fault"] for r in spark.read.parquet(f"{folder}/bad").collect()] == ["not_json"]
    assert (tmp_path / "good").exists() == both
    if both:
        assert spark.read.parquet(f"{folder}/good").count() == 2
