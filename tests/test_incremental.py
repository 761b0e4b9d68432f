"""Silver increments: each landing once, whatever happens in between."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest

from tallystream import cli
from tallystream.plans import (
    Layers,
    gold_of_increments,
    incremental,
    increments,
    read_increments,
    run_silver_increment,
)
from tallystream.plans.medallion import RESULTS
from tallystream.sinks import write_snapshot

RUN = datetime(2024, 8, 4, 8, 0, 0)
COLUMNS = "athlete_id string, sport string, country_noc string, medal string"


@pytest.fixture
def layers(tmp_path):
    return Layers.below(f"file:{tmp_path}")


def land(spark, layers, hour, ids, columns=COLUMNS, more=()):
    rows = [(str(i), "Judo!", "UKR", None, *more) for i in ids]
    path = layers.bronze_snapshot(RESULTS, RUN + timedelta(hours=hour))
    return write_snapshot(spark.createDataFrame(rows, columns), path)


def local(path):
    return Path(path.removeprefix("file:"))


def seen(spark, layers):
    return sorted(int(r["athlete_id"]) for r in read_increments(spark, layers).collect())


@pytest.mark.parametrize("grace", [0.0, 600.0])
def test_each_landing_is_cleaned_once(spark, layers, grace):
    assert run_silver_increment(spark, layers, grace=grace) is None
    with pytest.raises(FileNotFoundError):
        read_increments(spark, layers)
    for hour in (0, 1, 30):
        land(spark, layers, hour, [hour])
        assert run_silver_increment(spark, layers, grace=grace)
        assert run_silver_increment(spark, layers, grace=grace) is None
    land(spark, layers, -48, [7])  # a landing of an earlier day comes last
    run_silver_increment(spark, layers, grace=grace)
    assert seen(spark, layers) == [0, 1, 7, 30]
    assert len(increments(spark, layers)) == 4
    row = read_increments(spark, layers).filter("athlete_id = '7'").first()
    assert (row["sport"], row["medal"]) == ("judo", "")
    assert "20240802_080000/part-" in row["source_file"] and row["landed_at"] is not None
    assert gold_of_increments(spark, layers).first()["medal_count"] == 4


def test_a_snapshot_that_is_finished_later_is_not_passed_over(spark, layers):
    slow = land(spark, layers, 0, [1])
    success = local(slow) / "_SUCCESS"
    success.unlink()
    land(spark, layers, 1, [2])
    run_silver_increment(spark, layers)
    assert seen(spark, layers) == [2]
    success.touch()
    run_silver_increment(spark, layers)
    assert seen(spark, layers) == [1, 2]


def test_the_mark_stays_bounded(spark, layers):
    for hour in range(3):
        land(spark, layers, hour, [hour])
        run_silver_increment(spark, layers, grace=-60.0)  # as if minutes had passed since
    _, mark = incremental._mark(spark, layers, RESULTS)
    assert mark["since"] == {} and mark["until"] > 0
    assert seen(spark, layers) == [0, 1, 2]


def test_new_columns_and_protected_ones(spark, layers):
    land(spark, layers, 0, [1])
    run_silver_increment(spark, layers, exclude=["sport"])
    land(spark, layers, 1, [2], COLUMNS + ", pos string", ["=3"])
    run_silver_increment(spark, layers, exclude=["sport"])
    rows = {r["athlete_id"]: (r["sport"], r["pos"]) for r in read_increments(spark, layers).collect()}
    assert rows == {"1": ("Judo!", None), "2": ("Judo!", "3")}


def test_a_failed_run_is_made_up_for(spark, layers, monkeypatch):
    land(spark, layers, 0, [1])

    def broken(*args):
        raise RuntimeError("ended before the mark")

    with monkeypatch.context() as m:
        m.setattr(incremental, "write_note", broken)
        with pytest.raises(RuntimeError):
            run_silver_increment(spark, layers)
    assert increments(spark, layers) == []
    run_silver_increment(spark, layers)
    assert seen(spark, layers) == [1]


def test_of_two_runs_at_once_one_does_the_work(spark, layers, monkeypatch):
    land(spark, layers, 0, [1])
    real, done = incremental.write_note, []

    def raced(*args):
        if not done:  # another run gets there first
            done.append(1)
            with monkeypatch.context() as m:
                m.setattr(incremental, "write_note", real)
                run_silver_increment(spark, layers)
        return real(*args)

    monkeypatch.setattr(incremental, "write_note", raced)
    assert run_silver_increment(spark, layers) is None
    assert seen(spark, layers) == [1]
    folders = [p for p in local(f"{layers.silver}/{RESULTS}/increments").iterdir() if not p.name.startswith("_")]
    assert len(folders) == 1


def test_command_line(spark, layers, tmp_path, capsys):
    land(spark, layers, 0, [1, 2])
    for _ in range(2):
        cli.main(["increment", f"file:{tmp_path}"])
    assert "nothing new" in capsys.readouterr().out
    assert seen(spark, layers) == [1, 2]
