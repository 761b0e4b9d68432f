"""Landing files, snapshots, layers and the command line."""

from pathlib import Path

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException

from tallystream import cli
from tallystream.plans import Layers, run_bronze, run_gold, run_medallion, run_silver
from tallystream.plans.medallion import BIOGRAPHY, RESULTS
from tallystream.scratch import new_dir, shared_dir
from tallystream.sinks import write_snapshot
from tallystream.sources import (
    csv_landing_scan,
    day_stamp,
    latest_snapshot,
    read_day,
    read_snapshots,
    second_stamp,
)

RUN = datetime(2024, 8, 4, 23, 59, 58)


@pytest.fixture
def layers(tmp_path):
    return Layers.below(f"file:{tmp_path}")


def land(tmp_path, table, text):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    (folder / f"{table}.csv").write_text(text, encoding="utf-8")


BIO_CSV = "athlete_id,height,sex\n1,\"1,80\",F\n"
RESULT_CSV = (
    "athlete_id,sport,country_noc,medal,event\n"
    '1,Judo,UKR,Gold,"100 kg, Men"\n'
    "2,Judo,UKR,,x\n"
    "3,Judo,UKR,NA\n"
    '4,Judo,UKR,"",x\n'
)


def test_csv_edge_cases(spark, tmp_path):
    path = tmp_path / "edge.csv"
    path.write_text('a,b,c\n"x, y",,""\n1,NA\n1,2,3,4\n"q""z",2,3\n')
    df = csv_landing_scan(spark, str(path))
    assert {t for _, t in df.dtypes} == {"string"}
    assert [tuple(r) for r in df.collect()] == [
        ("x, y", None, None),
        ("1", "NA", None),
        ("1", "2", "3"),
        ('"q""z"', "2", "3"),
    ]
    escaped = csv_landing_scan(spark, str(path), escape='"')
    assert escaped.collect()[3]["a"] == 'q"z'
    declared = csv_landing_scan(spark, str(path), schema=df.schema)
    assert declared.collect() == df.collect()


def test_missing_landing_is_an_error(spark, layers):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        run_bronze(spark, layers, RUN)


def test_stamps_are_utc():
    kyiv = timezone(timedelta(hours=3))
    assert second_stamp(datetime(2024, 8, 5, 1, 2, 3, tzinfo=kyiv)) == "20240804_220203"
    assert day_stamp(RUN) == "20240804"


def test_snapshot_is_written_once(spark, layers):
    path = layers.bronze_snapshot("t", RUN)
    write_snapshot(spark.range(3), path)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_snapshot(spark.range(3), path)


def test_all_snapshots_leave_out_unfinished_ones_and_keep_new_columns(spark, layers):
    base = f"{layers.bronze}/t"
    paths = [layers.bronze_snapshot("t", RUN.replace(hour=h)) for h in (8, 12, 20)]
    for path, df in zip(paths, (spark.range(3), spark.range(5), spark.range(2).selectExpr("id", "1 AS extra"))):
        write_snapshot(df, path)
    (Path(paths[1].removeprefix("file:")) / "_SUCCESS").unlink()
    got = read_snapshots(spark, base, RUN)
    assert got.count() == 5 and set(got.columns) == {"id", "extra"} and got.filter("extra = 1").count() == 2


def test_snapshots_all_and_latest(spark, layers):
    base = f"{layers.bronze}/t"
    assert latest_snapshot(spark, base) is None
    for hour, rows in ((20, 2), (8, 3)):
        write_snapshot(spark.range(rows), layers.bronze_snapshot("t", RUN.replace(hour=hour)))
    assert read_snapshots(spark, base, RUN).count() == 5
    assert read_snapshots(spark, base, RUN, "latest").count() == 2
    assert read_snapshots(spark, base, RUN, "latest", by="modified").count() == 3
    assert latest_snapshot(spark, base).endswith("20240804_085958")
    assert latest_snapshot(spark, base, by="name").endswith("20240804_205958")
    other_day = RUN + timedelta(days=1)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_snapshots(spark, base, other_day)
    with pytest.raises(FileNotFoundError):
        read_snapshots(spark, base, other_day, "latest")
    with pytest.raises(ValueError):
        read_snapshots(spark, base, RUN, "newest")
    with pytest.raises(ValueError):
        latest_snapshot(spark, base, by="size")


def test_latest_passes_over_an_unfinished_snapshot(spark, layers, tmp_path):
    base = f"{layers.bronze}/t"
    write_snapshot(spark.range(2), layers.bronze_snapshot("t", RUN.replace(hour=8)))
    (tmp_path / "bronze" / "t" / "20240804_120000" / "_temporary").mkdir(parents=True)
    assert read_snapshots(spark, base, RUN, "latest").count() == 2
    assert read_snapshots(spark, base, RUN).count() == 2
    assert latest_snapshot(spark, base, by="name").endswith("20240804_120000")
    assert latest_snapshot(spark, base, by="name", finished=True).endswith("20240804_085958")


def test_missing_silver_day(spark, layers):
    with pytest.raises(FileNotFoundError):
        run_gold(spark, layers, RUN)
    assert run_gold(spark, layers, RUN, missing="skip") is None
    assert read_day(spark, layers.gold_day(RUN), missing="skip") is None


def test_medallion(spark, tmp_path, layers):
    land(tmp_path, BIOGRAPHY, BIO_CSV)
    land(tmp_path, RESULTS, RESULT_CSV)
    gold = run_medallion(spark, layers, RUN)
    assert gold == layers.gold_day(RUN)
    got = {tuple(r)[:4] for r in spark.read.parquet(gold).collect()}
    assert got == {
        ("judo", "ukr", "gold", 1),
        ("judo", "ukr", "", 2),
        ("judo", "ukr", "na", 1),
    }
    silver = spark.read.parquet(layers.silver_day(RESULTS, RUN))
    assert silver.filter("athlete_id = '1'").first()["event"] == "100 kg men"
    assert read_day(spark, layers.silver_day(BIOGRAPHY, RUN), missing="skip") is None


def test_second_landing_doubles_unless_latest(spark, tmp_path, layers):
    land(tmp_path, BIOGRAPHY, BIO_CSV)
    land(tmp_path, RESULTS, RESULT_CSV)
    run_bronze(spark, layers, RUN)
    run_bronze(spark, layers, RUN + timedelta(seconds=1))
    run_silver(spark, layers, RUN)
    assert read_day(spark, layers.silver_day(RESULTS, RUN)).count() == 8
    run_silver(spark, layers, RUN, snapshots="latest", exclude=["event"], tables=[BIOGRAPHY, RESULTS])
    silver = read_day(spark, layers.silver_day(RESULTS, RUN))
    assert silver.count() == 4
    assert silver.filter("athlete_id = '1'").first()["event"] == "100 kg, Men"
    assert read_day(spark, layers.silver_day(BIOGRAPHY, RUN)).first()["height"] == "180"


def test_command_line(spark, tmp_path, layers, capsys):
    land(tmp_path, BIOGRAPHY, BIO_CSV)
    land(tmp_path, RESULTS, RESULT_CSV)
    stamp = ["--run-ts", RUN.isoformat()]
    for stage in ("bronze", "silver", "gold"):
        cli.main([stage, f"file:{tmp_path}", *stamp])
    assert spark.read.parquet(layers.gold_day(RUN)).count() == 3
    assert "medal_count" in capsys.readouterr().out
    cli.main(["medallion", f"file:{tmp_path}", "--run-ts", "2024-08-05T00:00:00", "--preview", "0"])
    assert spark.read.parquet(layers.gold_day(RUN + timedelta(days=1))).count() == 3


class FakeSession:
    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_scratch_is_the_folder_the_session_names():
    named = FakeSession(spark_checkpoint_dir="s3a://shared/x/", spark_master="yarn")
    assert shared_dir(named) == "s3a://shared/x"
    assert new_dir(named, "a").startswith("s3a://shared/x/a-")
    assert new_dir(named, "a") != new_dir(named, "a")


def test_scratch_is_temporary_on_one_machine_only():
    alone = FakeSession(spark_master="local[2]", spark_app_id="app-1")
    assert shared_dir(alone).startswith("file:") and shared_dir(alone) == shared_dir(alone)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession(spark_master="spark://host:7077", spark_app_id="app-2"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession(spark_master="local-cluster[2,1,1024]", spark_app_id="app-3"))
