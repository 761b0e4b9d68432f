"""JDBC scans and appends, against the in-memory database inside Spark's process."""

import uuid

import pytest

from tallystream.operators import latest_per_key
from tallystream.sinks import jdbc_append, jdbc_sink
from tallystream.sources import Database, jdbc_bounds, jdbc_scan
from tallystream.sources.jdbc import bounds_query
from tallystream.workload.database import configured_database

ROW = "sport string, medal string, sex string, bio_country_noc string, athlete_count long"


@pytest.fixture
def database(spark):
    return configured_database(spark)


@pytest.fixture
def table():
    return f"t_{uuid.uuid4().hex[:8]}"


def test_partitioned_scan_reads_everything(spark, database, table):
    jdbc_append(spark.range(5, 105), database, table)
    assert jdbc_bounds(spark, database, table, "id") == (5, 104)
    whole = jdbc_scan(spark, database, table)
    split = jdbc_scan(spark, database, table, partition_column="id", partitions=4)
    narrow = jdbc_scan(
        spark, database, table, partition_column="id", lower=50, upper=60, partitions=4
    )
    assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() == 4
    for df in (whole, split, narrow):
        assert sorted(r["id"] for r in df.collect()) == list(range(5, 105))


def test_bounds_are_asked_from_the_database():
    assert bounds_query("t", "id") == "(SELECT min(id) AS low, max(id) AS high FROM t) bounds"


def test_scan_of_an_empty_table(spark, database, table):
    jdbc_append(spark.range(0), database, table)
    assert jdbc_scan(spark, database, table, partition_column="id").count() == 0


def test_append_keeps_earlier_rows(spark, database, table):
    jdbc_append(spark.range(2), database, table)
    jdbc_append(spark.range(2), database, table)
    assert jdbc_scan(spark, database, table).count() == 4


def test_sink_completes_a_half_written_batch(spark, database, table):
    rows = [("judo", None, "F", "UKR", 1), ("judo", "Gold", "F", "UKR", 2), (None, "Gold", "M", "POL", 3)]
    df = spark.createDataFrame(rows, ROW)
    jdbc_sink(database, table)(df, 0)
    jdbc_sink(database, table)(df.filter("medal IS NULL"), 1)
    restarted = jdbc_sink(database, table)
    restarted(df, 1)
    restarted(df, 2)
    log = jdbc_scan(spark, database, table)
    assert {r["batch_id"]: r["count"] for r in log.groupBy("batch_id").count().collect()} == {0: 3, 1: 3, 2: 3}
    assert {r["batch_id"] for r in latest_per_key(log).collect()} == {2}


def test_sink_looks_again_at_a_batch_that_comes_again(spark, database, table):
    df = spark.createDataFrame([("judo", "Gold", "F", "UKR", 2)], ROW)
    sink = jdbc_sink(database, table)
    for batch_id in (3, 4, 4, 5):
        sink(df, batch_id)
    log = jdbc_scan(spark, database, table)
    assert sorted(r["batch_id"] for r in log.collect()) == [3, 4, 5]


def test_filters_and_columns_reach_the_database(spark, database, table):
    df = spark.createDataFrame([("judo", "Gold", "F", "UKR", 2)], ROW)
    jdbc_append(df, database, table)
    scan = jdbc_scan(spark, database, table).filter("athlete_count = 2").select("sport")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "*EqualTo(athlete_count,2)" in plan
    assert "ReadSchema: struct<sport:string>" in plan


def test_password_stays_out_of_sight():
    database = Database("jdbc:x", "d", "me", "secret", {"ssl": "true"})
    assert "secret" not in repr(database)
    assert database.options("t") == {
        "url": "jdbc:x", "driver": "d", "dbtable": "t", "ssl": "true", "user": "me", "password": "secret",
    }
    assert "user" not in Database("jdbc:x", "d").options("t")
