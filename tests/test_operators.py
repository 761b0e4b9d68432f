"""Joins, aggregates and guards on small fixtures, partly against brute force."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallystream.operators import (
    clean_biography,
    enrich_agg,
    enrich_join,
    fits_broadcast,
    gold_counts,
    hot_athletes,
    latest_per_key,
    measured_bytes,
    preview,
    require_columns,
)
from tallystream.workload import domain

BIO = "athlete_id string, height string, weight string, sex string, country_noc string"
RESULT = "athlete_id int, sport string, medal string, country_noc string"

FIXTURE_BIO = [
    ("1", "1,80", "75,5", "F", "UKR"),
    ("2", "", None, "M", "UKR"),
    ("3", "170", "63-66", "M", "POL"),
    ("4", "180", "80", "M", "POL"),
    ("4", "181", "82", "M", "POL"),
    ("5", "1,234,5", "70", "F", "POL"),
    ("6", " 175 ", "NaN", "F", "LTU"),
    ("x", "170", "70", "F", "LTU"),
]
FIXTURE_RESULTS = [
    (1, "judo", "Gold", "AAA"),
    (1, "judo", "Gold", "BBB"),
    (4, "judo", None, "AAA"),
    (2, "judo", "Gold", "AAA"),
    (99, "judo", "Gold", "AAA"),
    (None, "judo", "Gold", "AAA"),
    (6, "luge", "Silver", "AAA"),
]


@pytest.fixture
def bio(spark):
    return clean_biography(spark.createDataFrame(FIXTURE_BIO, BIO))


@pytest.fixture
def results(spark):
    return spark.createDataFrame(FIXTURE_RESULTS, RESULT)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_enrich_join_takes_the_biography_country_and_fans_out(results, bio, limit):
    df = enrich_join(results, bio, broadcast_limit=limit)
    assert df.columns == ["sport", "medal", "sex", "bio_country_noc", "height", "weight"]
    rows = sorted((r["sport"], r["medal"] or "", r["bio_country_noc"], r["height"]) for r in df.collect())
    assert rows == [
        ("judo", "", "POL", 180.0),
        ("judo", "", "POL", 181.0),
        ("judo", "Gold", "UKR", pytest.approx(1.8)),
        ("judo", "Gold", "UKR", pytest.approx(1.8)),
        ("luge", "Silver", "LTU", 175.0),
    ]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_enrich_agg_edge_rows(results, bio, limit):
    got = {(r["sport"], r["medal"]): r for r in enrich_agg(results, bio, broadcast_limit=limit).collect()}
    assert set(got) == {("judo", "Gold"), ("judo", None), ("luge", "Silver")}
    assert got["judo", "Gold"]["athlete_count"] == 2
    assert got["judo", "Gold"]["avg_height"] == 1.7999999523162842
    assert got["judo", None]["athlete_count"] == 2
    assert got["judo", None]["avg_weight"] == 81.0
    assert math.isnan(got["luge", "Silver"]["avg_weight"])
    assert got["luge", "Silver"]["avg_height"] == 175.0


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_enrich_agg_per_window(results, bio, limit):
    minute = F.when(F.col("country_noc") == "BBB", 11).otherwise(3)
    stamped = results.withColumn("event_time", F.make_timestamp(
        F.lit(2024), F.lit(8), F.lit(4), F.lit(10), minute, F.lit(0)
    ))
    df = enrich_agg(stamped, bio, window="10 minutes", broadcast_limit=limit)
    got = {(r["window_start"].minute, r["sport"], r["medal"], r["athlete_count"]) for r in df.collect()}
    assert got == {
        (0, "judo", "Gold", 1), (10, "judo", "Gold", 1), (0, "judo", None, 2), (0, "luge", "Silver", 1)
    }


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_enrich_agg_with_hot_keys_equals_brute_force(spark, limit):
    """One athlete holds a third of the results and a third of the biographies."""
    rng = random.Random(5)
    bios = [
        (str(7 if rng.random() < 0.35 else rng.randrange(60)), str(150 + rng.randrange(50)),
         str(50 + rng.randrange(50)), rng.choice("FM"), rng.choice(["UKR", "POL", None]))
        for _ in range(300)
    ]
    rows = [
        (7 if rng.random() < 0.35 else rng.randrange(80), rng.choice(["judo", "luge"]),
         rng.choice(["Gold", None]), "AAA")
        for _ in range(2000)
    ]
    groups = defaultdict(lambda: [0, 0.0, 0.0])
    for athlete, sport, medal, _ in rows:
        for bio_id, height, weight, sex, noc in bios:
            if int(bio_id) == athlete:
                group = groups[sport, medal, sex, noc]
                group[0] += 1
                group[1] += float(height)
                group[2] += float(weight)
    want = {k: (n, round(h / n, 9), round(w / n, 9)) for k, (n, h, w) in groups.items()}

    cleaned = clean_biography(spark.createDataFrame(bios, BIO))
    df = enrich_agg(spark.createDataFrame(rows, RESULT), cleaned, broadcast_limit=limit)
    got = {
        (r["sport"], r["medal"], r["sex"], r["bio_country_noc"]): (
            r["athlete_count"], round(r["avg_height"], 9), round(r["avg_weight"], 9)
        )
        for r in df.collect()
    }
    assert got == want


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_within_the_measured_limit(spark, results, bio):
    size = measured_bytes(bio.select("athlete_id", "sex", "country_noc", "height", "weight"))
    assert size > 0
    assert fits_broadcast(bio, 1 << 20) and not fits_broadcast(bio, 10) and not fits_broadcast(bio, 0)
    assert "BroadcastHashJoin" in plan(enrich_join(results, bio))
    assert "BuildRight" in plan(enrich_join(results, bio))
    beyond = enrich_join(results, bio, broadcast_limit=10)
    assert "SortMergeJoin" in plan(beyond) and "Broadcast" not in plan(beyond)
    beyond = enrich_agg(results, bio, broadcast_limit=10)
    assert "SortMergeJoin" in plan(beyond) and "Broadcast" not in plan(beyond)


def test_hot_athlete_is_split_at_run_time(spark, bio):
    """Half of the results belong to one athlete: the join splits that partition."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).cast("int")
        rows = spark.range(0, 20000, 1, 8).select(
            hot.alias("athlete_id"), F.lit("judo").alias("sport"), F.uuid().alias("medal")
        )
        joined = enrich_join(rows, bio, broadcast_limit=0)
        assert len(joined.collect()) == 10000 + 1
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_hot_athletes_are_salted_on_request(spark, bio):
    """The rows of the named athlete meet its biography in several partitions, once each."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).cast("int")
        rows = spark.range(0, 6000).select(
            hot.alias("athlete_id"), F.lit("judo").alias("sport"), F.col("id").alias("medal")
        )
        assert hot_athletes(rows) == [1]
        joined = enrich_join(
            rows, bio, broadcast_limit=0, hot=lambda: hot_athletes(rows), spread=32
        )
        place = joined.filter("medal % 3 = 0").select(F.spark_partition_id().alias("p"))
        sizes = [r["count"] for r in place.groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(sizes) == 2000 and len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert joined.count() == 2000 + 1 + 2


def test_copies_of_a_record_are_told_apart_by_their_position(spark, bio):
    """Equal results of one athlete, a third of all rows or more, do not share a salt."""
    copies = spark.range(0, 4000).select(
        F.lit(1).alias("athlete_id"),
        F.lit("judo").alias("sport"),
        F.lit("Gold").alias("medal"),
        F.col("id").alias("offset"),
    )
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = enrich_join(copies, bio, broadcast_limit=0, hot=[1], spread=64)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    counts = [r["count"] for r in sizes]
    assert sum(counts) == 4000 and max(counts) < 2500


def test_hot_athletes_of_no_rows_and_of_one_athlete(spark):
    rows = spark.createDataFrame([(None,), (1,), (1,)], "athlete_id int")
    assert hot_athletes(rows) == [1]
    assert hot_athletes(rows, 1.0) == []
    assert hot_athletes(rows.limit(1).filter("athlete_id IS NOT NULL")) == []


def test_hot_athletes_are_found_in_one_pass(spark, monkeypatch):
    jobs = []
    kind = type(spark.range(1))
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: jobs.append(1) or collect(df))
    monkeypatch.setattr(kind, "count", lambda df: pytest.fail("another pass"))
    rows = spark.range(0, 1000).select((F.col("id") % 200).cast("int").alias("athlete_id"))
    assert hot_athletes(rows) == []
    assert sorted(hot_athletes(rows, 0.004)) == list(range(200))
    assert len(jobs) == 2


def test_hot_athletes_are_not_looked_for_without_need(results, bio):
    def fail():
        raise AssertionError("called")

    assert enrich_join(results, bio, hot=fail).count() == 5


def test_measured_bytes_grows_with_text_and_nesting(spark):
    short = spark.range(10).select(F.lit("a").alias("t"))
    long = spark.range(10).select(F.lit("a" * 1000).alias("t"))
    nested = spark.range(10).select(F.array(F.lit("a" * 1000)).alias("t"))
    assert measured_bytes(long) >= measured_bytes(short) + 9000
    assert measured_bytes(nested) >= 10000
    assert measured_bytes(short.limit(0)) == 0


def test_require_columns_lists_everything_missing(spark):
    df = spark.createDataFrame([("1", "a")], "athlete_id string, sex string")
    with pytest.raises(ValueError, match=r"\['height', 'weight', 'country_noc'\]"):
        clean_biography(df)
    assert require_columns(df, ["sex"]) is df


def test_gold_counts_include_rows_without_a_medal(spark):
    rows = [("judo", "ukr", ""), ("judo", "ukr", ""), ("judo", "ukr", "gold"), (None, "ukr", "gold")]
    df = gold_counts(spark.createDataFrame(rows, "sport string, country_noc string, medal string"))
    assert df.columns == ["sport", "country_noc", "medal", "medal_count", "timestamp"]
    got = {tuple(r)[:4] for r in df.collect()}
    assert got == {("judo", "ukr", "", 2), ("judo", "ukr", "gold", 1), (None, "ukr", "gold", 1)}
    assert df.select("timestamp").distinct().count() == 1


def test_latest_per_key(spark):
    log = spark.createDataFrame(
        [
            ("a", None, 1.0, 5, 0),
            ("a", None, None, 3, 2),
            ("a", None, 2.0, 9, 1),
            ("a", None, None, 3, 2),
            ("b", "g", 9.0, None, 0),
        ],
        "sport string, medal string, mean double, n int, batch_id long",
    )
    df = latest_per_key(log, ["sport", "medal"])
    assert df.columns == log.columns
    assert {tuple(r) for r in df.collect()} == {("a", None, None, 3, 2), ("b", "g", 9.0, None, 0)}
    assert "SortAggregate" not in plan(df)


def test_preview(spark, capsys):
    df = spark.range(50)
    assert preview(df).count() == 20
    assert preview(df, 5).count() == 5
    preview(df, 10, schema=True, show=True)
    printed = capsys.readouterr().out
    assert "id: long" in printed and "only showing top 10 rows" in printed


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_the_skewed_results_have_a_hot_athlete(spark, sf):
    found = hot_athletes(domain.skewed_results(spark, f"/root/testdata/{sf}"))
    assert domain.HOT_ATHLETE in found
