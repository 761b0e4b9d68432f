"""Substring dedup of equal rows: each is cut alike, and their number makes no list longer."""

import random

import pytest
from pyspark.sql import functions as F

from tallystream.llm.substrings import cut_repeats, repeated_windows

DOCS = "doc_id long, text string"


def text(seed, n=120):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(9_000)}" for _ in range(n))


@pytest.mark.parametrize("copies", [1, 40, 2_000])
def test_equal_rows_without_an_id(spark, copies):
    shared = text(1)
    rows = [(1, shared)] + [(None, f"{text(2, 30)} {shared}")] * copies + [(None, f"{shared} {text(3, 30)}")] * copies
    frame = spark.createDataFrame(rows, DOCS).repartition(4)
    spans = repeated_windows(frame)
    assert sorted(len(r["spans"]) for r in spans.collect()) == [1, 1]
    got = cut_repeats(frame).groupBy("doc_id", "kept_text", "n_removed").agg(F.count("*").alias("n")).collect()
    assert sorted((r["kept_text"], r["n_removed"], r["n"]) for r in got) == sorted(
        [(shared, 0, 1), (text(2, 30), 120, copies), (text(3, 30), 120, copies)]
    )


def test_equal_rows_with_an_id(spark):
    rows = [(5, text(1))] * 3 + [(6, text(1) + " tail")] * 2 + [(None, None)] * 2
    frame = spark.createDataFrame(rows, DOCS)
    got = cut_repeats(frame).select("doc_id", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(5, text(1))] * 3 + [(6, "tail")] * 2 + [(None, "")] * 2, key=str)


def test_names_that_the_operator_adds(spark):
    frame = spark.createDataFrame([(1, "a", "x")], DOCS + ", Kept_Text string")
    with pytest.raises(ValueError, match="kept_text"):
        cut_repeats(frame)
