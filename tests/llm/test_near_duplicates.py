"""Rows without an id, and rows that share one, are linked by their own texts."""

import random

from tallystream.llm.jaccard import join_near_duplicates, keep_one_of_each

DOCS = "doc_id long, text string"


def text(seed, n=40):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(9_000)}" for _ in range(n))


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rows_without_an_id_are_not_one(spark):
    rows = [(1, text(1)), (None, text(1) + " more"), (None, text(2)), (None, text(3)), (None, None), (None, "")]
    frame = spark.createDataFrame(rows, DOCS)
    assert result(keep_one_of_each(frame)) == sorted([rows[0], *rows[2:]], key=str)
    assert result(join_near_duplicates(frame)) == sorted(
        [(1, 36, 1), (None, 37, 1), (None, 36, None), (None, 36, None), (None, 0, None), (None, 0, None)], key=str
    )


def test_of_equal_rows_one_stays(spark):
    rows = [(7, text(1))] * 3 + [(None, text(2))] * 4 + [(8, None)] * 2
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    assert result(keep_one_of_each(frame)) == sorted([rows[0], rows[3], rows[7], rows[8]], key=str)


def test_an_id_in_common_is_no_link(spark):
    rows = [(5, text(1)), (5, text(2)), (4, text(2)), (3, text(3))]
    frame = spark.createDataFrame(rows, DOCS)
    assert result(join_near_duplicates(frame)) == [(3, 36, 3), (4, 36, 4), (5, 36, 4), (5, 36, 5)]
    assert result(keep_one_of_each(frame)) == sorted([rows[0], rows[2], rows[3]], key=str)


def test_other_columns_pass_through(spark):
    frame = spark.createDataFrame([(1, text(1), 2, "x"), (2, text(1), 3, "y")], DOCS + ", d int, component string")
    assert result(keep_one_of_each(frame)) == [(1, text(1), 2, "x")]
    assert keep_one_of_each(frame.limit(0)).collect() == []
