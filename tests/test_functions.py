"""Scalar functions on literal edge rows."""

import math
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystream.functions import (
    clean_strings,
    clean_text,
    decode_topic,
    drop_unparsed,
    locale_float,
    locale_numbers,
    parse_envelope,
    register_clean_functions,
    to_envelope,
    to_int,
)
from tallystream.schemas import RESULT_EVENT


def kept(char):
    return char.isspace() or (char.isascii() and char.isalnum())


def python_clean(text):
    """The same cleaning, character by character."""
    return "".join(filter(kept, (text or "").lower()))


def values(df, column):
    return [row[column] for row in df.collect()]


def test_clean_text_matches_python_on_every_code_point(spark):
    """Each scalar value stands between two letters, so that deletions show."""
    points = spark.range(0x110000).filter("id NOT BETWEEN 55296 AND 57343")
    text = F.concat(F.lit("a"), F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32"), F.lit("Z"))
    df = points.select("id", clean_text(text).alias("out")).filter("out <> 'az'")
    got = {row["id"]: row["out"] for row in df.collect()}
    want = {}
    for code in range(0x110000):
        if not 0xD800 <= code <= 0xDFFF:
            out = python_clean(f"a{chr(code)}Z")
            if out != "az":
                want[code] = out
    assert got == want


@pytest.mark.parametrize(
    "raw, expected",
    [
        (None, ""),
        ("100 metres, Men", "100 metres men"),
        ("1.5", "15"),
        ("-3", "3"),
        ("Érétrech", "rtrech"),
        ("Kİ", "ki"),
        ("a b　c\x1cd", "a b　c\x1cd"),
        ("  a  b ", "  a  b "),
    ],
)
def test_clean_text_examples(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "t string").select(clean_text("t").alias("t"))
    assert values(df, "t") == [expected]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), min_size=1, max_size=200))
def test_clean_text_matches_python_on_any_text(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string").select("i", clean_text("t").alias("t"))
    got = {row["i"]: row["t"] for row in df.collect()}
    assert got == {i: python_clean(t) for i, t in rows}


def test_clean_strings_touches_only_chosen_text_columns(spark):
    df = spark.createDataFrame([("A-1", "B.2", 3, None)], "`a.x` string, b string, n int, c string")
    assert clean_strings(df).collect() == [("a1", "b2", 3, "")]
    assert clean_strings(df, exclude=["b"]).collect() == [("a1", "B.2", 3, "")]
    assert clean_strings(df, columns=["b"]).collect() == [("A-1", "b2", 3, None)]
    assert clean_strings(df).columns == df.columns


def test_registered_functions_are_native(spark):
    df = spark.createDataFrame([("A-1", 2)], "label string, n int")
    assert register_clean_functions(spark, df) == ["clean_label"]
    cleaned = df.selectExpr("clean_label(label) AS label")
    assert values(cleaned, "label") == ["a1"]
    assert "Python" not in cleaned._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("1,80", 1.8),
        ("75.5", 75.5),
        (" 175 ", 175.0),
        ("63-66", None),
        ("1,234,5", None),
        ("abc", None),
        ("", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_locale_float(spark, raw, expected, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(raw,)], "t string").select(locale_float("t").alias("f"))
        (value,) = values(df, "f")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert df.schema["f"].dataType.simpleString() == "float"
    assert value is None if expected is None else value == pytest.approx(expected)


def test_locale_float_accepts_numbers_and_keeps_nan(spark):
    df = spark.createDataFrame([(180.5, "NaN")], "n double, t string")
    row = df.select(locale_float("n").alias("n"), locale_float("t").alias("t")).first()
    assert row["n"] == 180.5 and math.isnan(row["t"])


@pytest.mark.parametrize("raw, expected", [("12", 12), (" 12 ", 12), ("12.7", None), ("x", None)])
def test_to_int(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "t string").select(to_int("t").alias("i"))
    assert values(df, "i") == [expected]


def test_locale_numbers_needs_both_measures(spark):
    rows = [("1", "1,80", "75,5"), ("2", "", None), ("3", "170", "63-66"), ("6", " 175 ", "NaN")]
    df = locale_numbers(spark.createDataFrame(rows, "athlete_id string, height string, weight string"))
    assert sorted(values(df, "athlete_id")) == [1, 6]
    assert drop_unparsed(df, ["height"]).count() == 2


def parsed(spark, *records):
    df = spark.createDataFrame([(r,) for r in records], "value string")
    return parse_envelope(df, RESULT_EVENT, ["athlete_id", "sport", "isTeamSport"]).collect()


@pytest.mark.parametrize(
    "record, expected",
    [
        ('{"athlete_id":1,"isTeamSport":true}', (1, None, "true")),
        ('{"athlete_id":"7"}', (None, None, None)),
        ('{"athlete_id":2.5,"sport":"s"}', (None, "s", None)),
        ('{"sport":5}', (None, "5", None)),
        ('{"sport":{"k":1},"other":2}', (None, '{"k":1}', None)),
        ('{"athlete_id":1,"sport":"judo","edition":', (None, None, None)),
        ('{"athlete_id":1,"edition_id":"x"}', (1, None, None)),
        ("not json", (None, None, None)),
        ("null", (None, None, None)),
        ('[{"athlete_id":4}]', (None, None, None)),
        ("", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_parse_envelope_keeps_a_row_per_record(spark, record, expected):
    assert [tuple(r) for r in parsed(spark, record)] == [expected]


def test_parse_envelope_parses_once_even_under_a_filter(spark):
    df = spark.createDataFrame([('{"athlete_id":1}',)], "value string")
    plan = parse_envelope(df, RESULT_EVENT).filter("athlete_id IS NOT NULL")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_envelope_omits_nulls_and_allows_a_null_key(spark):
    df = spark.createDataFrame(
        [(None, "Gold", 1), ("judo", None, 2)], "sport string, medal string, n int"
    )
    assert to_envelope(df, ["sport"]).collect() == [
        (None, '{"medal":"Gold","n":1}'),
        ("judo", '{"sport":"judo","n":2}'),
    ]
    keys = values(to_envelope(df, ["sport", "medal"]), "key")
    assert keys == ['{"medal":"Gold"}', '{"sport":"judo"}']


def test_envelope_timestamps_are_iso_with_milliseconds(spark):
    df = spark.sql("SELECT 1 AS k, TIMESTAMP '2024-08-04 10:11:12.345678' AS timestamp")
    assert values(to_envelope(df, ["k"]), "value") == [
        '{"k":1,"timestamp":"2024-08-04T10:11:12.345Z"}'
    ]


@pytest.mark.parametrize("record", ['{"athlete_id":1,"sport":"judo","edition":', '{"edition_id":"x","sport":"a"}'])
def test_parsing_fewer_fields_changes_nothing(spark, record):
    df = spark.createDataFrame([(record,)], "value string")
    few = parse_envelope(df, RESULT_EVENT, ["athlete_id", "sport"]).collect()
    assert few == parse_envelope(df, RESULT_EVENT).select("athlete_id", "sport").collect()


TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=20)


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1)), st.one_of(st.none(), TEXT)
        ),
        min_size=1,
        max_size=100,
    )
)
def test_envelope_round_trip(spark, pairs):
    rows = [(n, athlete, sport) for n, (athlete, sport) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "n int, athlete_id int, sport string")
    records = to_envelope(df, ["athlete_id"], keep=["n"])
    back = parse_envelope(records, RESULT_EVENT, ["athlete_id", "sport"], keep=["n", "key"])
    got = {r["n"]: (r["key"], r["athlete_id"], r["sport"]) for r in back.collect()}
    assert got == {n: (None if a is None else str(a), a, s) for n, a, s in rows}


def test_decode_topic_shows_absent_and_empty_keys_as_null(spark):
    rows = [(0, None, b'{"sport":"a"}'), (1, b"", b"{}"), (2, "é".encode(), b"x")]
    df = spark.createDataFrame(rows, "partition int, key binary, value binary")
    decoded = decode_topic(df, RESULT_EVENT).orderBy("partition").collect()
    assert [r["key"] for r in decoded] == [None, None, "é"]
    assert decoded[0]["value"]["sport"] == "a"


def test_ids_with_a_fraction_are_null_in_any_type(spark):
    rows = [("1", 12.0, Decimal("12.0"), "12"), ("2", 12.7, Decimal("12.7"), "12.7"), ("3", None, None, None)]
    df = spark.createDataFrame(rows, "height string, a double, b decimal(5,1), c string")
    typed = locale_numbers(df, measures=["height"], identifiers=["a", "b", "c"])
    assert [t for _, t in typed.dtypes] == ["float", "int", "int", "int"]
    assert {tuple(r) for r in typed.collect()} == {
        (1.0, 12, 12, 12), (2.0, None, None, None), (3.0, None, None, None)
    }
