"""Declared schemas of the records the jobs exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Field names and types of one competition result record.
RESULT_EVENT = T.StructType(
    [
        T.StructField("edition", T.StringType()),
        T.StructField("edition_id", T.IntegerType()),
        T.StructField("country_noc", T.StringType()),
        T.StructField("sport", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("result_id", T.StringType()),
        T.StructField("athlete", T.StringType()),
        T.StructField("athlete_id", T.IntegerType()),
        T.StructField("pos", T.StringType()),
        T.StructField("medal", T.StringType()),
        T.StructField("isTeamSport", T.StringType()),
    ]
)

# Output of the enrichment aggregate, as sent to the output topic.
ENRICHED_TALLY = T.StructType(
    [
        T.StructField("sport", T.StringType()),
        T.StructField("medal", T.StringType()),
        T.StructField("sex", T.StringType()),
        T.StructField("bio_country_noc", T.StringType()),
        T.StructField("avg_height", T.DoubleType()),
        T.StructField("avg_weight", T.DoubleType()),
        T.StructField("athlete_count", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# The same with what tells a record that was sent twice.
STAMPED_TALLY = T.StructType(
    [
        *ENRICHED_TALLY.fields,
        T.StructField("batch_id", T.LongType()),
        T.StructField("record_id", T.StringType()),
    ]
)

# Columns of a topic as the Kafka source presents it.
TOPIC_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

BIOGRAPHY_COLUMNS = ("athlete_id", "height", "weight", "sex", "country_noc")
TALLY_KEYS = ("sport", "medal", "sex", "bio_country_noc")
GOLD_KEYS = ("sport", "country_noc", "medal")


def narrow(schema: T.StructType, fields: Sequence[str] | None) -> T.StructType:
    """The part of ``schema`` that a job uses; fewer fields parse faster."""
    if fields is None:
        return schema
    return T.StructType([schema[name] for name in fields])
