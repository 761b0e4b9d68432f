"""Keyed JSON records: rows to (key, value) and back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.schemas import narrow


def to_envelope(df: DataFrame, key_columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One record per row: value is the row as JSON, without its NULL fields.

    One key column is cast to text (NULL gives a NULL key); several become a JSON
    object, so that a compacted topic can keep one record per full key. ``keep``
    names columns that travel next to the record instead of inside it.
    """
    if len(key_columns) == 1:
        key = F.col(key_columns[0]).cast("string")
    else:
        key = F.to_json(F.struct(*key_columns))
    row = F.struct(*[c for c in df.columns if c not in keep])
    return df.select(key.alias("key"), F.to_json(row).alias("value"), *keep)


def parse_envelope(
    df: DataFrame,
    schema: T.StructType,
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The JSON ``value`` as typed top-level columns, preceded by the ``keep`` columns.

    Malformed records stay as rows of NULLs. The struct is flattened with
    ``inline`` rather than ``select("json.*")``: Catalyst copies ``from_json`` into
    every filter it pushes below a projection, which parses each record twice, but
    does not push filters below a generator.
    """
    parsed = F.from_json(F.col("value").cast("string"), narrow(schema, fields))
    return df.select(*keep, F.inline(F.array(parsed)))


#: What can be wrong with a record.
FAULTS = ("empty", "not_json", "not_object", "wrong_type", "missing_field")
_CORRUPT = "_corrupt_record"


def judge_envelope(
    df: DataFrame,
    schema: T.StructType,
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    required: Sequence[str] = (),
) -> DataFrame:
    """The ``keep`` columns, the raw ``value`` as text, its fields as columns, and its ``fault``.

    ``fault`` is NULL for a JSON object whose fields have their types; fields may be absent or
    null, but for the ``required`` ones. Otherwise it is one of ``FAULTS``, and what could be read of the fields stands there
    nevertheless. Only the ``fields`` in use are judged. Each record is parsed once; the faulty
    ones a second time, to tell a broken text from a field of another type.
    """
    wanted = T.StructType([*narrow(schema, fields).fields, T.StructField(_CORRUPT, T.StringType())])
    value = F.col("value").cast("string")
    parsed = F.from_json(value, wanted, {"columnNameOfCorruptRecord": _CORRUPT})
    rows = df.select(*keep, value.alias("value"), F.inline(F.array(parsed)))
    text = F.ltrim("value", F.lit(" \t\r\n"))
    is_json = F.try_parse_json("value").isNotNull()
    fault = (
        F.when(F.coalesce(text, F.lit("")) == "", "empty")
        .when(~text.startswith("{"), F.when(is_json, "not_object").otherwise("not_json"))
        .when(F.col(_CORRUPT).isNotNull(), F.when(is_json, "wrong_type").otherwise("not_json"))
    )
    if required:
        lacking = reduce(Column.__or__, [F.col(name).isNull() for name in required])
        fault = fault.when(lacking, "missing_field")
    return rows.withColumn("fault", fault).drop(_CORRUPT)


def decode_topic(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``partition``, ``key`` as text and ``value`` as a struct, for batch or stream.

    An empty key is shown as NULL, like an absent one.
    """
    return df.select(
        "partition",
        F.nullif(F.col("key").cast("string"), F.lit("")).alias("key"),
        F.from_json(F.col("value").cast("string"), schema).alias("value"),
    )
