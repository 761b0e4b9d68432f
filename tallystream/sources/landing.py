"""Untyped CSV landings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def csv_landing_scan(
    spark: SparkSession, location: str, schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """A headered CSV file, folder or glob; all columns are text.

    Any location that Spark's file systems can read will do; one that does not
    exist is an error. Without ``schema`` one line is read to get the names. The
    files stay splittable, as fields with line breaks are not supported by default.
    """
    reader = spark.read.option("header", "true").options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(location)
