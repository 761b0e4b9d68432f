"""Measured size of a join side, the condition for broadcasting it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes a broadcast side may take in memory. Spark's own limit is 8 GB, so a table
# that a long-running stream reads again and again can grow sixtyfold between starts.
BROADCAST_LIMIT = 128 * 1024 * 1024

_ROW_OVERHEAD = 32
_WORD = 8


def _variable_bytes(field: T.StructField) -> Column | None:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + F.lit(_WORD)
    if isinstance(field.dataType, T.DecimalType):
        return F.lit(2 * _WORD)
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) * F.lit(4)
    return None


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the rows of ``df`` in Spark's row format, by one aggregate job.

    Catalyst's own estimate is of no use here: it is unknown for JDBC and is the
    compressed file size for Parquet.
    """
    fixed = _ROW_OVERHEAD + _WORD * (len(df.columns) + 1)
    width = F.lit(fixed).cast("long")
    for field in df.schema.fields:
        extra = _variable_bytes(field)
        if extra is not None:
            width = width + extra
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether a side may be broadcast. ``limit=0`` says no without looking."""
    return limit > 0 and measured_bytes(df) <= limit
