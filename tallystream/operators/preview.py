"""A look at a table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, rows: int = 20, schema: bool = False, show: bool = False) -> DataFrame:
    """The first ``rows`` rows, in no particular order; optionally printed untruncated."""
    if schema:
        df.printSchema()
    if show:
        df.show(rows, truncate=False)
    return df.limit(rows)
