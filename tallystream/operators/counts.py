"""Grouped row counts of the gold layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.schemas import GOLD_KEYS


def gold_counts(df: DataFrame, keys: Sequence[str] = GOLD_KEYS) -> DataFrame:
    """Rows per key combination, stamped with the time of the query.

    ``medal_count`` counts all rows: those without a medal form groups of their
    own. A dominant group costs one partial row per task.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("medal_count"))
        .withColumn("timestamp", F.current_timestamp())
    )
