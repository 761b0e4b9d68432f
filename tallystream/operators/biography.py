"""The static side of the enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallystream.functions.numbers import locale_numbers
from tallystream.schemas import BIOGRAPHY_COLUMNS


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "table") -> DataFrame:
    """``df`` itself, or one error that lists all missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}; it has {df.columns}")
    return df


def clean_biography(df: DataFrame) -> DataFrame:
    """Check, type and filter a raw biography table; five columns remain.

    Rows without a readable height and weight are dropped. Several rows with the
    same ``athlete_id`` are all kept.
    """
    required = require_columns(df, BIOGRAPHY_COLUMNS, "biography")
    return locale_numbers(required.select(*BIOGRAPHY_COLUMNS))
