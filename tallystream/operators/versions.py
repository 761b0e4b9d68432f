"""Final totals out of a log of running totals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.schemas import TALLY_KEYS


def tally_keys(df: DataFrame) -> list[str]:
    """The key columns of tallies; those of a window belong to them where there are some."""
    return [*TALLY_KEYS, *(c for c in ("window_start", "window_end") if c in df.columns)]


def not_yet_present(rows: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` whose key has no row in ``present``; NULL is a key like any other."""
    here = present.select(*keys).distinct().alias("present")
    same = [F.col(f"new.{k}").eqNullSafe(F.col(f"present.{k}")) for k in keys]
    return rows.alias("new").join(here, reduce(Column.__and__, same), "left_anti")


def latest_per_key(
    log: DataFrame, keys: Sequence[str] | None = None, version: str = "batch_id"
) -> DataFrame:
    """The row with the highest ``version`` of each key; NULL is a key like any other.

    Rows with the same key and version must be copies of one another, as they are in a
    log that the sinks wrote; one of them remains. Each column has its own ``max_by``:
    numbers can be updated in place, which lets Spark aggregate by hash, whereas one
    ``max_by`` over a struct makes it sort the whole log.
    """
    keys = tally_keys(log) if keys is None else keys
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(*[F.max_by(c, version).alias(c) for c in rest])
