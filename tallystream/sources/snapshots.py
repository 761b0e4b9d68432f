"""Stamped folders of the bronze, silver and gold layers."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from tallystream.sources.paths import finished as is_finished
from tallystream.sources.paths import folders


def _utc(run_ts: datetime) -> datetime:
    return run_ts.replace(tzinfo=UTC) if run_ts.tzinfo is None else run_ts.astimezone(UTC)


def day_stamp(run_ts: datetime) -> str:
    """``yyyymmdd`` in UTC; a time without zone is taken as UTC."""
    return _utc(run_ts).strftime("%Y%m%d")


def second_stamp(run_ts: datetime) -> str:
    """``yyyymmdd_HHMMSS`` in UTC."""
    return _utc(run_ts).strftime("%Y%m%d_%H%M%S")


def latest_snapshot(
    spark: SparkSession,
    base: str,
    pattern: str = "*",
    by: str = "modified",
    finished: bool = False,
) -> str | None:
    """The newest folder below ``base``, or None if there is none.

    ``by="modified"`` goes by modification time and settles ties by name;
    ``by="name"`` goes by the stamp in the name, for object stores, whose folders
    have no times of their own. ``finished=True`` passes over folders whose write was
    cut short, i.e. that lack the ``_SUCCESS`` file of Spark's writers.
    """
    if by not in ("modified", "name"):
        raise ValueError(f"by must be 'modified' or 'name', not {by!r}")
    found = folders(spark, f"{base}/{pattern}")
    if finished:
        found = [f for f in found if is_finished(spark, f.path)]
    newest = max(found, key=None if by == "modified" else lambda f: f.path, default=None)
    return newest.path if newest else None


def read_snapshots(
    spark: SparkSession,
    base: str,
    run_ts: datetime,
    snapshots: str = "all",
    by: str = "name",
) -> DataFrame:
    """Snapshots of one day below ``base``.

    ``all`` concatenates every finished snapshot of the day, so two landings double the
    rows, and has the columns of all of them; ``latest`` reads the newest finished one.
    A day without (finished) snapshots is an error.
    """
    pattern = f"{day_stamp(run_ts)}_*"
    if snapshots == "all":
        found = folders(spark, f"{base}/{pattern}")
        finished = sorted(f.path for f in found if is_finished(spark, f.path))
        if found and not finished:
            raise FileNotFoundError(f"no finished snapshot matches {base}/{pattern}")
        paths = finished or [f"{base}/{pattern}"]
        return spark.read.option("mergeSchema", "true").parquet(*paths)
    if snapshots != "latest":
        raise ValueError(f"snapshots must be 'all' or 'latest', not {snapshots!r}")
    newest = latest_snapshot(spark, base, pattern, by, finished=True)
    if newest is None:
        raise FileNotFoundError(f"no snapshot matches {base}/{pattern}")
    return spark.read.parquet(newest)
