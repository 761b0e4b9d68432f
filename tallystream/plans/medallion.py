"""The batch jobs: landing to bronze to silver to gold.

All stages of a run share one ``run_ts``, so a run that crosses midnight still reads
what it wrote.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tallystream.functions.text import clean_strings
from tallystream.operators.counts import gold_counts
from tallystream.operators.preview import preview
from tallystream.plans.journal import Journal, Watcher
from tallystream.schemas import GOLD_KEYS
from tallystream.sinks.files import overwrite_day, write_snapshot
from tallystream.sources.days import read_day
from tallystream.sources.landing import csv_landing_scan
from tallystream.sources.paths import finished, remove
from tallystream.sources.snapshots import day_stamp, read_snapshots, second_stamp

BIOGRAPHY = "athlete_bio"
RESULTS = "athlete_event_results"


@dataclass(frozen=True)
class Layers:
    """Base folders of the layers, on any file system all executors can reach."""

    landing: str
    bronze: str
    silver: str
    gold: str
    #: Whether a day is put where plain readers look for it (see ``sinks.overwrite_day``).
    plain: bool = True

    @classmethod
    def below(cls, base: str, plain: bool = True) -> Layers:
        return cls(f"{base}/landing", f"{base}/bronze", f"{base}/silver", f"{base}/gold", plain)

    def landing_file(self, table: str) -> str:
        return f"{self.landing}/{table}.csv"

    def bronze_snapshot(self, table: str, run_ts: datetime) -> str:
        return f"{self.bronze}/{table}/{second_stamp(run_ts)}"

    def silver_day(self, table: str, run_ts: datetime) -> str:
        return f"{self.silver}/{table}/{day_stamp(run_ts)}"

    def gold_day(self, run_ts: datetime) -> str:
        return f"{self.gold}/medal_summary_{day_stamp(run_ts)}"

    def run_journal(self, run_ts: datetime) -> str:
        return f"{self.gold}/_runs/{second_stamp(run_ts)}"


def _look(df: DataFrame, rows: int) -> None:
    if rows:
        preview(df, rows, schema=True, show=True)


def run_bronze(
    spark: SparkSession,
    layers: Layers,
    run_ts: datetime,
    tables: Sequence[str] = (BIOGRAPHY, RESULTS),
    preview_rows: int = 0,
    journal: Journal | None = None,
) -> dict[str, str]:
    """Each landed CSV as an untyped Parquet snapshot; returns the paths written.

    With a ``journal``, tables that the run has finished are passed over, and a snapshot that it
    left unfinished is written anew. Without, an existing snapshot is an error.
    """
    written = {}
    for table in tables:
        step = f"bronze-{table}"
        path = layers.bronze_snapshot(table, run_ts)
        if journal and journal.finished(step):
            written[table] = path
            continue
        if journal is None or not finished(spark, path):
            if journal:
                remove(spark, path)
            df = csv_landing_scan(spark, layers.landing_file(table))
            _look(df, preview_rows)
            write_snapshot(df, path)
        written[table] = path
        if journal:
            journal.finish(step, path)
    return written


def run_silver(
    spark: SparkSession,
    layers: Layers,
    run_ts: datetime,
    tables: Sequence[str] = (RESULTS,),
    snapshots: str = "all",
    exclude: Iterable[str] = (),
    preview_rows: int = 0,
    journal: Journal | None = None,
) -> dict[str, str]:
    """The day's snapshots with all text cleaned; replaces an earlier run of the day.

    With a ``journal``, tables that the run has finished with the same ``snapshots`` are passed over.
    """
    exclude = tuple(exclude)
    written = {}
    for table in tables:
        step, path = f"silver-{table}", layers.silver_day(table, run_ts)
        if journal and journal.finished(step, snapshots=snapshots):
            written[table] = path
            continue
        raw = read_snapshots(spark, f"{layers.bronze}/{table}", run_ts, snapshots)
        _look(raw, preview_rows)
        cleaned = clean_strings(raw, exclude=exclude)
        _look(cleaned, preview_rows)
        written[table] = overwrite_day(cleaned, path, layers.plain)
        if journal:
            journal.finish(step, path, snapshots=snapshots)
    return written


def run_gold(
    spark: SparkSession,
    layers: Layers,
    run_ts: datetime,
    table: str = RESULTS,
    keys: Sequence[str] = GOLD_KEYS,
    missing: str = "raise",
    preview_rows: int = 0,
    journal: Journal | None = None,
    **options: str,
) -> str | None:
    """Counts of the day's silver table; None if it is absent and ``missing="skip"``.

    With a ``journal``, nothing is done if the run has finished this step with the same ``options``.
    """
    step, path = f"gold-{table}", layers.gold_day(run_ts)
    if journal and journal.finished(step, **options):
        return path
    silver = read_day(spark, layers.silver_day(table, run_ts), missing)
    if silver is None:
        return None
    overwrite_day(gold_counts(silver, keys), path, layers.plain)
    if preview_rows:
        _look(read_day(spark, path), preview_rows)
    if journal:
        journal.finish(step, path, **options)
    return path


def run_medallion(
    spark: SparkSession,
    layers: Layers,
    run_ts: datetime,
    snapshots: str = "all",
    preview_rows: int = 0,
    watch: Watcher | None = None,
) -> str | None:
    """Bronze, then silver, then gold; a failing stage stops the run.

    The same ``run_ts`` again goes on where the run broke: what a journal says is finished is not
    done again. Another ``snapshots`` repeats silver and gold. ``watch`` is called with the
    name of each step that finishes and what is written down about it.
    """
    journal = Journal(spark, layers.run_journal(run_ts), watch)
    run_bronze(spark, layers, run_ts, preview_rows=preview_rows, journal=journal)
    run_silver(spark, layers, run_ts, snapshots=snapshots, preview_rows=preview_rows, journal=journal)
    return run_gold(
        spark, layers, run_ts, preview_rows=preview_rows, journal=journal, snapshots=snapshots
    )
