"""Silver that cleans each landing once, however often it runs.

A table's increments lie in ``silver/<table>/increments``. One small file per increment says
which folder it is and how far the snapshots are done: the high-water mark is the time at which
a snapshot was finished, by the clock of the file system. It stays some minutes behind the
present, and the snapshots done since are named, so one that finishes while others are listed
is not passed over.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.functions.text import clean_strings
from tallystream.operators.counts import gold_counts
from tallystream.plans.medallion import RESULTS, Layers
from tallystream.sources.paths import file_names, finished_at, folders, read_note, remove, write_note

#: Lineage of a row: the file it was cleaned from and when that was written.
SOURCE = ("source_file", "landed_at")
#: How far the mark stays behind, in seconds.
GRACE = 600.0


def _base(layers: Layers, table: str) -> str:
    return f"{layers.silver}/{table}/increments"


def _marks(layers: Layers, table: str) -> str:
    return f"{_base(layers, table)}/_marks"


def _mark(spark: SparkSession, layers: Layers, table: str) -> tuple[int, dict[str, Any]]:
    names = file_names(spark, _marks(layers, table))
    if not names:
        return 0, {"until": -1, "since": {}}
    return int(names[-1].removesuffix(".json")), read_note(spark, f"{_marks(layers, table)}/{names[-1]}")


def new_snapshots(
    spark: SparkSession, layers: Layers, table: str, mark: dict[str, Any]
) -> dict[str, int]:
    """Finished snapshots behind the mark, with the time they were finished."""
    found = {}
    for folder in folders(spark, f"{layers.bronze}/{table}/*"):
        at = finished_at(spark, folder.path)
        name = folder.path.rpartition("/")[2]
        if at is not None and at > mark["until"] and mark["since"].get(name) != at:
            found[name] = at
    return found


def run_silver_increment(
    spark: SparkSession,
    layers: Layers,
    table: str = RESULTS,
    exclude: Iterable[str] = (),
    grace: float = GRACE,
) -> str | None:
    """Clean the snapshots that no earlier run has; returns the folder, or None without any.

    The day of a snapshot does not matter. A run that fails leaves nothing that is read, and the
    next one takes the same snapshots. Of two runs at once, the one that finishes second finds the
    mark moved, drops its work and looks again. A snapshot that was written anew is new.
    """
    exclude = tuple(exclude)
    while True:
        started = int(time.time() * 1000)
        number, mark = _mark(spark, layers, table)
        found = new_snapshots(spark, layers, table, mark)
        if not found:
            return None
        paths = [f"{layers.bronze}/{table}/{name}" for name in sorted(found)]
        raw = spark.read.option("mergeSchema", "true").parquet(*paths)
        lineage = dict(zip(SOURCE, ("_metadata.file_path", "_metadata.file_modification_time"), strict=True))
        rows = raw.select("*", *[F.col(c).alias(name) for name, c in lineage.items()])
        folder = f"{_base(layers, table)}/{uuid.uuid4().hex}"
        clean_strings(rows, exclude=(*exclude, *SOURCE)).write.mode("errorifexists").parquet(folder)
        done = {**mark["since"], **found}
        until = max(mark["until"], min(max(done.values()), started - int(grace * 1000)))
        note = {
            "folder": folder.rpartition("/")[2],
            "snapshots": sorted(found),
            "until": until,
            "since": {name: at for name, at in done.items() if at > until},
        }
        if write_note(spark, f"{_marks(layers, table)}/{number + 1:08d}.json", note):
            return folder
        remove(spark, folder)


def increments(spark: SparkSession, layers: Layers, table: str = RESULTS) -> list[str]:
    """Folders of all increments, oldest first."""
    marks = _marks(layers, table)
    notes = [read_note(spark, f"{marks}/{name}") for name in file_names(spark, marks)]
    return [f"{_base(layers, table)}/{note['folder']}" for note in notes]


def read_increments(spark: SparkSession, layers: Layers, table: str = RESULTS) -> DataFrame:
    """All rows cleaned so far, with the file each is from (``SOURCE``)."""
    paths = increments(spark, layers, table)
    if not paths:
        raise FileNotFoundError(f"{_base(layers, table)} has no increments")
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def gold_of_increments(spark: SparkSession, layers: Layers, table: str = RESULTS) -> DataFrame:
    """Counts over everything cleaned so far."""
    return gold_counts(read_increments(spark, layers, table))
