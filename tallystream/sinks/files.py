"""Parquet folders as targets."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from tallystream.sinks.fanout import Sink
from tallystream.sources.days import (
    MARK,
    manifest,
    manifest_folder,
    manifest_number,
    version_folder,
    version_in_place,
)
from tallystream.sources.paths import content, folders, move, path_exists, remove, write_note


def write_snapshot(df: DataFrame, path: str) -> str:
    """A folder written once; an existing one is an error."""
    df.write.mode("errorifexists").parquet(path)
    return path


def overwrite_day(df: DataFrame, path: str, plain: bool = True) -> str:
    """Replace a day as a whole; read it with ``sources.read_day``.

    The new version is written beside the day, named in the manifest once it is finished, and
    then put in the day's place, so that plain Parquet readers find it there too. A write that
    fails, or a process that ends at any point, leaves the old or the new version whole to
    ``read_day``. Of two writers the one that finishes last counts.

    Taking the place needs two renames, between which plain readers find nothing. On stores
    that rename by copying, ``plain=False`` leaves the version where it is; only ``read_day``
    finds it then.
    """
    spark = df.sparkSession
    version = write_version(df, path)
    publish_version(spark, path, version)
    if plain:
        put_in_place(spark, path)
    return path


def write_version(df: DataFrame, path: str) -> str:
    """Write a version beside the day; nobody reads it yet."""
    version = uuid.uuid4().hex
    folder = version_folder(path, version)
    df.write.mode("errorifexists").parquet(folder)
    write_note(df.sparkSession, f"{folder}/{MARK}", {"version": version})
    return version


def publish_version(spark: SparkSession, path: str, version: str) -> None:
    """Name a written version in the manifest: from now on it is the day."""
    files, size = content(spark, version_folder(path, version))
    note = {
        "version": version,
        "files": files,
        "bytes": size,
        "finished": datetime.now(UTC).isoformat(timespec="seconds"),
    }
    while True:  # another writer may take the number first
        number = manifest_number(spark, path) + 1
        if write_note(spark, f"{manifest_folder(path)}/{number:08d}.json", note):
            return


def put_in_place(spark: SparkSession, path: str) -> None:
    """Move the version that counts to the day's own path; also after a process that ended before.

    What lay there goes last, when nobody is sent to it any more.
    """
    current = manifest(spark, path)
    if current is None or version_in_place(spark, path) == current["version"]:
        return
    aside = None
    if path_exists(spark, path):
        aside = version_folder(path, f"replaced-{uuid.uuid4().hex}")
        move(spark, path, aside)
    move(spark, version_folder(path, current["version"]), path)
    if aside is not None:
        remove(spark, aside)


def drop_leftovers(spark: SparkSession, path: str, older_than_seconds: float = 86_400) -> list[str]:
    """Delete what failed writes of a day have left beside it; returns the folders.

    Folders changed within ``older_than_seconds`` may still be written to and stay.
    """
    current = manifest(spark, path)
    limit = (datetime.now(UTC).timestamp() - older_than_seconds) * 1000
    found = [f.path for f in folders(spark, version_folder(path, "*")) if f.modified <= limit]
    left = [f for f in found if current is None or not f.endswith(f"/{current['version']}")]
    for folder in left:
        remove(spark, folder)
    return left


def log_sink(path: str) -> Sink:
    """Micro-batches as ``batch_id=<n>`` partitions of one table.

    A batch that is run again replaces its own folder, so the log holds each once.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
