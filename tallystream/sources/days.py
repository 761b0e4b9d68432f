"""Day folders that are replaced as a whole.

Beside a day lie two hidden folders: ``_versions/<day>`` holds what is being written or is not yet
in place, ``_manifest/<day>`` one small file per finished version. The one with the highest number
names the version that counts. A version stays where it was written until it takes the day's
own place, from which plain readers take it too, and says there which one it is.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tallystream.sources.paths import content, file_names, finished, path_exists, read_note

MARK = "_version"


def _beside(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name


def version_folder(path: str, version: str) -> str:
    parent, name = _beside(path)
    return f"{parent}/_versions/{name}/{version}"


def manifest_folder(path: str) -> str:
    parent, name = _beside(path)
    return f"{parent}/_manifest/{name}"


def manifest_number(spark: SparkSession, path: str) -> int:
    """Number of the newest finished version; 0 if there is none."""
    names = file_names(spark, manifest_folder(path))
    return int(names[-1].removesuffix(".json")) if names else 0


def manifest(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """What the newest finished version of a day is: version, files, bytes."""
    number = manifest_number(spark, path)
    return read_note(spark, f"{manifest_folder(path)}/{number:08d}.json") if number else None


def version_in_place(spark: SparkSession, path: str) -> str | None:
    """The version that lies at the day's own path; None for one written otherwise."""
    note = read_note(spark, f"{path}/{MARK}")
    return note["version"] if note else None


def day_folder(spark: SparkSession, path: str) -> str | None:
    """Where the finished version of a day lies, or None if the day has none.

    A day without a manifest counts if a Spark writer has ended there. A version that has
    lost files is an error.
    """
    current = manifest(spark, path)
    if current is None:
        return path if finished(spark, path) else None
    aside = version_folder(path, current["version"])
    for _ in range(2):  # it may take its place between the two looks
        for folder in (path, aside):
            if version_in_place(spark, folder) == current["version"]:
                if content(spark, folder) != (current["files"], current["bytes"]):
                    raise FileNotFoundError(f"{folder} has not all files of version {current['version']}")
                return folder
    raise FileNotFoundError(f"{path} has lost version {current['version']}")


def read_day(spark: SparkSession, path: str, missing: str = "raise") -> DataFrame | None:
    """The finished version of a day. If there is none: an error, or None with ``missing="skip"``.

    A replacement that fails, or has not ended, changes nothing: its rows are not seen.
    """
    folder = day_folder(spark, path)
    if folder is not None:
        return spark.read.parquet(folder)
    if missing == "skip":
        return None
    unfinished = " is unfinished" if path_exists(spark, path) else ""
    raise FileNotFoundError(f"{path}{unfinished}")
