"""Folder listings through Hadoop's file system layer, which also knows object stores."""

from __future__ import annotations

import json
import uuid
from typing import Any, NamedTuple

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


class Folder(NamedTuple):
    modified: int
    path: str


def _resolve(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def file_count(spark: SparkSession, path: str) -> int:
    """Files below ``path``, asked as one number."""
    fs, hadoop_path = _resolve(spark, path)
    return fs.getContentSummary(hadoop_path).getFileCount()


def folders(spark: SparkSession, pattern: str) -> list[Folder]:
    """Folders that match a glob, but for hidden ones; none if its parent does not exist."""
    fs, hadoop_path = _resolve(spark, pattern)
    found = (s for s in fs.globStatus(hadoop_path) or [] if s.isDirectory())
    return [
        Folder(s.getModificationTime(), s.getPath().toString())
        for s in found
        if not s.getPath().getName().startswith((".", "_"))
    ]


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a Spark writer has ended there; it leaves ``_SUCCESS`` as its last file."""
    return path_exists(spark, f"{path}/_SUCCESS")


def finished_at(spark: SparkSession, path: str) -> int | None:
    """When a Spark writer ended there (milliseconds), or None if none has."""
    fs, hadoop_path = _resolve(spark, f"{path}/_SUCCESS")
    found = fs.globStatus(hadoop_path) or []
    return found[0].getModificationTime() if found else None


def content(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files below ``path`` and their bytes; (0, 0) if there is nothing."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return 0, 0
    summary = fs.getContentSummary(hadoop_path)
    return summary.getFileCount(), summary.getLength()


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files of a folder that are not hidden, sorted; none if it does not exist."""
    fs, hadoop_path = _resolve(spark, f"{folder}/*")
    found = (s for s in fs.globStatus(hadoop_path) or [] if s.isFile())
    names = (s.getPath().getName() for s in found)
    return sorted(n for n in names if not n.startswith((".", "_")))


def read_note(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """A small JSON file, or None if it does not exist."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def write_note(spark: SparkSession, path: str, note: dict[str, Any]) -> bool:
    """Write a small JSON file that is seen whole or not at all; False if there is one already.

    It is written under a hidden name and renamed, which on an object store is one copy.
    """
    fs, hadoop_path = _resolve(spark, path)
    folder = hadoop_path.getParent()
    fs.mkdirs(folder)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    stream.write(bytearray(json.dumps(note).encode()))
    stream.close()
    if not fs.exists(hadoop_path) and fs.rename(hidden, hadoop_path):
        return True
    fs.delete(hidden, False)
    return False


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a name that is free."""
    fs, source_path = _resolve(spark, source)
    _, target_path = _resolve(spark, target)
    fs.mkdirs(target_path.getParent())
    if fs.exists(target_path) or not fs.rename(source_path, target_path):
        raise FileExistsError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)
