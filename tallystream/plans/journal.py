"""What a run has finished, so that it can go on where it broke."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

from tallystream.sources.paths import read_note, write_note

Watcher = Callable[[str, dict[str, Any]], None]


class Journal:
    """One small file per finished step in a folder of the run.

    A step counts as finished only with the options it was run with; ``watch`` is called
    with each step that finishes. Entries are written after the step's output, so a process
    that ends between the two repeats the step: steps must allow that.
    """

    def __init__(self, spark: SparkSession, folder: str, watch: Watcher | None = None) -> None:
        self.spark, self.folder, self.watch = spark, folder, watch

    def finished(self, step: str, **options: Any) -> str | None:
        """The path that a finished step has written."""
        entry = read_note(self.spark, self._entry(step, options))
        return entry["path"] if entry else None

    def finish(self, step: str, path: str, **options: Any) -> None:
        entry = {"step": step, "path": path, **options}
        write_note(self.spark, self._entry(step, options), entry)
        if self.watch:
            self.watch(step, entry)

    def _entry(self, step: str, options: dict[str, Any]) -> str:
        named = "".join(f"-{k}={options[k]}" for k in sorted(options))
        return f"{self.folder}/{step}{named}.json"
