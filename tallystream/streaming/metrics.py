"""What each micro-batch had, and what of it led to nothing.

The counts are observed where the rows pass, so they cost no further pass. Spark reports them
with the progress of the query; ``MetricsLog`` keeps them, one small file per batch.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from tallystream.operators.enrich import KEY
from tallystream.sources.paths import write_note

_SCHEMA = (
    "query string, batch_id long, started timestamp, records long, malformed long, "
    "without_athlete long, unmatched long, late long, state_rows long"
)


def observe_records(judged: DataFrame, name: str) -> DataFrame:
    """The fields of ``judge_envelope``, observed for records that cannot be used."""
    faulty, absent = F.col("fault").isNotNull(), F.col(KEY).isNull()
    return judged.observe(
        f"{name}_records",
        F.count("*").alias("records"),
        F.count_if(faulty).alias("malformed"),
        F.count_if(absent & ~faulty).alias("without_athlete"),
    ).drop("value", "fault")


def observe_unmatched(joined: DataFrame, name: str) -> DataFrame:
    """Results behind the join (see ``enrich_agg``), observed for those without a biography."""
    alone = F.col("n_rows").isNull() & F.col(KEY).isNotNull()
    unmatched = F.coalesce(F.sum(F.when(alone, F.col("n"))), F.lit(0))
    return joined.observe(f"{name}_unmatched", unmatched.alias("unmatched"))


def batch_metrics(report: StreamingQueryProgress, name: str) -> dict[str, Any] | None:
    """The counts of one batch out of Spark's report; None if the batch was not observed.

    ``malformed`` are records that are no JSON object or have a field of another type,
    ``without_athlete`` well-formed ones that name none, ``unmatched`` results whose athlete has no
    biography, ``late`` rows that came behind the watermark (all of a window's state in the
    batch), ``state_rows`` the groups that the query remembers.
    """
    progress = json.loads(report.json)
    observed = progress.get("observedMetrics") or {}
    if f"{name}_records" not in observed:
        return None
    state = progress.get("stateOperators") or []
    return {
        "query": progress["id"],
        "batch_id": progress["batchId"],
        "started": progress["timestamp"],
        **observed[f"{name}_records"],
        **observed.get(f"{name}_unmatched", {}),
        "late": sum(s["numRowsDroppedByWatermark"] for s in state),
        "state_rows": sum(s["numRowsTotal"] for s in state),
    }


class MetricsLog(StreamingQueryListener):
    """Keeps the counts of each observed batch as a file of ``folder``; read it with ``read_metrics``.

    Register it with ``spark.streams.addListener``. Reports arrive some time after their batch, so
    those of a query that has ended are complete after ``complete``. A batch that is run again
    after a restart keeps its first counts.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str) -> None:
        self.spark, self.folder, self.name = spark, folder, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._keep(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def complete(self, query: StreamingQuery) -> None:
        for progress in query.recentProgress:
            self._keep(progress)

    def _keep(self, report: StreamingQueryProgress) -> None:
        metrics = batch_metrics(report, self.name)
        if metrics:
            path = f"{self.folder}/{metrics['query']}-{metrics['batch_id']:012d}.json"
            write_note(self.spark, path, metrics)


def read_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """One row per observed batch; they add up over batches, but for ``state_rows``."""
    return spark.read.schema(_SCHEMA).json(folder)
