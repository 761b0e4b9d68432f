"""Records that cannot be read, kept beside those that can."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallystream.functions.envelope import judge_envelope
from tallystream.sinks.fanout import ROWS_PER_TASK, Sink

#: Where a record came from, kept with it on either side.
ORIGIN = ("key", "topic", "partition", "offset", "timestamp")


def split_records(
    records: DataFrame,
    schema: T.StructType,
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = ORIGIN,
    required: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined): every record is in exactly one of them.

    Accepted records have the ``keep`` columns and their fields, quarantined ones the ``keep``
    columns, the raw ``value`` and the ``fault``.
    """
    return _sides(judge_envelope(records, schema, fields, keep, required), keep)


def _sides(judged: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    faulty = F.col("fault").isNotNull()
    accepted = judged.filter(~faulty).drop("value", "fault")
    return accepted, judged.filter(faulty).select(*keep, "value", "fault")


def split_topic(
    records: DataFrame,
    schema: T.StructType,
    accepted: Sink | None,
    quarantined: Sink,
    checkpoint: str,
    *,
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = ORIGIN,
    required: Sequence[str] = (),
    trigger: dict[str, Any] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> StreamingQuery:
    """Follow a topic and give each micro-batch's readable and unreadable records to a sink each.

    A batch is parsed once, by counting it. A side without records is not delivered, so no
    empty folders arise. After a failure a batch is run again from the accepted side on; a
    ``log_sink`` replaces what it has seen. Without ``accepted``, only the faulty ones are kept,
    beside an enrichment that follows the same topic and passes over them.
    """
    judged = judge_envelope(records, schema, fields, keep, required)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        if accepted is None:
            batch = batch.filter("fault IS NOT NULL")
        batch = batch.persist()
        try:
            rows, faulty = batch.agg(F.count("*"), F.count("fault")).first()
            good, bad = _sides(batch, keep)
            for sink, side, n in ((accepted, good, rows - faulty), (quarantined, bad, faulty)):
                if n and sink is not None:
                    sink(side.coalesce(-(-n // rows_per_task)), batch_id)
        finally:
            batch.unpersist()

    writer = judged.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
