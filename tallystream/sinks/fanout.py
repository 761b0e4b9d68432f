"""One micro-batch, several targets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tallystream.operators.preview import preview

Sink = Callable[[DataFrame, int], None]

ROWS_PER_TASK = 500_000


def fanout_batch(
    sinks: Sequence[Sink], preview_rows: int = 0, rows_per_task: int = ROWS_PER_TASK
) -> Sink:
    """A ``foreachBatch`` callback that gives each non-empty batch to all ``sinks`` in turn.

    There is no transaction across the sinks: after a failure the batch is run again
    from the first one, so each must cope with a batch it has already seen. Empty
    batches occur when only a watermark moved or no record was usable.

    The batch is computed once, by counting its rows. A batch has as many partitions
    as the state store, often with few rows each; they are merged to
    ``rows_per_task``, which saves small files, connections and producers.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = batch.count()
            if rows == 0:
                return
            merged = batch.coalesce(-(-rows // rows_per_task))
            if preview_rows:
                preview(merged, preview_rows, show=True)
            for sink in sinks:
                sink(merged, batch_id)
        finally:
            batch.unpersist()

    return deliver
