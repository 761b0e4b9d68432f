"""Running tallies that forget groups which have been idle for long.

Spark's own streaming aggregate keeps a group for ever unless a window closes it. Here each
group is an arbitrary state with a timer. Rows are summed up where they are read, and what
reaches the state is one row per group and Arrow batch, so a dominant group costs little.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallystream.functions.envelope import parse_envelope
from tallystream.operators.biography import clean_biography
from tallystream.operators.enrich import (
    KEY,
    PROFILE_COLUMNS,
    RESULT_COLUMNS,
    SPREAD,
    Hot,
    contributions,
)
from tallystream.operators.sizing import BROADCAST_LIMIT
from tallystream.schemas import RESULT_EVENT, TALLY_KEYS
from tallystream.sinks.fanout import Sink
from tallystream.streaming.enrichment import POSITION, start_enrichment

_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_KEYS = ("sport string", "medal string", "sex string", "bio_country_noc string")
_SUMS = ("sum_height", "n_height", "sum_weight", "n_weight", "athlete_count")
_STATE = "sum_height double, n_height long, sum_weight double, n_weight long, athlete_count long"
_OUTPUT = f"{', '.join(_KEYS)}, avg_height double, avg_weight double, athlete_count long"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per group of a batch."""
    for batch in batches:
        groups = pa.Table.from_batches([batch]).group_by(list(TALLY_KEYS), use_threads=False)
        sums = groups.aggregate([(name, "sum") for name in _SUMS])
        named = pa.table([sums[k] for k in TALLY_KEYS] + [sums[f"{s}_sum"] for s in _SUMS], [*TALLY_KEYS, *_SUMS])
        yield from named.to_batches()


def _mean(total: float, n: int) -> float | None:
    return total / n if n else None


def expiring_tallies(
    records: DataFrame,
    biography: DataFrame,
    idle_seconds: float,
    *,
    broadcast_limit: int = BROADCAST_LIMIT,
    spread: int = SPREAD,
    hot: Hot = None,
) -> DataFrame:
    """As ``enrichment_stream``, but a group without results for ``idle_seconds`` is forgotten.

    Its last totals remain with whoever received them; results that come later start from nothing.
    The clock is the time of processing. Timers fire with the batches, so a group stays until the
    next batch at least, and one that gets results in the batch in which its time is up stays.
    """
    if idle_seconds <= 0:
        raise ValueError("groups need some time before they are idle")
    idle = int(idle_seconds * 1000)

    def update(
        key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        total = list(state.get) if state.exists else [0.0, 0, 0.0, 0, 0]
        for frame in frames:
            total = [t + frame[name].sum() for t, name in zip(total, _SUMS, strict=True)]
        total = [kind(t) for kind, t in zip((float, int, float, int, int), total, strict=True)]
        state.update(tuple(total))
        state.setTimeoutDuration(idle)
        height, heights, weight, weights, count = total
        row = (*key, _mean(height, heights), _mean(weight, weights), count)
        yield pd.DataFrame([row], columns=[*TALLY_KEYS, "avg_height", "avg_weight", "athlete_count"])

    results = parse_envelope(records, RESULT_EVENT, [KEY, *RESULT_COLUMNS], keep=POSITION)
    joined = contributions(
        results, clean_biography(biography), broadcast_limit=broadcast_limit, spread=spread, hot=hot
    )
    rows = joined.select(*RESULT_COLUMNS, *PROFILE_COLUMNS, *_SUMS)
    return (
        rows.mapInArrow(_summed, f"{', '.join(_KEYS)}, {_STATE}")
        .groupBy(*TALLY_KEYS)
        .applyInPandasWithState(
            update, _OUTPUT, _STATE, "update", GroupStateTimeout.ProcessingTimeTimeout
        )
        .withColumn("timestamp", F.current_timestamp())
    )


def start_expiring(
    tallies: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    *,
    trigger: dict[str, Any] | None = None,
    preview_rows: int = 0,
) -> StreamingQuery:
    """Start delivering ``expiring_tallies``, by default once a minute.

    As long as it runs, timers fire with each trigger, whether records came or not. A run that
    only takes what is there (``{"availableNow": True}``) ends with the last records: Spark would
    otherwise go on with empty batches for ever, waiting for timers.
    """
    trigger = trigger or {"processingTime": "1 minute"}
    goes_on = "processingTime" in trigger
    spark = tallies.sparkSession
    before = spark.conf.get(_EMPTY_BATCHES)
    spark.conf.set(_EMPTY_BATCHES, str(goes_on).lower())
    try:
        return start_enrichment(tallies, sinks, checkpoint, trigger=trigger, preview_rows=preview_rows)
    finally:
        spark.conf.set(_EMPTY_BATCHES, before)
