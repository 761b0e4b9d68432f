from tallystream.streaming.enrichment import (
    drop_repeats,
    enrichment_stream,
    follow_topic,
    keep_enriching,
    start_enrichment,
)

from tallystream.streaming.expiring import expiring_tallies, start_expiring
from tallystream.streaming.late import start_joining, tally_stream, wait_for_biographies
from tallystream.streaming.metrics import MetricsLog, batch_metrics, read_metrics
from tallystream.streaming.quarantine import split_records, split_topic

__all__ = [
    "MetricsLog",
    "batch_metrics",
    "drop_repeats",
    "enrichment_stream",
    "expiring_tallies",
    "follow_topic",
    "keep_enriching",
    "read_metrics",
    "split_records",
    "split_topic",
    "start_enrichment",
    "start_expiring",
    "start_joining",
    "tally_stream",
    "wait_for_biographies",
]
