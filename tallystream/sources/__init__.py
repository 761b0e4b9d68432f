from tallystream.sources.days import day_folder, read_day
from tallystream.sources.jdbc import Database, jdbc_bounds, jdbc_scan
from tallystream.sources.landing import csv_landing_scan
from tallystream.sources.snapshots import (
    day_stamp,
    latest_snapshot,
    read_snapshots,
    second_stamp,
)
from tallystream.sources.topic import Topic, file_topic, kafka_topic, read_topic, stream_topic

__all__ = [
    "Database",
    "Topic",
    "csv_landing_scan",
    "day_folder",
    "day_stamp",
    "file_topic",
    "jdbc_bounds",
    "jdbc_scan",
    "kafka_topic",
    "latest_snapshot",
    "read_day",
    "read_snapshots",
    "read_topic",
    "second_stamp",
    "stream_topic",
]
