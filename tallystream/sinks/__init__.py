from tallystream.sinks.database import jdbc_append, jdbc_sink
from tallystream.sinks.fanout import fanout_batch
from tallystream.sinks.files import (
    drop_leftovers,
    log_sink,
    overwrite_day,
    publish_version,
    put_in_place,
    write_snapshot,
    write_version,
)
from tallystream.sinks.ledger import JdbcLedger
from tallystream.sinks.topic import replay_publish, topic_sink, write_topic

__all__ = [
    "JdbcLedger",
    "drop_leftovers",
    "fanout_batch",
    "jdbc_append",
    "jdbc_sink",
    "log_sink",
    "overwrite_day",
    "publish_version",
    "put_in_place",
    "replay_publish",
    "topic_sink",
    "write_snapshot",
    "write_topic",
    "write_version",
]
