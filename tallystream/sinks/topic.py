"""Topics as targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.functions.envelope import to_envelope
from tallystream.operators.versions import tally_keys
from tallystream.sinks.fanout import Sink
from tallystream.sources.topic import Topic


def write_topic(envelope: DataFrame, topic: Topic) -> None:
    """Append ``key`` and ``value`` records, each task writing its own share."""
    records = envelope.withColumns(
        {"key": F.col("key").cast("binary"), "value": F.col("value").cast("binary")}
    )
    writer = records.write.format(topic.format).mode("append").options(**topic.write_options)
    writer.save(topic.path)


def replay_publish(
    df: DataFrame, topic: Topic, key: str = "athlete_id", keep: Sequence[str] = ()
) -> None:
    """Publish a table, one JSON record per row, keyed by ``key`` (which may be NULL)."""
    write_topic(to_envelope(df, [key], keep), topic)


def stamp(df: DataFrame, batch_id: int, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows with the ``batch_id`` and a ``record_id`` made of their keys (by default, of tallies).

    A batch that is sent again gives its records the same two, so that a reader can tell
    (see ``streaming.drop_repeats``). Averages may differ in the last digit then; keys do not.
    """
    keys = tally_keys(df) if keys is None else keys
    record = F.md5(F.to_json(F.struct(*keys)).cast("binary"))
    return df.withColumns({"batch_id": F.lit(batch_id).cast("long"), "record_id": record})


def topic_sink(
    topic: Topic, key_columns: Sequence[str] = ("sport",), stamped: bool = False
) -> Sink:
    """Micro-batches as records keyed by ``key_columns``.

    The default key is shared by many groups. Name all group columns if the topic is
    compacted, or it would keep one group per sport only. ``stamped`` adds what tells a
    batch that is sent again (see ``stamp``).
    """

    def write(df: DataFrame, batch_id: int) -> None:
        rows = stamp(df, batch_id) if stamped else df
        write_topic(to_envelope(rows, key_columns), topic)

    return write
