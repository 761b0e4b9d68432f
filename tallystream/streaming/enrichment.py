"""The continuous job: records in, running averages and counts out."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import partial
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallystream.functions.envelope import decode_topic, judge_envelope, parse_envelope
from tallystream.operators.biography import clean_biography
from tallystream.operators.enrich import KEY, RESULT_COLUMNS, SPREAD, Hot, enrich_agg
from tallystream.operators.sizing import BROADCAST_LIMIT
from tallystream.schemas import RESULT_EVENT
from tallystream.sinks.fanout import Sink, fanout_batch
from tallystream.streaming.metrics import observe_records, observe_unmatched

POSITION = ("partition", "offset")


def enrichment_stream(
    records: DataFrame,
    biography: DataFrame,
    *,
    schema: T.StructType = RESULT_EVENT,
    event_time: str | None = None,
    watermark: str = "1 minute",
    window: str | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    spread: int = SPREAD,
    hot: Hot = None,
    profiles: str | None = None,
    profile_buckets: int | None = None,
    metrics: str | None = None,
) -> DataFrame:
    """Running tallies of topic ``records`` joined to a raw ``biography`` table.

    Only the fields in use are parsed. The biography is read anew by every
    micro-batch, so athletes added to a database table join from the next batch on
    (of a folder, the files it had when the stream was defined). Its size is checked
    for broadcasting when the stream is defined; ``spread`` and ``hot`` say how a hot
    athlete is dealt with if it is too large (see ``operators.enrich``).

    ``profiles`` names a folder of this job alone. Biographies too large to broadcast are
    then cleaned and grouped once, when the stream is defined, and stored there in place of
    an earlier copy; micro-batches read that copy, and changes show when the stream is
    defined again. No other query may be reading the folder at that time. With ``profile_buckets``
    the copy is stored as the join takes it, salts included, in so many buckets: a micro-batch
    reads it without an exchange and moves its records only. It takes as many tasks as buckets.

    ``window`` adds a window over the event time as a group key. The event time is
    the time of processing, unless ``event_time`` names a field of the record, and
    ``watermark`` says how late a record may be. Without a window neither has any
    effect on the results. They are left out then, because Spark follows each batch
    that moves a watermark by an empty one, which reads the biography for nothing.

    ``metrics`` names what each batch is observed for: how many records it had and how many
    of them led to nothing, and why (see ``streaming.metrics``).
    """
    fields = [KEY, *RESULT_COLUMNS, *([event_time] if event_time else [])]
    if metrics:
        results = observe_records(judge_envelope(records, schema, fields, keep=POSITION), metrics)
    else:
        results = parse_envelope(records, schema, fields, keep=POSITION)
    if window:
        stamp = F.col(event_time).try_cast("timestamp") if event_time else F.current_timestamp()
        results = results.withColumn("event_time", stamp).withWatermark("event_time", watermark)

    def stored(grouped: DataFrame) -> DataFrame:
        grouped.write.mode("overwrite").parquet(profiles)
        return grouped.sparkSession.read.schema(grouped.schema).parquet(profiles)

    def bucketed(side: DataFrame) -> DataFrame:
        # A name of its own for each folder, so that two jobs of a session do not meet.
        name = f"profiles_{hashlib.md5(profiles.encode()).hexdigest()}"
        spark, keys = side.sparkSession, (KEY, "salt")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        dealt = side.repartition(profile_buckets, *keys)  # as the buckets are: one file for each
        writer = dealt.write.bucketBy(profile_buckets, *keys).sortBy(*keys).mode("overwrite")
        writer.option("path", profiles).format("parquet").saveAsTable(name)
        return spark.table(name)

    return enrich_agg(
        results,
        clean_biography(biography),
        window=window,
        broadcast_limit=broadcast_limit,
        spread=spread,
        hot=hot,
        keep=stored if profiles and not profile_buckets else None,
        keep_salted=bucketed if profiles and profile_buckets else None,
        watch=partial(observe_unmatched, name=metrics) if metrics else None,
    )


def start_enrichment(
    tallies: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    *,
    output_mode: str = "update",
    preview_rows: int = 0,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Start delivering ``tallies``; ``update`` emits the groups a batch has touched.

    Offsets and state live in ``checkpoint``: a query started there again goes on
    where the last one stopped. ``trigger`` is passed to Spark, for instance
    ``{"availableNow": True}``; by default batches follow each other at once.
    """
    writer = (
        tallies.writeStream.foreachBatch(fanout_batch(sinks, preview_rows))
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def keep_enriching(
    define: Callable[[], DataFrame],
    sinks: Sequence[Sink],
    checkpoint: str,
    *,
    seconds: float,
    rounds: int | None = None,
    **options: Any,
) -> None:
    """Run the job for good, but define it anew every ``seconds``.

    ``define`` builds the tallies, so each round measures the biography again and
    broadcasts it only if it still fits (and sees files added to a folder). A batch
    that a round leaves unfinished is run again by the next one. ``options`` are those
    of ``start_enrichment``; a query that ends by itself ends the job.
    """
    while rounds is None or rounds > 0:
        query = start_enrichment(define(), sinks, checkpoint, **options)
        if query.awaitTermination(seconds):
            return
        query.stop()
        if rounds is not None:
            rounds -= 1


def drop_repeats(decoded: DataFrame, within: str = "1 hour") -> DataFrame:
    """Decoded records of a stamped topic, each once, for batch or stream.

    A record is known by the ``batch_id`` and ``record_id`` that its sender gave it. In a stream
    these are remembered until the records' own ``timestamp``, that of their batch, lies ``within``
    behind the newest one; what is older still has been seen and is dropped. Records without a
    stamp cannot be told apart: they are all kept, unless they are that old.
    """
    stamp = {
        "batch_id": F.coalesce("value.batch_id", F.lit(-1)),
        "record_id": F.coalesce("value.record_id", F.expr("uuid()")),
    }
    named = decoded.withColumns(stamp)
    if not decoded.isStreaming:
        return named.dropDuplicates([*stamp]).drop(*stamp)
    timed = named.withColumn("sent", F.col("value.timestamp")).withWatermark("sent", within)
    return timed.dropDuplicatesWithinWatermark([*stamp]).drop(*stamp, "sent")


def follow_topic(
    records: DataFrame,
    schema: T.StructType,
    checkpoint: str,
    output: str,
    *,
    once_within: str | None = None,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Write every decoded record to the folder ``output`` (Parquet) as it arrives.

    ``checkpoint`` remembers the position; a batch repeated after a restart is not added
    twice. Records that their sender sent twice are, unless they are stamped and ``once_within``
    says how long apart the two may be (see ``drop_repeats``). Nothing is shown: read the folder, or a part of it with ``preview``.
    """
    decoded = decode_topic(records, schema)
    if once_within is not None:
        decoded = drop_repeats(decoded, once_within)
    writer = (
        decoded.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
