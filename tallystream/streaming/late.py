"""Results that wait for their biography.

Two streaming queries. The first joins the stream of results to a stream of biographies and
keeps both as state, so it does not matter which of the two comes first; joined rows go to a
folder. The second keeps running tallies of that folder. (Spark emits updates of one stateful
step only; its file sink and source between the two count each row once.)
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallystream.functions.envelope import parse_envelope
from tallystream.operators.biography import clean_biography
from tallystream.operators.enrich import (
    KEY,
    PROFILE_COLUMNS,
    RESULT_COLUMNS,
    Hot,
    biography_side,
    salted,
    tally,
)
from tallystream.schemas import RESULT_EVENT
from tallystream.streaming.enrichment import POSITION

_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def wait_for_biographies(
    records: DataFrame,
    biographies: DataFrame,
    patience: str | None = None,
    *,
    schema: T.StructType = RESULT_EVENT,
    carry: Sequence[str] = (),
    spread: int = 1,
    hot: Hot = None,
) -> DataFrame:
    """Results of a topic joined to streamed raw biographies, whichever comes first.

    Gives the result columns, those of the biography and ``matched``. Each biography of an
    athlete, copies included, meets each of the athlete's results once, so with enough patience the rows
    are those of the batch join. Biographies stay in the state for ever.

    Results stay as long, unless ``patience`` (a duration) says how much later a biography may
    come. A result without one is given up then: it is emitted with ``matched`` false, once a
    later batch moves the clock. The clock is the time of processing: by a time of their own,
    biographies older than the results would be late, and Spark drops what is late. Results
    without an athlete wait in vain like others.

    ``spread`` and ``hot`` salt the results of dominant athletes, as in ``operators.enrich``; the
    biographies are kept once for each salt.
    """
    fields = [KEY, *RESULT_COLUMNS, *carry]
    results = parse_envelope(records, schema, fields, keep=POSITION)
    results = results.withColumn("arrived", F.current_timestamp())
    side = biography_side(clean_biography(biographies)).withColumn("known", F.current_timestamp())
    if spread > 1:
        left, right = salted(results, side, [*RESULT_COLUMNS, *carry, "arrived"], spread, hot)
    else:
        left, right = results.select(KEY, *RESULT_COLUMNS, *carry, "arrived"), side
    right = right.withColumnsRenamed({KEY: "bio_id", "salt": "bio_salt"})
    same = F.col(KEY) == F.col("bio_id")
    if spread > 1:
        same &= F.col("salt") == F.col("bio_salt")
    if patience is None:
        joined = left.join(right, same)
    else:
        joined = left.withWatermark("arrived", "0 seconds").join(
            right.withWatermark("known", "0 seconds"),
            same & (F.col("known") <= F.col("arrived") + F.expr(f"INTERVAL {patience}")),
            "leftOuter",
        )
    return joined.select(
        KEY, *RESULT_COLUMNS, *carry, *PROFILE_COLUMNS, "height", "weight",
        F.col("bio_id").isNotNull().alias("matched"),
    )


def start_joining(
    joined: DataFrame, output: str, checkpoint: str, *, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Write the rows of ``wait_for_biographies`` to the folder ``output``, each once.

    Those given up are the partition ``matched=false``.
    """
    spark = joined.sparkSession
    writer = (
        joined.writeStream.format("parquet")
        .partitionBy("matched")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    # Both sides go by one clock. It must move on while no biography comes, or none is given up.
    before = spark.conf.get(_POLICY, None)
    spark.conf.set(_POLICY, "max")
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(_POLICY)
        else:
            spark.conf.set(_POLICY, before)


def tally_stream(spark: SparkSession, folder: str, schema: T.StructType, **options: str) -> DataFrame:
    """Running tallies of the joined rows in ``folder``, for ``start_enrichment``.

    ``schema`` is that of ``wait_for_biographies``. Rows given up are not counted.
    """
    rows = spark.readStream.schema(schema).options(**options).parquet(folder)
    return tally(rows.filter("matched"))
