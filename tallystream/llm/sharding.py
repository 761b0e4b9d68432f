"""Sharding: vector bin packing of groups by bytes, tokens and rows together.

A group is placed in the shard where the dot product of its size vector with the shard's
residual capacity is highest. Groups beyond a share of a shard are cut into pieces, those beyond
a smaller share of the whole are placed one by one; all others are gathered by hash into a fixed
number of bundles, so the placement itself handles a bounded number of items at any corpus size.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystream.llm.tables import store, table

SHARDS = 16
#: Bundles of small groups; a larger group than this share of all bytes, tokens or rows is placed alone.
BUNDLES = 4096
#: Groups of up to this share of a shard's bytes, tokens and rows are never cut.
WHOLE = 0.25
ROWS_PER_SLOT_RANGE = 1_000
MEASURES = ("bytes", "tokens", "rows")


def place(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item (row of ``sizes``), largest first.

    Sizes and capacities are shares of the totals. When nothing fits, the residuals are
    negative and the rule still picks the least overfull shard. Ties go to the lower shard.
    """
    totals = np.maximum(sizes.sum(axis=0, dtype=np.float64), 1)
    share = sizes / totals
    residual = np.full((shards, sizes.shape[1]), 1 / shards)
    chosen = np.zeros(len(sizes), np.int64)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        chosen[i] = np.argmax(residual @ share[i])
        residual[chosen[i]] -= share[i]
    return chosen


def measured(docs: DataFrame, group: Column) -> DataFrame:
    """Sizes of every row and a number of its own, once stored; the text itself goes no further."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        group.alias("group_key"),
        F.monotonically_increasing_id().alias("row"),
    )


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    group: Column | None = None,
    bundles: int = BUNDLES,
) -> DataFrame:
    """Place all rows into ``shards`` shards of near equal bytes, tokens and rows.

    Returns doc_id, size, text_crc32, tokens, group_key, shard, slot (gapless from 0 per shard).

    ``group`` names the group of a row, by default its text (64-bit hash; two texts that
    share one are merely placed together). Rows of a group share a shard unless the group is
    larger than a quarter of a shard, when it is cut by row into pieces of about that. A null text
    counts one byte, no token and a group of its own; null or repeated ids and equal rows are
    placed one by one. Slots and pieces follow the rows' numbers in the stored sizes, so another
    split of the input into tasks can give others. No rows give no rows.
    """
    spark = docs.sparkSession
    if group is None:
        group = F.xxhash64(F.col("text"))
    rows = store(measured(docs, group), "sizes")
    sums = [
        F.sum("size").alias("bytes"),
        F.sum("tokens").alias("tokens"),
        F.count("*").alias("rows"),
    ]
    totals = rows.agg(*sums).first()
    total = {m: totals[m] or 0 for m in MEASURES}
    alone = [F.col(m) > max(1, -(-total[m] // bundles)) for m in MEASURES]
    times = [F.ceil(F.col(m) / F.lit(max(1.0, WHOLE * total[m] / shards))) for m in MEASURES]
    # At most 3 * bundles groups can exceed a limit, so this is bounded; so are the pieces.
    heavy = (
        rows.groupBy("group_key").agg(*sums)
        .filter(functools.reduce(Column.__or__, alone))
        .select("group_key", F.least("rows", F.greatest(*times)).alias("pieces"))
        .orderBy("group_key").collect()
    )
    first, listed = bundles, []
    for r in heavy:
        listed.append((r["group_key"], first, r["pieces"]))
        first += r["pieces"]
    cut = spark.createDataFrame(listed, "group_key long, first long, pieces long")
    keyed = rows.join(F.broadcast(cut), "group_key", "left").withColumn(
        "item",
        F.when(
            F.col("first").isNotNull(),
            F.col("first") + F.pmod(F.xxhash64("row"), F.col("pieces")),
        ).otherwise(F.pmod(F.xxhash64("group_key"), F.lit(bundles))),
    )
    items = keyed.groupBy("item").agg(*sums).orderBy("item").collect()
    sizes = np.array([[r[m] for m in MEASURES] for r in items], np.float64).reshape(-1, len(MEASURES))
    chosen = place(sizes, shards)
    places = spark.createDataFrame(
        [(r["item"], int(s)) for r, s in zip(items, chosen, strict=True)], "item long, shard int"
    )
    placed = keyed.join(F.broadcast(places), "item").select(
        "doc_id", "size", "text_crc32", "tokens", "group_key", "shard", "row"
    )
    return with_slots(placed, totals["rows"], shards)


def with_slots(placed: DataFrame, rows: int, shards: int) -> DataFrame:
    """Number the rows of each shard from 0: prefix sums over ranges, then within each range."""
    ranges = max(1, rows // (shards * ROWS_PER_SLOT_RANGE))
    placed = placed.withColumn("range", F.pmod(F.xxhash64("row"), F.lit(ranges)))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
        .select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("shard", "range").orderBy("row")
    return (
        placed.withColumn("nth", F.row_number().over(within))
        .join(starts, ["shard", "range"])
        .withColumn("slot", (F.col("base") + F.col("nth") - 1).cast("long"))
        .drop("range", "nth", "base", "row")
    )


def op3_shard_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards of near equal size."""
    placed = shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )
