"""Mixing sources to target weights: cube-method balanced sampling of documents.

A source whose target is r times its size takes every document floor(r) times, and each once more
with probability p, the rest of r. The cube method decides those: in the space of all
probabilities it moves along directions that change neither the expected words nor the expected
number of documents, until a document's probability is 0 or 1. What is left, a few documents of
each block, meets in new blocks, until one block is left per source and only its last
documents are rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm.tables import id_of, key_of, store, table

WEIGHTS = (3, 1, 2)
#: Words of the mix for each word of the input, and the most often that a document is taken.
SHARE, MOST = 1.5, 2
#: Documents of a block, those it leaves (of a source's last block all their roundings are tried),
#: and rows written at a time.
BLOCK, LANDING = 1_000, 10
ROWS_PER_CHUNK = 4_096
#: Sums balanced: words and documents.
_BALANCES = 2


def _direction(x: np.ndarray) -> np.ndarray:
    """A move of probabilities that changes no row of ``x``: the first one's, with the others' answer."""
    inner = np.linalg.pinv(x @ x.T, rcond=1e-12)
    for j in range(x.shape[1]):
        move = -((inner @ x[:, j]) @ x)
        move[j] += 1
        move[np.abs(move) < 1e-12] = 0
        if move.any():
            return move
    raise AssertionError("more probabilities than sums leave a direction")


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, keep: int) -> np.ndarray:
    """Move probabilities to 0 or 1 until at most ``keep`` of them lie between.

    Words ``p @ size`` and documents ``p.sum()`` stay, and a step goes to either end of its line
    with the odds that keep each probability as a mean. Large documents are decided first, against
    all smaller ones, so those left between are among the smallest.
    """
    p = p.copy()
    by_size = np.argsort(-size, kind="stable")
    between = by_size[(p[by_size] > 0) & (p[by_size] < 1)]
    while len(between) > max(keep, _BALANCES):
        here = p[between]
        words = size[between] / max(size[between].max(), 1)
        move = _direction(np.stack([np.ones(len(between)), words]))
        moving = np.abs(move[move != 0])
        rising = move > 0
        ahead = (np.where(rising, 1 - here, here)[move != 0] / moving).min()
        behind = (np.where(rising, here, 1 - here)[move != 0] / moving).min()
        here += move * (ahead if rng.random() * (ahead + behind) < behind else -behind)
        here[here < 1e-9] = 0
        here[here > 1 - 1e-9] = 1
        p[between] = here
        between = between[(here > 0) & (here < 1)]
    return p


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the few that lie between so that words, then documents, come nearest to their sums."""
    p = p.copy()
    between = np.flatnonzero((p > 0) & (p < 1))
    ways = np.arange(1 << len(between))[:, None] >> np.arange(len(between)) & 1
    words = np.abs((ways - p[between]) @ size[between])
    documents = np.abs((ways - p[between]).sum(axis=1))
    p[between] = ways[np.lexsort([documents, np.round(words, 6)])[0]]
    return p


def _fly(round_: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def fly(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "doc"], ascending=[False, True], ignore_index=True)
        source, block, alone = (int(group[c].iloc[0]) for c in ("source_id", "block", "alone"))
        size = group["size"].to_numpy(np.float64)
        rng = np.random.default_rng([source, block, round_])
        p = flight(group["p"].to_numpy(), size, rng, LANDING)
        return group.assign(p=landing(p, size) if alone else p)

    return fly


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, source_id (its place by code point, null last), target.

    All targets make ``share`` times all sizes, by ``weights`` in turn; none is above ``most`` times
    its source's size, and what others cannot take is shared again. The level at which this
    settles is found by repeated sums over the sources, of which two numbers reach the driver.
    """
    spark = sizes.sparkSession
    ordered = store(
        sizes.orderBy(F.col("source").asc_nulls_last()).select(
            "source", "source_size", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")
        ),
        "sources",
    )
    starts, start = [], 0
    for r in ordered.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        starts.append((r["part"], start))
        start += r["n"]
    starts = F.broadcast(spark.createDataFrame(starts, "part int, start long"))
    place = F.col("start") + F.col("row").bitwiseAND((1 << 33) - 1)
    turns = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = store(
        ordered.join(starts, "part").select(
            "source", "source_size", place.alias("source_id"),
            F.get(turns, (place % len(weights)).cast("int")).alias("weight"),
            (F.col("source_size") * most).alias("cap"),
        ),
        "weights",
    )
    level, full = 0.0, -1
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        capped = F.col("cap") <= F.col("weight") * F.lit(level)
        sums = ranked.agg(
            F.count_if(capped).alias("full"),
            F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)).alias("taken"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
        ).first()
        if sums["full"] == full or not sums["weight"]:
            break
        full, level = sums["full"], (total - sums["taken"]) / sums["weight"]
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", "source_id", target.alias("target"))


def _decided(units: DataFrame) -> DataFrame:
    """The same units with probabilities of 0 and 1 only, block by block."""
    done, open_, round_ = [units.filter("p = 0")], units.filter("p > 0"), 0
    while True:
        counts = open_.groupBy("source_id").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        if counts.isEmpty():
            break
        block = F.pmod(F.xxhash64("doc", "size", F.lit(round_)), F.col("blocks"))
        dealt = open_.join(counts, "source_id").withColumns({"block": block, "alone": (F.col("blocks") == 1).cast("int")})
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)
        flown = dealt.groupBy("source_id", "block").applyInPandas(_fly(round_), schema)
        flown = store(flown.select(*units.columns), "flight")
        done.append(flown.filter("p = 0 OR p = 1"))
        open_, round_ = flown.filter("p > 0 AND p < 1"), round_ + 1
    return reduce(DataFrame.unionByName, done)


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, times, taken: how often the mix takes each document.

    A size is the number of words; a source's ``taken`` words come as near to its ``target`` as its
    last few documents allow, and its number of documents stays balanced with them. ``times`` is at
    most ``most``. The same rows give the same mix, however they are split into tasks. Only the
    last documents of a source (``LANDING``) are rounded to be near instead of drawn.

    A null text has no words; a null source is a source of its own, the last. Rows without an id
    and equal rows count each by itself: of c rows alike, as many as c times the probability says
    are taken once more, and only what is left of it is drawn. Sources without words have the
    target 0. Other columns are not read. No rows give no rows.
    """
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    measured = docs.select(
        key_of("doc_id").alias("doc"), F.col("source").cast("string").alias("source"), words.cast("long").alias("size")
    )
    units = store(measured.groupBy("doc", "source", "size").agg(F.count("*").alias("rows")), "documents")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    goals = targets(sizes, weights, share, most).withColumnRenamed("source", "name")
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    drawn = F.col("rows") * (F.col("ratio") - F.floor("ratio"))
    planned = store(
        units.join(goals, F.col("source").eqNullSafe(F.col("name")))
        .withColumn("ratio", ratio)
        .withColumns({"always": F.floor("ratio"), "surely": F.floor(drawn), "p": drawn - F.floor(drawn)})
        .drop("name", "ratio"),
        "plan",
    )
    # Copies are written out again in chunks, so that many of one document do not stay in one task.
    last = F.floor((F.col("rows") - 1) / ROWS_PER_CHUNK)
    chunks = _decided(planned).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    first = F.col("chunk") * ROWS_PER_CHUNK
    copies = F.sequence(first, F.least("rows", first + ROWS_PER_CHUNK) - 1)
    times = F.col("always") + (F.col("copy") < F.col("surely") + F.col("p")).cast("long")
    return (
        chunks.repartition("doc", "size", "chunk")
        .withColumn("copy", F.explode(copies))
        .withColumn("times", times)
        .select(
            id_of("doc").alias("doc_id"), "source", "size", "source_size", "target", "times",
            (F.col("size") * F.col("times")).alias("taken"),
        )
    )


def op11_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed to 150 % of their words with sources weighing 3, 1, 2 in turn."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")
