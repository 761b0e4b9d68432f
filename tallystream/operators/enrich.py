"""Results joined to biographies, as rows and as running averages and counts.

The same code serves batch and streaming results. The biography side is broadcast
only if its measured size allows it; otherwise:

* batch rows use a sort-merge join, whose hot keys AQE splits by map output, or, if the
  ``hot`` athletes are named (see ``hot_athletes``), their rows are spread over
  ``spread`` salts and their biographies repeated as often;
* streamed rows, for which there is no AQE, are salted too: all of them, unless the
  ``hot`` athletes are named;
* the batch aggregate first counts results per (athlete, sport, medal), so that a
  hot athlete reaches the join as a handful of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.operators.sizing import BROADCAST_LIMIT, fits_broadcast

KEY = "athlete_id"
RESULT_COLUMNS = ("sport", "medal")
PROFILE_COLUMNS = ("sex", "bio_country_noc")
SPREAD = 16

# Athletes to salt, or a function that finds them, called only if salts are needed.
Hot = Sequence[int] | Callable[[], Sequence[int]] | None

# Given a side of a join, returns what is read in its place, for instance a stored copy.
Keep = Callable[[DataFrame], DataFrame]


def biography_side(biography: DataFrame) -> DataFrame:
    # Both sides have a country_noc; the biography's is the one that is kept.
    return biography.select(
        KEY, "sex", F.col("country_noc").alias("bio_country_noc"), "height", "weight"
    )


def hot_athletes(results: DataFrame, share: float = 0.01) -> list[int]:
    """Athletes with more than ``share`` of the rows; there are fewer than ``1 / share``.

    One pass: the total is the NULL group of a rollup, and as many of the largest groups
    as can exceed the share come to the driver with it.
    """
    known = results.filter(F.col(KEY).isNotNull())
    counts = known.rollup(KEY).agg(F.count("*").alias("n"))
    largest = counts.orderBy(F.desc("n")).limit(int(1 / share) + 2).collect()
    total = sum(r["n"] for r in largest if r[KEY] is None)
    return [r[KEY] for r in largest if r[KEY] is not None and r["n"] > total * share]


def _join(
    results: DataFrame,
    side: DataFrame,
    columns: Sequence[str],
    small: bool,
    spread: int,
    hot: Hot,
    how: str = "inner",
    keep_salted: Keep | None = None,
) -> DataFrame:
    """Join on the athlete; ``columns`` of the results survive."""
    if small:
        return results.select(KEY, *columns).join(F.broadcast(side), KEY, how)
    if hot is None and not results.isStreaming:
        return results.select(KEY, *columns).join(side.hint("merge"), KEY, how)
    salted_results, salted_side = salted(results, side, columns, spread, hot)
    if keep_salted is not None:
        salted_side = keep_salted(salted_side)
    return salted_results.join(salted_side.hint("merge"), [KEY, "salt"], how).drop("salt")


def salted(
    results: DataFrame, side: DataFrame, columns: Sequence[str], spread: int, hot: Hot
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a ``salt``: results have one of ``spread``, the other side each."""
    # The salt is a hash of the record with its topic position or whatever else tells it
    # from its copies, so a task that is run again puts its rows where the lost one did.
    salt = F.pmod(F.xxhash64(*results.columns), F.lit(spread)).cast("int")
    salts = F.sequence(F.lit(0), F.lit(spread - 1))
    if hot is not None:
        is_hot = F.col(KEY).isin(list(hot() if callable(hot) else hot))
        salt = F.when(is_hot, salt).otherwise(F.lit(0))
        salts = F.when(is_hot, salts).otherwise(F.array(F.lit(0)))
    return (
        results.select(KEY, *columns, salt.alias("salt")),
        side.withColumn("salt", F.explode(salts)),
    )


def enrich_join(
    results: DataFrame,
    biography: DataFrame,
    *,
    carry: Sequence[str] = (),
    broadcast_limit: int = BROADCAST_LIMIT,
    spread: int = SPREAD,
    hot: Hot = None,
) -> DataFrame:
    """One row per result and matching biography; NULL athletes match nothing.

    ``carry`` names further result columns to keep.
    """
    columns = (*RESULT_COLUMNS, *carry)
    side = biography_side(biography)
    small = fits_broadcast(side, broadcast_limit)
    joined = _join(results, side, columns, small, spread, hot)
    return joined.select(*columns, *PROFILE_COLUMNS, "height", "weight")


def tally(joined: DataFrame) -> DataFrame:
    """The same as ``enrich_agg``, out of rows that are joined already."""
    return (
        joined.groupBy(*RESULT_COLUMNS, *PROFILE_COLUMNS)
        .agg(
            F.avg("height").alias("avg_height"),
            F.avg("weight").alias("avg_weight"),
            F.count("*").alias("athlete_count"),
        )
        .withColumn("timestamp", F.current_timestamp())
    )


def _profiles(biography: DataFrame) -> DataFrame:
    """Sums per athlete, sex and country: duplicates of an id cost one row, not a fan-out."""
    return (
        biography_side(biography)
        .groupBy(KEY, *PROFILE_COLUMNS)
        .agg(
            F.sum("height").alias("sum_height"),
            F.count("height").alias("n_height"),
            F.sum("weight").alias("sum_weight"),
            F.count("weight").alias("n_weight"),
            F.count("*").alias("n_rows"),
        )
    )


def contributions(
    results: DataFrame,
    biography: DataFrame,
    *,
    broadcast_limit: int = BROADCAST_LIMIT,
    spread: int = SPREAD,
    hot: Hot = None,
) -> DataFrame:
    """What each result adds to its group: sums and counts of heights and weights, joined rows.

    Added up per sport, medal, sex and country they give the totals of ``enrich_agg``.
    """
    small = fits_broadcast(biography_side(biography), broadcast_limit // 2)
    joined = _join(results, _profiles(biography), RESULT_COLUMNS, small, spread, hot)
    return joined.withColumnRenamed("n_rows", "athlete_count")


def _mean(name: str) -> Column:
    total = F.sum(F.col("n") * F.col(f"sum_{name}"))
    rows = F.sum(F.col("n") * F.col(f"n_{name}"))
    return F.try_divide(total, rows).alias(f"avg_{name}")


def enrich_agg(
    results: DataFrame,
    biography: DataFrame,
    *,
    window: str | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    spread: int = SPREAD,
    hot: Hot = None,
    keep: Keep | None = None,
    keep_salted: Keep | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Mean height, mean weight and row count per sport, medal, sex and country.

    ``athlete_count`` counts joined rows, not distinct athletes. NULL keys form
    groups. On a stream these are running totals whose state is kept for ever,
    unless ``window`` (a duration over ``event_time``) adds a key that a watermark
    can expire; it shows as ``window_start`` and ``window_end``.

    ``keep`` is given the grouped biographies if they are too large to broadcast, and
    returns what the join reads in their place, for instance a stored copy. ``keep_salted`` is
    the same for them as the salted join of a stream takes them: with a ``salt``, and once for each.

    ``watch`` is given the results as they leave the join, with their number ``n`` and, where
    there was no biography, NULL for ``n_rows``, and returns them, for instance observed. Without
    it results without a biography do not leave the join.
    """
    keys = RESULT_COLUMNS
    if window:
        results = results.withColumn("window", F.window("event_time", window))
        keys = ("window", *RESULT_COLUMNS)
    # There are no more profiles than biographies, and none takes twice the bytes.
    small = fits_broadcast(biography_side(biography), broadcast_limit // 2)
    if small or results.isStreaming:
        counted = results.withColumn("n", F.lit(1).cast("long"))
    else:
        counted = results.groupBy(KEY, *keys).agg(F.count("*").alias("n"))
    profiles = _profiles(biography)
    if keep is not None and not small:
        profiles = keep(profiles)
    how = "inner" if watch is None else "left"
    joined = _join(counted, profiles, (*keys, "n"), small, spread, hot, how, keep_salted)
    if watch is not None:
        joined = watch(joined).filter(F.col("n_rows").isNotNull())
    tallies = (
        joined.groupBy(*keys, *PROFILE_COLUMNS)
        .agg(
            _mean("height"),
            _mean("weight"),
            F.sum(F.col("n") * F.col("n_rows")).alias("athlete_count"),
        )
        .withColumn("timestamp", F.current_timestamp())
    )
    if window:
        tallies = tallies.select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *[c for c in tallies.columns if c != "window"],
        )
    return tallies
