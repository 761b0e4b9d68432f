"""The enrichment as a batch query."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.operators import (
    BROADCAST_LIMIT,
    clean_biography,
    enrich_agg,
    enrich_join,
    hot_athletes,
)
from tallystream.operators.enrich import PROFILE_COLUMNS, RESULT_COLUMNS
from tallystream.workload import domain


def rounded(tallies: DataFrame) -> DataFrame:
    """Tallies in comparable form: no clock, means without summation noise."""
    return tallies.drop("timestamp").withColumns(
        {"avg_height": F.round("avg_height", 6), "avg_weight": F.round("avg_weight", 6)}
    )


def tallies(spark: SparkSession, sf_dir: str, limit: int = BROADCAST_LIMIT) -> DataFrame:
    biography = clean_biography(domain.biographies(spark, sf_dir))
    return rounded(enrich_agg(domain.results(spark, sf_dir), biography, broadcast_limit=limit))


def tallies_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts with whether each row has its time."""
    biography = clean_biography(domain.biographies(spark, sf_dir))
    return enrich_agg(domain.results(spark, sf_dir), biography).select(
        *RESULT_COLUMNS,
        *PROFILE_COLUMNS,
        "athlete_count",
        F.col("timestamp").isNotNull().alias("stamped"),
    )


def tallies_without_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tallies(spark, sf_dir, limit=0)


def rows(spark: SparkSession, sf_dir: str, limit: int = BROADCAST_LIMIT) -> DataFrame:
    biography = clean_biography(domain.biographies(spark, sf_dir))
    results = domain.results(spark, sf_dir)
    return enrich_join(results, biography, carry=["result_id"], broadcast_limit=limit)


def rows_without_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, limit=0)


def rows_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a broadcast, a third of the results being one athlete's, which are salted."""
    biography = clean_biography(domain.biographies(spark, sf_dir))
    results = domain.skewed_results(spark, sf_dir)
    return enrich_join(
        results,
        biography,
        carry=["result_id"],
        broadcast_limit=0,
        hot=partial(hot_athletes, results),
    )


QUERIES = {
    "enrich_agg": tallies,
    "enrich_agg_stamped": tallies_stamped,
    "enrich_agg_shuffled": tallies_without_broadcast,
    "enrich_join": rows,
    "enrich_join_shuffled": rows_without_broadcast,
    "enrich_join_hot": rows_salted,
}

_ROWS_SQL = (
    "SELECT sport, medal, result_id, sex, bio_country_noc, height, weight "
    f"FROM ({domain.JOINED_SQL})"
)

ORACLES = {
    "enrich_agg": domain.TALLY_SQL,
    "enrich_agg_stamped": (
        "SELECT sport, medal, sex, bio_country_noc, count(*) AS athlete_count, true AS stamped "
        f"FROM ({domain.JOINED_SQL}) GROUP BY ALL"
    ),
    "enrich_agg_shuffled": domain.TALLY_SQL,
    "enrich_join": _ROWS_SQL,
    "enrich_join_shuffled": _ROWS_SQL,
    "enrich_join_hot": _ROWS_SQL.replace(domain.RESULTS_SQL, domain.SKEWED_RESULTS_SQL),
}
