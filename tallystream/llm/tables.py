"""Intermediate tables in the shared folder, and a few column helpers."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.scratch import new_dir

#: Stands for a null id inside the operators: larger than any other, and null again on output.
NO_ID = (1 << 63) - 1
#: Settings of the writes: shuffle files go as each write ends, not when the driver collects
#: garbage; batches of whole texts are small enough for an executor with little memory.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


@contextmanager
def write_settings(spark: SparkSession):
    """``SETTINGS`` for the writes inside, and the session's own again behind them."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder that all executors share and read it back.

    A lost executor takes nothing with it that later steps need, and both sides of a join
    between stored tables are plain exchanges, which AQE can split when a key is hot.
    """
    spark = df.sparkSession
    path = new_dir(spark, f"llm-{label}")
    with write_settings(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_of(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def id_of(key: str) -> Column:
    return F.when(F.col(key) != NO_ID, F.col(key))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def refuse_names(df: DataFrame, added: list[str]) -> None:
    """An error if ``df`` has columns named like those that an operator adds."""
    taken = sorted(set(added) & {c.lower() for c in df.columns})
    if taken:
        raise ValueError(f"rename the columns {taken}, which the operator adds")


def one_text(docs: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """doc_id and text, one for each id (of ``ids``): a sample by id stays as small as it was asked for."""
    rows = docs.select("doc_id", "text") if ids is None else docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    return rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
