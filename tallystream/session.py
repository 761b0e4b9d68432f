"""Session builder used by the command line, the tests and the benchmark.

Every transform in the package also works on a session built elsewhere; nothing
here is required for correct results except a UTC session time zone.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "tallystream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    initial_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session.

    ``shuffle_partitions`` is the number of state-store partitions of a streaming
    query, and that number is fixed by the first run of a checkpoint: size it for the
    state expected later, not for the first day.

    ``initial_partitions`` is what a batch shuffle starts with (by default as many).
    AQE merges partitions that turn out small but never makes more, so choose the
    largest shuffle divided by a few hundred megabytes.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if initial_partitions is not None:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            initial_partitions
        )
    settings.update(conf or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
