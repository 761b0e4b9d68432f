"""Topics: keyed records, read as a table or followed as a stream.

Kafka topics need the ``spark-sql-kafka-0-10`` package that matches the Spark and
Scala versions of the cluster. A folder of Parquet files with the same columns can
stand in for a topic anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallystream.schemas import TOPIC_RECORD


@dataclass(frozen=True)
class Topic:
    """A record source and sink: its Spark format and options for either direction."""

    format: str
    read_options: dict[str, str] = field(default_factory=dict)
    write_options: dict[str, str] = field(default_factory=dict)
    path: str | None = None
    schema: T.StructType | None = None

    def table_options(self) -> dict[str, str]:
        """Read options for a finite read, which Kafka does not let start at ``latest``."""
        options = dict(self.read_options)
        if options.get("startingOffsets") == "latest":
            options["startingOffsets"] = "earliest"
        return options


def kafka_topic(
    servers: str,
    name: str,
    *,
    security_protocol: str = "PLAINTEXT",
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    read_options: dict[str, str] | None = None,
    write_options: dict[str, str] | None = None,
) -> Topic:
    """A Kafka topic.

    ``earliest`` is the default start, so that records published before the first
    run are read. Records that expired unread stop the job, unless ``fail_on_data_loss`` is
    off, which skips them. Useful ``read_options`` at scale: ``maxOffsetsPerTrigger`` to bound
    a micro-batch, ``minPartitions`` to split large topic partitions into more tasks.
    """
    connection = {
        "kafka.bootstrap.servers": servers,
        "kafka.security.protocol": security_protocol,
    }
    return Topic(
        "kafka",
        read_options={
            **connection,
            "subscribe": name,
            "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower(),
            **(read_options or {}),
        },
        write_options={
            **connection,
            "topic": name,
            # Fixed values.
            "kafka.retries": "5",
            "kafka.request.timeout.ms": "60000",
            **(write_options or {}),
        },
    )


def file_topic(path: str, **read_options: str) -> Topic:
    """A folder of Parquet files with topic columns.

    Columns that a publisher left out are NULL. It should write an ``offset``, which
    tells copies of a record apart (see ``operators.enrich`` on salts).
    """
    return Topic("parquet", read_options=read_options, path=path, schema=TOPIC_RECORD)


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """All records that the topic holds now."""
    reader = spark.read.format(topic.format).options(**topic.table_options())
    if topic.schema is not None:
        reader = reader.schema(topic.schema)
    return reader.load(topic.path)


def stream_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """The records of the topic as an unbounded table."""
    reader = spark.readStream.format(topic.format).options(**topic.read_options)
    if topic.schema is not None:
        reader = reader.schema(topic.schema)
    return reader.load(topic.path)
