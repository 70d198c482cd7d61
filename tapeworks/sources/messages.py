"""Trade messages from a Kafka topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(servers: str, topic: str, starting: str = "latest", **extra: str) -> dict:
    """Options of one subscribed topic: begin at the head, survive expired offsets.

    Further options go into ``extra``: ``maxOffsetsPerTrigger`` bounds a micro-batch, and
    ``minPartitions`` has several tasks read one large topic partition.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        **extra,
    }


def message_stream(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """Unbounded ``key``, ``value`` rows. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **extra)).load()


def message_batch(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """What the topic holds now; a batch has to begin at ``earliest``."""
    options = topic_options(servers, topic, **{"starting": "earliest", **extra})
    return spark.read.format("kafka").options(**options).load()


def text_messages(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Landed wire messages, one per line, in the ``value`` column."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path)
