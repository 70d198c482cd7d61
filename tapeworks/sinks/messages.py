"""Keyed messages to a Kafka topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tapeworks.operators.messages import to_messages


def publish(records: DataFrame, servers: str, topic: str, key: str = "symbol", **extra: str) -> None:
    """Send a batch of records as keyed JSON messages."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, **extra}
    to_messages(records, key).write.format("kafka").options(**options).save()


def publish_stream(
    records: DataFrame, servers: str, topic: str, checkpoint: str, key: str = "symbol", **extra: str
) -> StreamingQuery:
    """The same for a stream, until what is available has been sent."""
    options = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "checkpointLocation": checkpoint,
        **extra,
    }
    return (
        to_messages(records, key)
        .writeStream.format("kafka")
        .options(**options)
        .trigger(availableNow=True)
        .start()
    )
