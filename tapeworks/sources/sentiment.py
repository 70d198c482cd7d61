"""Landed replies of the sentiment index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.functions.moments import from_epoch_seconds


def index_replies(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """One row per landed reply with the time it landed: a file each, or a line each."""
    return (
        spark.read.schema(schemas.INDEX_REPLY)
        .json(path, multiLine=not one_per_line)
        .select("data", F.col("_metadata.file_modification_time").alias("landed_at"))
    )


def newest_readings(replies: DataFrame) -> DataFrame:
    """The first element of each reply as a typed row.

    A reply without elements, or with a value or time that is no integer, is dropped.
    """
    head = F.get("data", F.lit(0))
    return (
        replies.select(head.alias("head"), "landed_at")
        .select(
            F.to_date(from_epoch_seconds(F.col("head.timestamp").try_cast("bigint"))).alias("date"),
            F.col("head.value").try_cast("int").alias("fng_value"),
            F.col("head.value_classification").alias("fng_classification"),
            "landed_at",
        )
        .filter("date is not null and fng_value is not null")
    )
