"""Batch loads: trade history and sentiment readings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv
from tapeworks import schemas
from tapeworks.operators.upsert import upsert
from tapeworks.sinks import merging, snapshots
from tapeworks.sinks.files import rebuild, reload_slices
from tapeworks.sources.files import silver_days
from tapeworks.storage import discard, exists


def trade_history(
    spark: SparkSession, silver_path: str, first: dt.date, last: dt.date | None = None
) -> DataFrame:
    """The columns kept in the trade history, for the given days of silver."""
    return silver_days(spark, silver_path, first, last).select(*fv.LOAD_COLUMNS)


def load_trade_history(
    spark: SparkSession,
    silver_path: str,
    history_path: str,
    first: dt.date,
    last: dt.date | None = None,
) -> None:
    """Copy days of silver into the history; loading a day again replaces it.

    A day that has no trades any more is removed.
    """
    rows = trade_history(spark, silver_path, first, last).withColumn(
        "trade_day", F.to_date("trade_timestamp")
    )
    reload_slices(rows, history_path, ["trade_day"])
    filled = {row[0] for row in rows.select("trade_day").distinct().collect()}
    for k in range((last or first).toordinal() - first.toordinal() + 1):
        day = first + dt.timedelta(days=k)
        if day not in filled:
            discard(spark, f"{history_path}/trade_day={day}")


def load_sentiment(
    spark: SparkSession, readings: DataFrame, path: str, staging: str, now: Column | None = None
) -> None:
    """Upsert readings, newest landing first, into the table at ``path``.

    The result is staged whole before it replaces the table that it was read from. A
    staged result left by an interrupted run is published before anything else.
    """
    ready = f"{staging}/_SUCCESS"
    if exists(spark, ready):
        rebuild(spark.read.schema(schemas.SENTIMENT).parquet(staging), path)
    if exists(spark, path):
        stored = spark.read.schema(schemas.SENTIMENT).parquet(path)
    else:
        stored = spark.createDataFrame([], schemas.SENTIMENT)
    merged = upsert(stored, readings, ["date"], [F.desc("landed_at")], now=now)
    rebuild(merged, staging)
    rebuild(spark.read.schema(schemas.SENTIMENT).parquet(staging), path)
    discard(spark, staging)


def merge_sentiment(
    spark: SparkSession, readings: DataFrame, path: str, run: str, now: Column | None = None
) -> DataFrame:
    """The same upsert into a table that is merged when read; returns its rows.

    A load writes as much as it brings (``sinks.merging``), and one that was interrupted
    or is repeated under its name ``run`` stands once.
    """
    if snapshots.current(spark, path) is None:
        merging.create(spark.createDataFrame([], schemas.SENTIMENT), path, ["date"])
    return merging.read(spark, merging.put(readings, path, [F.desc("landed_at")], run, now))
