"""All layers from a backlog in batch, before streams take over.

A stream drops what lies behind its watermark, so a backlog that is out of order has to
be read in one micro-batch. A batch has no such limit: rows are shuffled once per layer,
copies and trades are folded before each shuffle, and every candle is final.

Bronze and silver are written as the backlog's part of each partition, beside those of
streams; ``streaming.drains.run_layers`` goes on below the same root.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv
from tapeworks import schemas
from tapeworks.plans.layers import bronze, gold, silver
from tapeworks.sinks.files import reload_slices, write_run
from tapeworks.sources.files import parquet_tree

_DAY = list(fv.SILVER_PARTITIONS)


def backfill(
    spark: SparkSession,
    messages: DataFrame,
    root: str,
    days_at_once: int | None = None,
    gather: bool = True,
    **candle_options,
) -> dict[str, str]:
    """Messages to bronze, silver and candle files below ``root``; returns their paths.

    Each layer is stored before the next one reads it. Running it again replaces the
    backlog's part of the partitions it has rows for. With ``days_at_once`` silver and
    candles are made for so many days at a time, in order: copies and candles never
    reach over a day, so the result is the same. ``gather`` shuffles the raw records once
    to write few files per hour.
    """
    path = {layer: f"{root}/{layer}" for layer in ("bronze", "silver", "candles")}
    write_run(bronze(messages), path["bronze"], fv.BRONZE_PARTITIONS, gather=gather)
    records = parquet_tree(spark, path["bronze"], schemas.BRONZE)
    for some in _day_filters(records, days_at_once):
        write_run(silver(records.filter(some)), path["silver"], fv.SILVER_PARTITIONS, gather=True)
        trades = parquet_tree(spark, path["silver"], schemas.SILVER).filter(some)
        candles = gold(trades, **candle_options)
        days = candles.withColumn(schemas.CANDLE_DAY, F.to_date("candle_start_time"))
        reload_slices(days, path["candles"], [schemas.CANDLE_DAY])
    return path


def _day_filters(records: DataFrame, days_at_once: int | None) -> list[Column]:
    """Filters on partition columns, of some days each; all at once without a number."""
    if not days_at_once:
        return [F.lit(True)]
    # One row per calendar day, from the names of the partitions.
    days = sorted(tuple(r) for r in records.select(*_DAY).distinct().collect() if r[0] is not None)
    return [
        reduce(or_, [reduce(_both, (F.col(c) == v for c, v in zip(_DAY, day, strict=True))) for day in days[k : k + days_at_once]])
        for k in range(0, len(days), days_at_once)
    ]


def _both(a: Column, b: Column) -> Column:
    return a & b
