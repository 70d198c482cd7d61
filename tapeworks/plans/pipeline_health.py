"""Freshness and completeness of the candle table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv
from tapeworks.functions.labels import freshness_status
from tapeworks.functions.moments import as_moment, minutes_between, start_of

_START = "candle_start_time"


def hourly_ingestion(candles: DataFrame) -> DataFrame:
    """Counts, totals and completeness of every hour and symbol that has a candle."""
    expected = fv.CANDLES_PER_HOUR
    return (
        candles.groupBy(start_of("hour", F.col(_START)).alias("ingestion_hour"), "symbol")
        .agg(
            F.count(F.lit(1)).alias("candles_count"),
            F.sum("trade_count").alias("total_trades"),
            F.sum("total_volume").alias("total_volume"),
            F.max("ingested_at").alias("last_ingested_at"),
            F.min(_START).alias("earliest_candle"),
            F.max(_START).alias("latest_candle"),
        )
        .withColumns(
            {
                "completeness_pct": F.round(F.col("candles_count") / float(expected) * 100, 1),
                "missing_candles": expected - F.col("candles_count"),
            }
        )
    )


def _age(latest: Column, as_of) -> Column:
    return minutes_between(latest, as_moment(as_of))


def freshness(candles: DataFrame, as_of=None) -> DataFrame:
    """Newest candle and its age in minutes, per symbol."""
    return (
        candles.groupBy("symbol")
        .agg(
            F.max(_START).alias("latest_candle_time"),
            F.max("ingested_at").alias("latest_ingestion_time"),
        )
        .withColumn("minutes_since_last_candle", _age(F.col("latest_candle_time"), as_of))
        .withColumn("freshness_status", freshness_status(F.col("minutes_since_last_candle")))
    )


def _day_completeness(candles: Column, symbols: Column) -> Column:
    possible = F.nullif(symbols * float(fv.HOURS_PER_DAY * fv.CANDLES_PER_HOUR), F.lit(0.0))
    return F.round(candles / possible * 100, 1)


def daily_summary(candles: DataFrame) -> DataFrame:
    """Totals, active symbols and completeness per day.

    Folded per (day, symbol) first. That makes the distinct count a plain count and
    leaves few rows for the second step, whatever the number of candles in a day.
    """
    per_symbol = candles.groupBy(
        start_of("day", F.col(_START)).alias("date"), "symbol"
    ).agg(
        F.count(F.lit(1)).alias("candles"),
        F.count("trade_count").alias("counted"),
        F.sum("trade_count").alias("trades"),
        F.sum("total_volume").alias("volume"),
    )
    return (
        per_symbol.groupBy("date")
        .agg(
            F.sum("candles").alias("total_candles"),
            F.count("symbol").alias("active_symbols"),
            F.sum("trades").alias("total_trades"),
            F.sum("volume").alias("total_volume"),
            (F.sum("trades") / F.nullif(F.sum("counted"), F.lit(0))).alias("avg_trades_per_candle"),
        )
        .withColumn(
            "daily_completeness_pct",
            _day_completeness(F.col("total_candles"), F.col("active_symbols")),
        )
    )


def pipeline_health(candles: DataFrame, as_of=None, ordered: bool = True) -> DataFrame:
    """One row per hour and symbol with the symbol's freshness and the day's totals.

    A symbol's newest candle is a window over its hours, which the calendar limits. The
    day's totals are counts per day and symbol, combined on the map side and joined back:
    no task holds all symbols of a day. They take a second scan, of two columns.
    """
    start = F.col(_START)
    per_symbol = candles.groupBy(start_of("day", start).alias("_day"), "symbol").agg(
        F.count(F.lit(1)).alias("candles")
    )
    return _health(hourly_ingestion(candles), per_symbol, as_of, ordered)


def health_of_hours(hours: DataFrame, as_of=None, ordered: bool = True) -> DataFrame:
    """``pipeline_health`` from its hours, as ``hourly_ingestion`` makes them."""
    per_symbol = hours.groupBy(start_of("day", F.col("ingestion_hour")).alias("_day"), "symbol").agg(
        F.sum("candles_count").alias("candles")
    )
    return _health(hours, per_symbol, as_of, ordered)


def _health(hours: DataFrame, per_symbol: DataFrame, as_of, ordered: bool) -> DataFrame:
    hours = hours.withColumn("_day", start_of("day", F.col("ingestion_hour")))
    days = per_symbol.groupBy("_day").agg(
        F.sum("candles").alias("day_total_candles"),
        F.count("symbol").alias("day_active_symbols"),
    )
    known = F.col("symbol").isNotNull()
    newest = F.max("latest_candle").over(Window.partitionBy("symbol"))
    rows = hours.withColumn("latest_candle_time", F.when(known, newest)).join(days, "_day")
    age = _age(F.col("latest_candle_time"), as_of)
    result = rows.select(
        "ingestion_hour",
        "symbol",
        "candles_count",
        "total_trades",
        "total_volume",
        "last_ingested_at",
        "earliest_candle",
        "latest_candle",
        "completeness_pct",
        "missing_candles",
        "latest_candle_time",
        age.alias("minutes_since_last_candle"),
        F.when(known, freshness_status(age)).alias("freshness_status"),
        "day_total_candles",
        "day_active_symbols",
        _day_completeness(F.col("day_total_candles"), F.col("day_active_symbols")).alias(
            "daily_completeness_pct"
        ),
    )
    if not ordered:
        return result
    return result.orderBy(F.desc("ingestion_hour"), F.asc_nulls_last("symbol"))
