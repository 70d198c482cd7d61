"""Marts kept up by change: only the days that changed are folded again.

The candle table is a snapshot table (``sinks.snapshots``) sliced by day. From it three
narrow tables are kept, sliced by the same days: counts and ends per hour and symbol, sums per
day and symbol, and the candle summary. Each remembers the version of the candle table it
was made from. A refresh compares that version with the newest one, reads the candles of the
days that differ and replaces these slices. Every table is published by one switch and
compares for itself, so a refresh that was interrupted is completed by the next one.

The marts are then derived from the kept tables: an hour of candles is one row there, so
what depends on the clock or on a symbol's newest candle costs no scan of candles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv
from tapeworks.functions.labels import display_symbol, same_symbol
from tapeworks.plans.market_overview import market_overview
from tapeworks.plans.ohlc_summary import ohlc_summary
from tapeworks.plans.pipeline_health import health_of_hours, hourly_ingestion
from tapeworks.schemas import CANDLE_DAY
from tapeworks.sinks import snapshots

_SOURCE = "candles"
_START = "candle_start_time"


def put_candles(candles: DataFrame, path: str) -> snapshots.Snapshot:
    """Candles in the place of the stored ones with the same symbol and start.

    Only the days that ``candles`` touches are read and published again. ``candles`` holds
    each key once.
    """
    spark = candles.sparkSession
    batch = candles.withColumn(CANDLE_DAY, F.to_date(_START))
    base = snapshots.current(spark, path)
    days = [r[0] for r in batch.select(F.col(CANDLE_DAY).cast("string")).distinct().collect()]
    if base:
        keys = batch.select(
            F.col("symbol").alias("_symbol"), F.col(_START).alias("_start")
        )
        stored = snapshots.read(spark, base, days)
        same = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col(_START) == F.col("_start"))
        batch = stored.join(keys, same, "left_anti").unionByName(batch)
    return snapshots.replace_slices(batch, path, CANDLE_DAY, days)


def _hours(candles: DataFrame) -> DataFrame:
    return hourly_ingestion(candles).withColumn(CANDLE_DAY, F.to_date("ingestion_hour"))


def _days(candles: DataFrame) -> DataFrame:
    """Sums that add up, per day and symbol."""
    return candles.groupBy(F.to_date(_START).alias(CANDLE_DAY), "symbol").agg(
        F.sum("close_price").alias("close_sum"),
        F.count("close_price").alias("close_count"),
        F.max("high_price").alias("max_price"),
        F.min("low_price").alias("min_price"),
        F.sum("total_volume").alias("total_volume"),
    )


def _summary(candles: DataFrame) -> DataFrame:
    return ohlc_summary(candles).withColumn(CANDLE_DAY, F.to_date(_START))


KEPT: dict[str, Callable[[DataFrame], DataFrame]] = {
    "hours": _hours,
    "days": _days,
    "summary": _summary,
}


def refresh(spark: SparkSession, candle_path: str, root: str) -> dict[str, set[str | None]]:
    """Bring the kept tables below ``root`` up to the newest candles.

    Returns the days that were folded again, for each table.
    """
    newest = snapshots.current(spark, candle_path)
    done: dict[str, set[str | None]] = {}
    for name, fold in KEPT.items():
        path = f"{root}/{name}"
        kept = snapshots.current(spark, path)
        seen = int(kept.notes[_SOURCE]) if kept else 0
        if seen == newest.version:
            done[name] = set()
            continue
        # Without the version it was made from, all days count as changed.
        known = seen and seen in snapshots.versions(spark, candle_path)
        before = snapshots.load(spark, candle_path, seen) if known else None
        days = snapshots.touched(before, newest)
        if kept and not known:
            days |= kept.slices
        made = fold(snapshots.read(spark, newest, days))
        snapshots.replace_slices(made, path, CANDLE_DAY, days, **{_SOURCE: str(newest.version)})
        done[name] = days
    return done


def marts(
    spark: SparkSession,
    candle_path: str,
    root: str,
    sentiment: DataFrame,
    as_of=None,
    symbol: str | None = fv.SENTIMENT_SYMBOL,
    quote: str = fv.QUOTE_SUFFIX,
    exact_case: bool = False,
) -> dict[str, DataFrame]:
    """All marts from the kept tables, unordered; the overview reads recent days only."""
    kept = {name: _kept(spark, f"{root}/{name}") for name in KEPT}
    newest = snapshots.current(spark, candle_path)
    return {
        "market_overview": market_overview(_recent_days(spark, newest, as_of), as_of),
        "ohlc_summary": kept["summary"].drop(CANDLE_DAY),
        "pipeline_health": health_of_hours(kept["hours"].drop(CANDLE_DAY), as_of, ordered=False),
        "price_vs_sentiment": _prices(kept["days"], sentiment, symbol, quote, exact_case),
    }


def _kept(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.read(spark, snapshots.current(spark, path))


def _recent_days(spark: SparkSession, newest: snapshots.Snapshot, as_of) -> DataFrame:
    if as_of is None:
        return snapshots.read(spark, newest)
    # The horizon is a day, so it begins the day before.
    first = str(as_of.date().fromordinal(as_of.date().toordinal() - 1))
    return snapshots.read(spark, newest, {day for day in newest.slices if day and day >= first})


def _prices(days: DataFrame, sentiment: DataFrame, symbol, quote, exact_case) -> DataFrame:
    if symbol is not None:
        days = days.filter(same_symbol(F.col("symbol"), symbol, exact_case))
    prices = days.groupBy(
        F.col(CANDLE_DAY).alias("date"), display_symbol(F.col("symbol"), quote).alias("symbol")
    ).agg(
        (F.sum("close_sum") / F.nullif(F.sum("close_count"), F.lit(0))).alias("avg_price"),
        F.max("max_price").alias("max_price"),
        F.min("min_price").alias("min_price"),
        F.sum("total_volume").alias("total_volume"),
    )
    readings = sentiment.select("date", "fng_value", "fng_classification")
    return prices.join(readings, "date", "left").select(*prices.columns, *readings.columns[1:])
