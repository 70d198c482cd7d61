"""Price, change, volumes and buy ratio of every symbol over the last day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv
from tapeworks.functions.amounts import percent_change, percent_of
from tapeworks.functions.moments import as_moment, horizon_start
from tapeworks.schemas import CANDLE_DAY


def recent(candles: DataFrame, as_of=None, horizon: str = fv.HORIZON) -> DataFrame:
    """Candles from ``horizon`` before ``as_of`` on, bound included.

    A stored candle table has a day partition; the same bound on it skips older folders.
    """
    bound = horizon_start(as_moment(as_of), horizon)
    kept = candles.filter(F.col("candle_start_time") >= bound)
    if CANDLE_DAY in candles.columns:
        kept = kept.filter(F.col(CANDLE_DAY) >= F.to_date(bound))
    return kept


def latest_candles(candles: DataFrame) -> DataFrame:
    """The close of the newest candle of each symbol."""
    start = F.col("candle_start_time")
    return candles.groupBy("symbol").agg(
        F.max_by("close_price", start).alias("current_price"),
        F.max(start).alias("last_updated"),
    )


def first_candles(candles: DataFrame, as_of=None, horizon: str = fv.HORIZON) -> DataFrame:
    """The open of the oldest candle of each symbol inside the horizon."""
    start = F.col("candle_start_time")
    return (
        recent(candles, as_of, horizon)
        .groupBy("symbol")
        .agg(
            F.min_by("open_price", start).alias("open_price_24h"),
            F.min(start).alias("first_candle_time"),
        )
    )


def _stats() -> list:
    # The names of the totals.
    return [
        F.max("high_price").alias("high_24h"),
        F.min("low_price").alias("low_24h"),
        F.sum("total_volume").alias("volume_24h"),
        F.sum("buy_volume_taker").alias("buy_volume_24h"),
        F.sum("sell_volume_maker").alias("sell_volume_24h"),
        F.sum("trade_count").alias("total_trades_24h"),
    ]


def horizon_stats(candles: DataFrame, as_of=None, horizon: str = fv.HORIZON) -> DataFrame:
    """Extremes and totals of each symbol inside the horizon."""
    return recent(candles, as_of, horizon).groupBy("symbol").agg(*_stats())


def market_overview(candles: DataFrame, as_of=None, horizon: str = fv.HORIZON) -> DataFrame:
    """One row per symbol with a candle inside the horizon.

    A single aggregate over the horizon suffices. The newest candle of a symbol that
    was active in the horizon lies in it, since the horizon has no upper bound, so the
    time filter holds for every input and reaches the scan: history is not read.
    """
    start = F.col("candle_start_time")
    opened, current = F.col("open_price_24h"), F.col("current_price")
    return (
        recent(candles, as_of, horizon)
        .groupBy("symbol")
        .agg(
            F.max_by("close_price", start).alias("current_price"),
            F.min_by("open_price", start).alias("open_price_24h"),
            *_stats(),
            F.max(start).alias("last_updated"),
        )
        .select(
            "symbol",
            current,
            opened,
            "high_24h",
            "low_24h",
            percent_change(opened, current, 2).alias("price_change_pct_24h"),
            (current - opened).alias("price_change_24h"),
            "volume_24h",
            "buy_volume_24h",
            "sell_volume_24h",
            percent_of(F.col("buy_volume_24h"), F.col("volume_24h"), 2).alias("buy_ratio_pct"),
            "total_trades_24h",
            "last_updated",
        )
    )
