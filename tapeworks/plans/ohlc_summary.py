"""Each candle with its own measures and those of its hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.amounts import percent_of
from tapeworks.functions.moments import start_of
from tapeworks.operators.candles import described_candles, merged_candles
from tapeworks.schemas import CANDLE_DAY

_HOURLY = {
    "open_price": "hourly_open",
    "high_price": "hourly_high",
    "low_price": "hourly_low",
    "close_price": "hourly_close",
    "total_volume": "hourly_volume",
    "buy_volume_taker": "hourly_buy_vol",
    "sell_volume_maker": "hourly_sell_vol",
    "trade_count": "hourly_trades",
}


def hourly_candles(candles: DataFrame) -> DataFrame:
    """One row per symbol and hour."""
    hour = start_of("hour", F.col("candle_start_time")).alias("candle_hour")
    return merged_candles(candles, "symbol", hour).withColumnsRenamed(_HOURLY)


def ohlc_summary(candles: DataFrame) -> DataFrame:
    """One row per candle, 25 columns.

    The hourly measures are windows over the candle's own (symbol, hour), at most 60
    rows, so no hourly table is joined back: one shuffle, one sort, no join.
    """
    whole_hour = (
        Window.partitionBy("symbol", "candle_hour")
        .orderBy("candle_start_time")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    folds = {
        "open_price": F.first,
        "high_price": F.max,
        "low_price": F.min,
        "close_price": F.last,
    }
    hourly = {
        name: folds.get(of, F.sum)(of).over(whole_hour) for of, name in _HOURLY.items()
    }
    return (
        described_candles(candles.drop("ingested_at", CANDLE_DAY))
        .withColumns(hourly)
        .withColumn(
            "hourly_buy_pct", percent_of(F.col("hourly_buy_vol"), F.col("hourly_volume"), 2)
        )
    )
