"""Trades to interval candles, and candles to longer candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv
from tapeworks.functions.amounts import percent_of, trade_order, trade_turn
from tapeworks.functions.labels import candle_type
from tapeworks.functions.moments import as_moment, start_of

PRICES = ("open_price", "high_price", "low_price", "close_price")
VOLUMES = ("total_volume", "buy_volume_taker", "sell_volume_maker")


def to_candles(
    trades: DataFrame,
    width: str = fv.CANDLE_WIDTH,
    moment: str = "trade_timestamp",
    trade_id: str | None = None,
    lateness: str = fv.LATENESS,
    now: Column | None = None,
) -> DataFrame:
    """One candle per symbol and interval ``[start, start + width)``.

    Open and close are the prices of the earliest and latest trade by event time, not
    by arrival; an integral ``trade_id`` settles trades of the same instant, and without
    one their content does (``trade_turn``). A trade
    with an unknown maker flag counts in the total volume but on neither side.

    Works on streams (append: a candle appears once the watermark passed its end) and
    on batches. Every buffer is of fixed width, so trades are folded into candles in a
    hash map before the shuffle and even a dominant symbol sends at most one partial
    candle per interval and input task.
    """
    slot = F.window(moment, width)
    if trades.isStreaming:
        trades = trades.withWatermark(moment, lateness)
    # A column of its own, so that it is computed once for both ends of the candle.
    turn = F.col(trade_id) if trade_id else trade_turn(F.col("price"), F.col("quantity"))
    order = trade_order(F.col(moment), turn)
    trades = trades.withColumn("_order", F.when(F.col("price").isNotNull(), order))
    by_taker = F.when(~F.col("is_buyer_maker"), F.col("quantity")).otherwise(0.0)
    by_maker = F.when(F.col("is_buyer_maker"), F.col("quantity")).otherwise(0.0)
    return (
        trades.groupBy(slot.alias("slot"), "symbol")
        .agg(
            F.min_by("price", "_order").alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", "_order").alias("close_price"),
            F.sum("quantity").alias("total_volume"),
            F.sum(by_taker).alias("buy_volume_taker"),
            F.sum(by_maker).alias("sell_volume_maker"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        .withColumn("candle_start_time", F.col("slot.start"))
        .drop("slot")
        .select("candle_start_time", "symbol", *PRICES, *VOLUMES, "trade_count")
        .withColumn("ingested_at", as_moment(now))
    )


def merged_candles(candles: DataFrame, *keys: str | Column) -> DataFrame:
    """Candles folded into one per ``keys``; equals folding the trades themselves."""
    start = F.col("candle_start_time")
    return candles.groupBy(*keys).agg(
        F.min_by("open_price", start).alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", start).alias("close_price"),
        *[F.sum(v).alias(v) for v in VOLUMES],
        F.sum("trade_count").alias("trade_count"),
    )


def described_candles(candles: DataFrame) -> DataFrame:
    """Direction, body, buy pressure and calendar position of each candle."""
    opened, closed = F.col("open_price"), F.col("close_price")
    start = F.col("candle_start_time")
    return candles.withColumns(
        {
            "candle_type": candle_type(opened, closed),
            "body_size_pct": percent_of(F.abs(closed - opened), opened, 4),
            "buy_pressure_pct": percent_of(F.col("buy_volume_taker"), F.col("total_volume"), 2),
            "hour_of_day": F.hour(start),
            "candle_hour": start_of("hour", start),
            "candle_date": start_of("day", start),
        }
    )
