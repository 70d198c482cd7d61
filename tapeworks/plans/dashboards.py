"""Read-outs that charts need, straight from the candle table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.amounts import percent_of
from tapeworks.functions.labels import candle_type


def candle_mix(candles: DataFrame) -> DataFrame:
    """Number of rising and falling candles per symbol."""
    direction = candle_type(F.col("open_price"), F.col("close_price")).alias("candle_type")
    return candles.groupBy("symbol", direction).agg(F.count(F.lit(1)).alias("candles"))


def buy_pressure_heatmap(candles: DataFrame) -> DataFrame:
    """Share of taker buys by symbol and hour of the day, as a ratio of sums."""
    return (
        candles.groupBy("symbol", F.hour("candle_start_time").alias("hour_of_day"))
        .agg(
            F.sum("buy_volume_taker").alias("buy_volume"),
            F.sum("total_volume").alias("volume"),
        )
        .withColumn("buy_pressure_pct", percent_of(F.col("buy_volume"), F.col("volume"), 2))
    )
