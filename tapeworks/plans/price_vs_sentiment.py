"""Daily price of one symbol next to the sentiment index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv
from tapeworks.functions.labels import display_symbol, same_symbol


def daily_price(
    candles: DataFrame,
    symbol: str | None = fv.SENTIMENT_SYMBOL,
    quote: str = fv.QUOTE_SUFFIX,
    exact_case: bool = False,
) -> DataFrame:
    """Average, extremes and volume per day; of all symbols when ``symbol`` is None."""
    if symbol is not None:
        candles = candles.filter(same_symbol(F.col("symbol"), symbol, exact_case))
    return candles.groupBy(
        F.to_date("candle_start_time").alias("date"),
        display_symbol(F.col("symbol"), quote).alias("symbol"),
    ).agg(
        F.avg("close_price").alias("avg_price"),
        F.max("high_price").alias("max_price"),
        F.min("low_price").alias("min_price"),
        F.sum("total_volume").alias("total_volume"),
    )


def price_vs_sentiment(
    candles: DataFrame,
    sentiment: DataFrame,
    symbol: str | None = fv.SENTIMENT_SYMBOL,
    quote: str = fv.QUOTE_SUFFIX,
    exact_case: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Every traded day, with the index where there is a reading.

    No broadcast is forced: after the aggregate both sides hold about one row per day,
    and the adaptive planner broadcasts the reading side by its measured size.
    """
    prices = daily_price(candles, symbol, quote, exact_case)
    readings = sentiment.select("date", "fng_value", "fng_classification")
    joined = prices.join(readings, "date", "left").select(*prices.columns, *readings.columns[1:])
    return joined.orderBy(F.desc("date")) if ordered else joined
