"""Rebuild every mart from the candle table, and the checks that follow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tapeworks.operators.checks import key_checks
from tapeworks.plans.market_overview import market_overview
from tapeworks.plans.ohlc_summary import ohlc_summary
from tapeworks.plans.pipeline_health import pipeline_health
from tapeworks.plans.price_vs_sentiment import price_vs_sentiment
from tapeworks.sinks.checked import rebuild_checked
from tapeworks.sinks.files import rebuild

# The column that may not be empty, and whether its values may repeat.
MART_KEYS = {
    "market_overview": ("symbol", True),
    "ohlc_summary": ("candle_start_time", False),
    "pipeline_health": ("ingestion_hour", False),
    "price_vs_sentiment": ("date", True),
}


def marts(candles: DataFrame, sentiment: DataFrame, as_of=None, **pair) -> dict[str, DataFrame]:
    """All marts by name, unordered: a stored table has no row order. ``pair`` names
    the symbol that is set against the index."""
    return {
        "market_overview": market_overview(candles, as_of),
        "ohlc_summary": ohlc_summary(candles),
        "pipeline_health": pipeline_health(candles, as_of, ordered=False),
        "price_vs_sentiment": price_vs_sentiment(candles, sentiment, ordered=False, **pair),
    }


def build_marts(
    spark: SparkSession, candles: DataFrame, sentiment: DataFrame, root: str, as_of=None, **pair
) -> dict[str, str]:
    """Write each mart below ``root``, replacing the previous one; returns the paths.

    Pass a stored candle table: every mart reads the columns it needs on its own.
    """
    paths = {}
    for name, mart in marts(candles, sentiment, as_of, **pair).items():
        paths[name] = f"{root}/{name}"
        rebuild(mart, paths[name])
    return paths


def candle_checks(candles: DataFrame) -> DataFrame:
    """Verdicts on the candle table: complete keys, and no candle twice."""
    return key_checks(
        candles,
        {"symbol": "symbol not null", "candle_start_time": "candle_start_time not null"},
        {"candle unique": ["symbol", "candle_start_time"]},
    )


def mart_checks(built: dict[str, DataFrame]) -> DataFrame:
    """Verdicts on the marts' key columns, one row per check and one scan per mart."""
    found = [key_checks(mart, *_mart_checks(name)) for name, mart in built.items()]
    return reduce(DataFrame.unionAll, found)


def write_checked_marts(built: dict[str, DataFrame], root: str) -> DataFrame:
    """Write each mart below ``root`` and return the same verdicts as ``mart_checks``,
    found by the writes: no mart is read again unless a key may repeat."""
    found = [rebuild_checked(m, f"{root}/{name}", *_mart_checks(name)) for name, m in built.items()]
    return reduce(DataFrame.unionAll, found)


def _mart_checks(name: str) -> tuple[dict[str, str], dict[str, list[str]]]:
    column, unique = MART_KEYS[name]
    once = {f"{name}.{column} unique": [column]} if unique else {}
    return {column: f"{name}.{column} not null"}, once
