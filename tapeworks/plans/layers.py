"""The three trade layers: raw records, clean trades, candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tapeworks import fixed_values as fv
from tapeworks.functions.moments import from_epoch_ms
from tapeworks.operators.candles import to_candles
from tapeworks.operators.dedup import distinct_trades, distinct_trades_stream
from tapeworks.operators.messages import decode_trades
from tapeworks.operators.trades import (
    enriched_trades,
    standardized_trades,
    valid_trades,
    with_calendar,
)


def bronze(messages: DataFrame) -> DataFrame:
    """Decoded records with their event time and calendar columns.

    Undecodable messages stay, as rows of NULLs in the default partition.
    """
    records = decode_trades(messages)
    timed = records.withColumn("timestamp", from_epoch_ms(records["trade_time"]))
    return with_calendar(timed, "timestamp", fv.BRONZE_PARTITIONS)


def silver(
    records: DataFrame,
    keys: tuple[str, ...] = fv.DEDUP_KEYS,
    lateness: str = fv.LATENESS,
    collapse: bool = False,
    now: Column | None = None,
) -> DataFrame:
    """Valid, typed, distinct and enriched trades with their day.

    Copies are removed before enrichment: the derived columns follow from the others,
    so they need not travel through the shuffle.
    """
    trades = standardized_trades(valid_trades(records))
    if trades.isStreaming:
        trades = distinct_trades_stream(trades, keys, lateness=lateness, collapse=collapse)
    else:
        trades = distinct_trades(trades, keys)
    return with_calendar(enriched_trades(trades, now=now), "trade_timestamp")


def gold(trades: DataFrame, **options) -> DataFrame:
    """One-minute candles of silver trades; options as for ``to_candles``."""
    return to_candles(trades, **options)
