"""Cleaning and enriching single trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv
from tapeworks.functions import amounts, labels, moments


def with_calendar(
    df: DataFrame, moment: str, parts: tuple[str, ...] = fv.SILVER_PARTITIONS
) -> DataFrame:
    """Add the calendar columns that partition the files."""
    return df.withColumns(moments.calendar_parts(F.col(moment), parts))


def valid_trades(records: DataFrame, ceiling: float = fv.PRICE_CEILING) -> DataFrame:
    """Trades with a symbol, a time, and a plausible price and quantity.

    Plain comparisons on stored columns, so all of them reach the parquet scan.
    A comparison with NULL is not true, which covers the null checks.
    """
    return records.filter(
        (F.col("price") > 0)
        & (F.col("price") < ceiling)
        & (F.col("quantity") > 0)
        & F.col("symbol").isNotNull()
        & moments.plausible_ms(F.col("trade_time"))
    )


def standardized_trades(records: DataFrame, places: int = fv.AMOUNT_PLACES) -> DataFrame:
    """Typed timestamps and rounded amounts; unrelated extra columns pass through."""
    stale = {"trade_time", "ingested_at", "timestamp", *fv.BRONZE_PARTITIONS}
    rewritten = {"price", "quantity"}
    passed = [c for c in records.columns if c not in stale | rewritten]
    return records.select(
        *passed,
        *[F.round(c, places).alias(c) for c in sorted(rewritten)],
        moments.from_epoch_ms(F.col("trade_time")).alias("trade_timestamp"),
        moments.from_iso(F.col("ingested_at")).alias("ingest_timestamp"),
    )


def enriched_trades(
    trades: DataFrame,
    large_from: float = fv.LARGE_TRADE_VALUE,
    places: int = fv.AMOUNT_PLACES,
    now: Column | None = None,
) -> DataFrame:
    """Value, side, order of magnitude and size flag of each trade."""
    value = F.round(F.col("price") * F.col("quantity"), places)
    return trades.withColumns(
        {
            "trade_value": value,
            "trade_side": labels.trade_side(F.col("is_buyer_maker")),
            "price_magnitude": amounts.magnitude(F.col("price"), fv.MAGNITUDE_PLACES),
            "is_large_trade": F.coalesce(value > large_from, F.lit(False)),
            "processed_at": moments.as_moment(now),
        }
    )
