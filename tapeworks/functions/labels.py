"""Text labels derived from trades, candles and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv


def trade_side(is_buyer_maker: Column) -> Column:
    """BUY when the taker bought. An unknown flag counts as SELL."""
    return F.when(~is_buyer_maker, fv.SIDE_BUY).otherwise(fv.SIDE_SELL)


def candle_type(open_price: Column, close_price: Column) -> Column:
    """Bullish unless the candle fell; unknown prices count as Bearish."""
    return F.when(close_price >= open_price, fv.CANDLE_UP).otherwise(fv.CANDLE_DOWN)


def freshness_status(
    minutes: Column,
    fresh: float = fv.FRESH_MINUTES,
    stale: float = fv.STALE_MINUTES,
) -> Column:
    """Both bounds are inclusive; an unknown age is dead."""
    return (
        F.when(minutes <= fresh, fv.STATUS_FRESH)
        .when(minutes <= stale, fv.STATUS_STALE)
        .otherwise(fv.STATUS_DEAD)
    )


def display_symbol(symbol: Column, quote: str = fv.QUOTE_SUFFIX) -> Column:
    """Upper-case symbol without its quote currency, whatever the case of the input."""
    return F.replace(F.upper(symbol), F.lit(quote.upper()), F.lit(""))


def same_symbol(symbol: Column, wanted: str, exact_case: bool = False) -> Column:
    """Symbol filter that parquet can use to skip row groups. Accepts the symbol as it is
    written and in all upper or lower case; ``exact_case`` only as it is written."""
    if exact_case:
        return symbol == wanted
    return symbol.isin(sorted({wanted, wanted.upper(), wanted.lower()}))
