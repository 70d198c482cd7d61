"""Numbers: parsing, ratios and the key that orders trades."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a float literal may look like in a message. The JVM parser also takes type
# suffixes and hexadecimal floats, which the feed never means as numbers.
FLOAT_TEXT = r"(?i)^\s*[-+]?(inf|infinity|nan|([0-9]+\.?[0-9]*|\.[0-9]+)(e[-+]?[0-9]+)?)\s*$"


def parse_float(text: Column) -> Column:
    """Text to double, NULL when the text is no number."""
    return F.when(text.rlike(FLOAT_TEXT), text.try_cast("double"))


def percent_of(part: Column, whole: Column, places: int) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is zero."""
    return F.round(part / F.nullif(whole, F.lit(0)) * 100, places)


def percent_change(start: Column, end: Column, places: int) -> Column:
    return percent_of(end - start, start, places)


def magnitude(price: Column, places: int) -> Column:
    """Order of magnitude: the decimal logarithm, as a quotient of natural ones."""
    return F.round(F.ln(price) / F.ln(F.lit(10.0)), places)


# Divisor of the number that orders trades of one instant: a prime below 10**5.
_TURN = 65_521
_PLACES = 10**8


def trade_turn(price: Column, quantity: Column) -> Column:
    """An order of trades of one instant that have no id: by content, not by arrival.

    The first digits are a remainder of price and quantity in units of 10**-8, which
    favours neither high nor low prices; the price behind them settles equal remainders,
    so trades that are still equal have equal prices.
    """
    units = [F.coalesce(F.round(x * _PLACES).try_cast("bigint"), F.lit(0)) for x in (price, quantity)]
    first, second = (F.pmod(x, F.lit(_TURN)) for x in units)
    remainder = F.pmod(first * 31 + second * 17, F.lit(_TURN))
    return remainder * 10**14 + F.pmod(units[0], F.lit(10**14))


def trade_order(moment: Column, turn: Column) -> Column:
    """The value by which trades are ordered inside a candle.

    Time and ``turn``, an id or ``trade_turn``, are packed into one decimal. A struct
    would order the same way, but a struct is no fixed-width buffer: Spark would sort
    every input row (SortAggregate) instead of hashing it.
    """
    # Microseconds of a timestamp have at most 18 digits and an id 19, so 20 digits
    # of room keep the two apart, negative ids included, within 38 digits.
    room = F.lit(Decimal(10) ** 20)
    micros = F.unix_micros(moment).cast("decimal(18,0)")
    return micros * room + F.coalesce(turn, F.lit(0)).cast("decimal(19,0)")
