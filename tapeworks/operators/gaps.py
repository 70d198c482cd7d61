"""Minutes in which a candle is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.moments import start_of


def _hours(candles: DataFrame, until: Column | None) -> DataFrame:
    """Hours with candles, as masks of their minutes, and the hour the next gap ends before."""
    start, hour = F.col("candle_start_time"), F.col("candle_hour")
    one_hour = F.expr("interval 1 hour")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.minute(start))
    seen = candles.groupBy("symbol", start_of("hour", start).alias("candle_hour")).agg(
        F.bit_or(bit).alias("mask")
    )
    following = F.lead("candle_hour").over(Window.partitionBy("symbol").orderBy("candle_hour"))
    end = hour + one_hour
    if until is not None:
        end = F.greatest(end, start_of("hour", until))
    return seen.withColumn("next_hour", F.coalesce(following, end))


def missing_spans(candles: DataFrame, until: Column | None = None) -> DataFrame:
    """(symbol, span_start, span_end, missing_minutes): where candles are missing.

    A row for each hour that has some candles but not all, and one for each run of hours
    without any, however long; ``span_end`` is the first moment behind it. The range of a
    symbol runs from its first hour to its last, in whole hours. ``until`` extends it up to
    the hour before that moment, which shows symbols that stopped trading.

    An hour of candles folds into one 60-bit mask, a hash aggregate with a fixed-width
    buffer. The window over the hours of a symbol sees some 8,800 rows a year, whatever
    the trade volume.
    """
    hour, behind = F.col("candle_hour"), F.col("candle_hour") + F.expr("interval 1 hour")
    spans = F.array(
        F.struct(
            hour.alias("span_start"),
            behind.alias("span_end"),
            (60 - F.bit_count("mask")).cast("bigint").alias("missing_minutes"),
        ),
        F.struct(
            behind.alias("span_start"),
            F.col("next_hour").alias("span_end"),
            F.floor((F.unix_seconds("next_hour") - F.unix_seconds(behind)) / 60)
            .cast("bigint")
            .alias("missing_minutes"),
        ),
    )
    found = _hours(candles, until).select("symbol", "mask", F.explode(spans).alias("span"))
    return found.select("symbol", "span.*").filter("missing_minutes > 0")


def missing_candles(candles: DataFrame, until: Column | None = None) -> DataFrame:
    """Every (symbol, minute) without a candle, in the range of ``missing_spans``.

    Within an hour the rows found here equal 60 less its candles. No spine of all minutes
    is built or joined: only unset bits are expanded. A run of hours without candles is
    expanded by years, days and hours in turn and dealt out in between, so a candle with a
    far-off time makes many rows but no long array and no long task.
    """
    hour, behind = F.col("candle_hour"), F.col("candle_hour") + F.expr("interval 1 hour")
    none = F.lit(0).cast("bigint")
    spans = F.array(
        F.struct(hour.alias("low"), behind.alias("high"), "mask"),
        F.struct(behind.alias("low"), F.col("next_hour").alias("high"), none.alias("mask")),
    )
    found = _hours(candles, until).select("symbol", F.explode(spans).alias("span"))
    found = found.select("symbol", "span.*").filter("low < high")
    for unit in ("year", "day", "hour"):
        step = F.expr(f"interval 1 {unit}")
        last = F.col("high") - F.expr("interval 1 second")
        pieces = F.sequence(F.date_trunc(unit, "low"), last, step)
        found = found.select("symbol", "mask", "low", "high", F.explode(pieces).alias("piece")).select(
            "symbol",
            "mask",
            F.greatest("low", "piece").alias("low"),
            F.least("high", F.col("piece") + step).alias("high"),
        )
        if unit == "year":
            # A span of many years is dealt out before its days are made.
            found = found.repartition("symbol", "low")
    full_hour = F.sequence(F.lit(0), F.lit(59))
    unset = F.filter(full_hour, lambda m: F.getbit(F.col("mask"), m) == 0)
    return found.select("symbol", "low", F.explode(unset).alias("minute")).select(
        "symbol",
        (F.col("low") + F.make_dt_interval(mins=F.col("minute"))).alias("missing_minute"),
    )
