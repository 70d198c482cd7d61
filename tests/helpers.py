"""Small frames for tests."""

import datetime as dt

DAY = dt.datetime(2024, 3, 1)


def at(clock: str, micros: int = 0) -> dt.datetime:
    """``10:01:05`` on the test day."""
    hours, minutes, seconds = (int(part) for part in clock.split(":"))
    return DAY + dt.timedelta(hours=hours, minutes=minutes, seconds=seconds, microseconds=micros)


def ms(moment: dt.datetime) -> int:
    return round((moment - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


RECORD = (
    "source string, symbol string, price double, quantity double, trade_time bigint, "
    "is_buyer_maker boolean, ingested_at string"
)


def records(spark, *rows):
    """Trade records of (symbol, price, quantity, moment, maker); later rows came later."""
    full = [
        ("feed", s, p, q, None if t is None else ms(t), m, (DAY + dt.timedelta(seconds=i)).isoformat())
        for i, (s, p, q, t, m) in enumerate(rows)
    ]
    return spark.createDataFrame(full, RECORD)


def trades(spark, *rows):
    """Timed trades of (symbol, price, quantity, moment, maker)."""
    schema = (
        "symbol string, price double, quantity double, trade_timestamp timestamp, "
        "is_buyer_maker boolean"
    )
    return spark.createDataFrame(list(rows), schema)


def candle(symbol, start, o=1.0, h=1.0, low=1.0, c=1.0, volume=1.0, buy=1.0, sell=0.0, n=1):
    return (start, symbol, o, h, low, c, volume, buy, sell, n, start)


def candles(spark, *rows):
    from tapeworks import schemas

    return spark.createDataFrame(list(rows), schemas.CANDLE)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
