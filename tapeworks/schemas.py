"""Declared schemas, as DDL so that they need no running session."""

TRADE = """
    source string, symbol string, price double, quantity double,
    trade_time bigint, is_buyer_maker boolean, ingested_at string
"""

BRONZE = TRADE + ", timestamp timestamp, year int, month int, day int, hour int"

SILVER = """
    source string, symbol string, price double, quantity double,
    is_buyer_maker boolean, trade_timestamp timestamp, ingest_timestamp timestamp,
    trade_value double, trade_side string, price_magnitude double,
    is_large_trade boolean, processed_at timestamp,
    year int, month int, day int
"""

CANDLE = """
    candle_start_time timestamp, symbol string,
    open_price double, high_price double, low_price double, close_price double,
    total_volume double, buy_volume_taker double, sell_volume_maker double,
    trade_count bigint, ingested_at timestamp
"""

# The partition column of a stored candle table: the day of the candle.
CANDLE_DAY = "candle_day"

# The innermost partition of bronze and silver: which run wrote the files.
RUN = "run"
BACKLOG = "backlog"
# Parts of late rows begin so; their candles are made where they are found.
LATE = "late"

SENTIMENT = "date date, fng_value int, fng_classification string, updated_at timestamp"

# The keys of one wire message. A map keeps "absent" apart from "null".
ENVELOPE = "stream string, data map<string,string>"

# The reply of the sentiment index: one array, newest element first.
INDEX_REPLY = "data array<struct<value: string, value_classification: string, timestamp: string>>"
