"""Values that decide results, kept in one place.

They are the defaults of the matching parameters; nothing else in the
package repeats them.
"""

# Trade cleaning.
PRICE_CEILING = 1_000_000
LARGE_TRADE_VALUE = 10_000
AMOUNT_PLACES = 8
MAGNITUDE_PLACES = 2
DEDUP_KEYS = ("symbol", "trade_timestamp", "price", "quantity")

# Event time.
LATENESS = "10 minutes"
CANDLE_WIDTH = "1 minute"
HORIZON = "24 hours"

# Labels.
SIDE_BUY = "BUY"
SIDE_SELL = "SELL"
CANDLE_UP = "Bullish"
CANDLE_DOWN = "Bearish"
STATUS_FRESH = "Fresh ✅"
STATUS_STALE = "Stale ⚠️"
STATUS_DEAD = "Dead ❌"

# Health thresholds.
FRESH_MINUTES = 5
STALE_MINUTES = 30
CANDLES_PER_HOUR = 60
HOURS_PER_DAY = 24

# Storage layout and warehouse load.
BRONZE_PARTITIONS = ("year", "month", "day", "hour")
SILVER_PARTITIONS = ("year", "month", "day")
LOAD_COLUMNS = (
    "symbol",
    "price",
    "quantity",
    "is_buyer_maker",
    "trade_timestamp",
    "ingest_timestamp",
)
JDBC_CHUNK = 1000

# The pair shown next to the sentiment index.
SENTIMENT_SYMBOL = "btcusdt"
QUOTE_SUFFIX = "usdt"
