"""Queries on messages, single trades and candles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import feeds
from catalog.registry import query
from tapeworks import fixed_values as fv
from tapeworks.functions.moments import within_days
from tapeworks.operators import messages, trades
from tapeworks.operators.candles import merged_candles, to_candles
from tapeworks.operators.concat import concat
from tapeworks.plans import layers

CANDLE_COLUMNS = """candle_start_time, symbol, open_price, high_price, low_price, close_price,
    total_volume, buy_volume_taker, sell_volume_maker, trade_count"""
SILVER_COLUMNS = """source, symbol, is_buyer_maker, price, quantity, trade_timestamp,
    ingest_timestamp, trade_value, trade_side, price_magnitude, is_large_trade"""
DAY_PARTS = """, cast(year(trade_timestamp) as integer) as year,
    cast(month(trade_timestamp) as integer) as month,
    cast(day(trade_timestamp) as integer) as day"""


def candles(spark, sf_dir, **options):
    """Candles of the event feed, each ingested at a time of its own (``feeds.INGESTED_SQL``)."""
    start = F.col("candle_start_time")
    after = F.make_dt_interval(secs=60 + F.minute(start) * 617 % 3600)
    made = to_candles(feeds.timed_trades(spark, sf_dir), trade_id="event_id", **options)
    return made.withColumn("ingested_at", start + after)


# --- messages ---------------------------------------------------------------


@query(
    f"""with {feeds.TRADES_SQL}
    select source, symbol, price, quantity, trade_time, is_buyer_maker
    from trades where quantity not in (13, 17, 47, 59)"""
)
def envelope_normalize(spark, sf_dir):
    wire = feeds.envelopes(spark, sf_dir)
    return messages.normalize_envelopes(wire, feed=feeds.FEED).drop("ingested_at")


@query(
    f"""with {feeds.RECORDS_SQL}
    select source, symbol, price, quantity, trade_time, is_buyer_maker, ingested_at
    from decoded"""
)
def bronze_decode(spark, sf_dir):
    return messages.decode_trades(feeds.records(spark, sf_dir))


BRONZE_SQL = f"""with {feeds.RECORDS_SQL}
    select source, symbol, price, quantity, trade_time, is_buyer_maker, ingested_at, timestamp,
           cast(year(timestamp) as integer) as year, cast(month(timestamp) as integer) as month,
           cast(day(timestamp) as integer) as day, cast(hour(timestamp) as integer) as hour
    from decoded"""


@query(BRONZE_SQL)
def bronze_calendar(spark, sf_dir):
    return layers.bronze(feeds.records(spark, sf_dir))


@query(
    f"""with {feeds.RECORDS_SQL}
    select cast(count(*) as bigint) as rejected from decoded where source is null"""
)
def rejected_messages(spark, sf_dir):
    decoded = messages.decode_trades(feeds.records(spark, sf_dir))
    return messages.undecodable(decoded).agg(F.count(F.lit(1)).alias("rejected"))


@query(
    f"""with {feeds.TRADES_SQL}
    select cast(count(*) filter (quantity = 13) as bigint) as undecodable,
           cast(count(*) filter (quantity = 19) as bigint) as untimed
    from trades"""
)
def rejected_counts(spark, sf_dir):
    """Messages that end in bronze: no JSON, or a time beyond the calendar."""
    time = F.when(F.col("quantity") == 19, F.lit(2**62)).otherwise(F.col("trade_time"))
    far = feeds.trades(spark, sf_dir).withColumn("trade_time", time)
    bronze = layers.bronze(feeds.records_of(far))
    return bronze.agg(
        F.count_if(F.col("symbol").isNull()).alias("undecodable"),
        F.count_if(messages.untimed(F.col("trade_time"), F.col("timestamp"))).alias("untimed"),
    )


@query(
    f"""with {feeds.TRADES_SQL}
    select symbol as key, source, symbol, price, quantity, trade_time, is_buyer_maker, ingested_at
    from trades"""
)
def message_out(spark, sf_dir):
    """Published messages, read back field by field: JSON text differs by engine."""
    sent = messages.to_messages(feeds.trades(spark, sf_dir).drop("event_id"))
    record = messages.decode_trades(sent.withColumnRenamed("value", "body"), "body")
    keys = F.col("key")
    return sent.select(keys, F.from_json("value", record.schema).alias("r")).select(keys, "r.*")


# --- trades -----------------------------------------------------------------


@query(
    f"""with {feeds.FAULTY_SQL}
    select event_id, source, symbol, price, quantity, trade_time, is_buyer_maker, ingested_at
    from valid"""
)
def silver_valid(spark, sf_dir):
    return trades.valid_trades(feeds.faulty_trades(spark, sf_dir))


@query(f"with {feeds.FAULTY_SQL} select event_id, {SILVER_COLUMNS} from enriched")
def silver_enriched(spark, sf_dir):
    typed = trades.standardized_trades(trades.valid_trades(feeds.faulty_trades(spark, sf_dir)))
    return trades.enriched_trades(typed).drop("processed_at")


SILVER_SQL = f"with {feeds.FAULTY_SQL} select {SILVER_COLUMNS}{DAY_PARTS} from kept"


@query(SILVER_SQL)
def silver_dedup(spark, sf_dir):
    """The whole silver plan; every trade arrives twice and stays once."""
    return layers.silver(feeds.faulty_trades(spark, sf_dir)).drop("event_id", "processed_at")


@query(SILVER_SQL.replace("select source,", "select"))
def silver_dedup_numeric(spark, sf_dir):
    """The same without the text label, which lets the dedup hash instead of sort."""
    feed = feeds.faulty_trades(spark, sf_dir).drop("event_id", "source")
    return layers.silver(feed).drop("processed_at")


@query(
    f"""with {feeds.TRADES_SQL}
    select symbol, price, quantity, trade_time, is_buyer_maker, null::varchar as ingested_at
    from trades
    union all
    select symbol, price, quantity, trade_time, null::boolean, ingested_at from trades"""
)
def union_by_name(spark, sf_dir):
    both = feeds.trades(spark, sf_dir).drop("event_id", "source")
    return concat(both.drop("ingested_at"), both.drop("is_buyer_maker"))


@query(
    f"""with {feeds.FAULTY_SQL}
    select symbol, price, quantity, is_buyer_maker, trade_timestamp, ingest_timestamp from kept"""
)
def load_projection(spark, sf_dir):
    return layers.silver(feeds.faulty_trades(spark, sf_dir)).select(*fv.LOAD_COLUMNS)


@query(
    f"""with {feeds.FAULTY_SQL}
    select symbol, price, quantity, is_buyer_maker, trade_timestamp, ingest_timestamp
    from kept where cast(trade_timestamp as date) = date '{feeds.RUN_DAY}'"""
)
def slice_filter(spark, sf_dir):
    clean = layers.silver(feeds.faulty_trades(spark, sf_dir))
    return clean.filter(within_days(feeds.RUN_DAY, feeds.RUN_DAY)).select(*fv.LOAD_COLUMNS)


# --- candles ----------------------------------------------------------------


@query(
    f"with {feeds.TRADES_SQL}, {feeds.candles_sql('candles')} select {CANDLE_COLUMNS} from candles"
)
def candles_1m(spark, sf_dir):
    return candles(spark, sf_dir).drop("ingested_at")


HOURLY_SQL = f"""with {feeds.TRADES_SQL},
    {feeds.candles_sql('candles', bucket='interval 1 hour')} select {CANDLE_COLUMNS} from candles"""


TIED_SQL = f"""with {feeds.TRADES_SQL},
    tied as (
        select *, time_bucket(interval 10 minutes, trade_timestamp) as instant,
               round(price * 100000000)::bigint as p, round(quantity * 100000000)::bigint as q
        from trades),
    turned as (
        select *, ((p % 65521) * 31 + (q % 65521) * 17) % 65521 * 100000000000000
               + p % 100000000000000 as turn
        from tied)
    select instant as candle_start_time, symbol, arg_min(price, turn) as open_price,
           max(price) as high_price, min(price) as low_price, arg_max(price, turn) as close_price,
           sum(quantity) as total_volume,
           coalesce(sum(quantity) filter (where not is_buyer_maker), 0) as buy_volume_taker,
           coalesce(sum(quantity) filter (where is_buyer_maker), 0) as sell_volume_maker,
           count(*) as trade_count
    from turned group by 1, 2"""


@query(TIED_SQL)
def candles_tied(spark, sf_dir):
    """Trades moved to a few instants and without an id: their content orders them."""
    moved = feeds.timed_trades(spark, sf_dir).withColumn(
        "trade_timestamp", F.window("trade_timestamp", "10 minutes")["start"]
    )
    return to_candles(moved.drop("event_id")).drop("ingested_at")


@query(HOURLY_SQL)
def candles_1h(spark, sf_dir):
    return candles(spark, sf_dir, width="1 hour").drop("ingested_at")


@query(HOURLY_SQL)
def candles_1h_from_1m(spark, sf_dir):
    """Minutes folded into hours give what folding the trades into hours gives."""
    hour = F.date_trunc("hour", "candle_start_time").alias("candle_start_time")
    return merged_candles(candles(spark, sf_dir), "symbol", hour)


@query(
    f"""with items as (
        select l_linestatus as symbol,
               round(l_extendedprice / l_quantity, 8) as price, l_quantity as quantity,
               l_shipdate as trade_timestamp, l_suppkey % 2 = 0 as is_buyer_maker,
               (l_orderkey * 10 + l_linenumber) * 100000000
                   + cast(round(l_extendedprice * 100) as bigint) as trade_id
        from lineitem),
    {feeds.candles_sql('candles', 'items', 'interval 1 day', 'trade_id')}
    select {CANDLE_COLUMNS} from candles"""
)
def candles_1d_items(spark, sf_dir):
    """Daily candles of the largest table, where each of two symbols holds half of all rows."""
    items = feeds.item_trades(spark, sf_dir)
    return to_candles(items, width="1 day", trade_id="trade_id").drop("ingested_at")
