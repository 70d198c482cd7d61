"""Trade feeds derived from the given tables, in Spark and as DuckDB text.

Every feed maps a whole table row by row. Defects are planted by the value of the
event's own ``k`` property, never by leaving rows out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.session import pin_utc

# The day after the last event; stands in for "now" in both engines.
AS_OF = dt.datetime(2024, 1, 31)
AS_OF_SQL = "timestamp '2024-01-31 00:00:00'"
RUN_DAY = dt.date(2024, 1, 15)
FEED = "events"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def read_events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    if not streaming:
        return read(spark, sf_dir, "events")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    return (
        pin_utc(spark)
        .readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def trades(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Clean trade records, with the event id as a trade id."""
    moment = F.col("ts").cast("timestamp")
    return read_events(spark, sf_dir, streaming).select(
        "event_id",
        F.lit(FEED).alias("source"),
        F.upper("event_type").alias("symbol"),
        F.col("value").alias("price"),
        _k().alias("quantity"),
        F.unix_millis(moment).alias("trade_time"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"),
    )


def timed_trades(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """The same with the event time as a timestamp, ready to be folded into candles."""
    return trades(spark, sf_dir, streaming).withColumn(
        "trade_timestamp", F.timestamp_millis("trade_time")
    )


TRADES_SQL = """
trades as (
    select event_id, 'events' as source, upper(event_type) as symbol, value as price,
           cast(json_extract_string(props, '$.k') as double) as quantity,
           epoch_us(ts) // 1000 as trade_time,
           user_id % 2 = 0 as is_buyer_maker,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as ingested_at,
           make_timestamp((epoch_us(ts) // 1000) * 1000) as trade_timestamp
    from events)
"""


# When a candle of the event feed was ingested: not in the order of the candles.
INGESTED_SQL = """candle_start_time
    + interval 1 second * (60 + extract(minute from candle_start_time) * 617 % 3600)"""


def faulty_trades(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Trades with planted defects, the whole feed delivered twice.

    The second delivery was ingested a second later.
    """
    k, price = F.col("k"), F.col("price")
    late = F.to_timestamp("ingested_at") + F.expr("interval 1 second") * F.col("delivery")
    # The property leaves the generator as a column of its own; otherwise its JSON would be
    # parsed again in every cleaning filter.
    deliveries = [F.struct(F.col("quantity").alias("k"), F.lit(i).alias("delivery")) for i in (0, 1)]
    return (
        trades(spark, sf_dir, streaming)
        .select("*", F.inline(F.array(*deliveries)))
        .select(
            "event_id",
            "source",
            F.when(k != 11, F.col("symbol")).alias("symbol"),
            F.when(k == 37, price * 10_000_000).when(k == 41, -price).when(k != 23, price)
            .alias("price"),
            F.when(k != 29, k).alias("quantity"),
            F.when(k != 53, F.col("trade_time")).alias("trade_time"),
            F.when(k != 67, F.col("is_buyer_maker")).alias("is_buyer_maker"),
            F.when(k == 71, F.lit("garbage"))
            .otherwise(F.date_format(late, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("ingested_at"),
        )
    )


FAULTY_SQL = TRADES_SQL + """,
faulty as (
    select event_id, source,
           case when quantity = 11 then null else symbol end as symbol,
           case quantity when 37 then price * 10000000 when 41 then -price
                         when 23 then null else price end as price,
           case when quantity = 29 then null else quantity end as quantity,
           case when quantity = 53 then null else trade_time end as trade_time,
           case when quantity = 67 then null else is_buyer_maker end as is_buyer_maker,
           case when quantity = 71 then 'garbage' else
                strftime(cast(ingested_at as timestamp) + delivery * interval 1 second,
                         '%Y-%m-%dT%H:%M:%S.%f') end as ingested_at
    from trades cross join (values (0), (1)) copies(delivery)),
valid as (
    select * from faulty
    where price > 0 and price < 1000000 and quantity > 0
      and symbol is not null and trade_time is not null),
typed as (
    select event_id, source, symbol, is_buyer_maker,
           round(price, 8) as price, round(quantity, 8) as quantity,
           make_timestamp(trade_time * 1000) as trade_timestamp,
           try_cast(ingested_at as timestamp) as ingest_timestamp
    from valid),
enriched as (
    select *, round(price * quantity, 8) as trade_value,
           case when is_buyer_maker = false then 'BUY' else 'SELL' end as trade_side,
           round(ln(price) / ln(10.0), 2) + 0.0 as price_magnitude,
           round(price * quantity, 8) > 10000 as is_large_trade
    from typed),
kept as (
    select * from enriched
    qualify row_number() over (
        partition by symbol, trade_timestamp, price, quantity
        order by ingest_timestamp nulls last, event_id) = 1)
"""


def records(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Keyed messages as a topic would deliver them; where k is 13 the text is no JSON."""
    return records_of(trades(spark, sf_dir, streaming))


def records_of(trades: DataFrame) -> DataFrame:
    record = F.struct(
        "source", "symbol", "price", "quantity", "trade_time", "is_buyer_maker", "ingested_at"
    )
    body = F.when(F.col("quantity") == 13, F.lit("not json")).otherwise(F.to_json(record))
    return trades.select(F.col("symbol").alias("key"), body.alias("value"))


RECORDS_SQL = TRADES_SQL + """,
decoded as (
    select case when quantity <> 13 then source end as source,
           case when quantity <> 13 then symbol end as symbol,
           case when quantity <> 13 then price end as price,
           case when quantity <> 13 then quantity end as quantity,
           case when quantity <> 13 then trade_time end as trade_time,
           case when quantity <> 13 then is_buyer_maker end as is_buyer_maker,
           case when quantity <> 13 then ingested_at end as ingested_at,
           case when quantity <> 13 then trade_timestamp end as timestamp
    from trades)
"""


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire messages: amounts as text, with broken, foreign and incomplete ones among them."""
    k = F.col("quantity")
    price = F.when(k == 47, F.lit("abc")).otherwise(F.col("price").cast("string"))
    data = F.struct(
        F.col("symbol").alias("s"),
        price.alias("p"),
        k.cast("string").alias("q"),
        F.col("trade_time").alias("T"),
        # Nulls are not written, so where k is 17 the field is absent.
        F.when(k != 17, F.col("is_buyer_maker")).alias("m"),
    )
    stream = F.concat(F.lower("symbol"), F.lit("@trade")).alias("stream")
    body = (
        F.when(k == 13, F.lit("not json"))
        .when(k == 59, F.to_json(F.struct(stream)))
        .otherwise(F.to_json(F.struct(stream, data.alias("data"))))
    )
    return trades(spark, sf_dir).select(body.alias("value"))


def item_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trades: the unit price by line status and ship date.

    The largest table as a daily feed with two symbols, each holding half of all rows.
    Times are whole days, so open and close rest on the trade id alone. Order and line
    number repeat in this table; the price in cents tells the repetitions apart.
    """
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("symbol"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity"), 8).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").cast("timestamp").alias("trade_timestamp"),
        (F.col("l_suppkey") % 2 == 0).alias("is_buyer_maker"),
        (
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100_000_000
            + F.round(F.col("l_extendedprice") * 100).cast("bigint")
        ).alias("trade_id"),
    )


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One index reading per day with events."""
    value = (F.sum("user_id") % 101).cast("int")
    return (
        read_events(spark, sf_dir)
        .groupBy(F.to_date("ts").alias("date"))
        .agg(value.alias("fng_value"))
        .withColumn("fng_classification", _mood(F.col("fng_value")))
    )


def _mood(value: Column) -> Column:
    return (
        F.when(value < 25, "Extreme Fear").when(value < 50, "Fear").when(value < 75, "Greed")
        .otherwise("Extreme Greed")
    )


SENTIMENT_SQL = """
sentiment as (
    select date, fng_value,
           case when fng_value < 25 then 'Extreme Fear' when fng_value < 50 then 'Fear'
                when fng_value < 75 then 'Greed' else 'Extreme Greed' end as fng_classification
    from (select cast(ts as date) as date, cast(sum(user_id) % 101 as integer) as fng_value
          from events group by 1))
"""


def candles_sql(
    name: str,
    source: str = "trades",
    bucket: str = "interval 1 minute",
    trade_id: str = "event_id",
) -> str:
    """A candle relation named ``name`` over ``source``."""
    return f"""
{name} as (
    select time_bucket({bucket}, trade_timestamp) as candle_start_time, symbol,
           arg_min(price, row(trade_timestamp, {trade_id})) as open_price,
           max(price) as high_price, min(price) as low_price,
           arg_max(price, row(trade_timestamp, {trade_id})) as close_price,
           sum(quantity) as total_volume,
           coalesce(sum(quantity) filter (where not is_buyer_maker), 0) as buy_volume_taker,
           coalesce(sum(quantity) filter (where is_buyer_maker), 0) as sell_volume_maker,
           cast(count(*) as bigint) as trade_count
    from {source} group by 1, 2)
"""
