"""Queries on the candle table: overview, summary, health, sentiment, dashboards."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import feeds
from catalog.layers import CANDLE_COLUMNS, candles
from catalog.registry import query
from tapeworks.operators import checks
from tapeworks.operators.candles import described_candles
from tapeworks.operators.dedup import first_row_per_key
from tapeworks.operators.gaps import missing_candles as find_gaps
from tapeworks.operators.gaps import missing_spans as find_spans
from tapeworks.plans import dashboards
from tapeworks.plans import market_overview as overview
from tapeworks.plans import marts as mart_plans
from tapeworks.plans import ohlc_summary as ohlc
from tapeworks.plans import pipeline_health as health
from tapeworks.plans import price_vs_sentiment as against

BASE = f"with {feeds.TRADES_SQL}, {feeds.candles_sql('candles')}"
RECENT = f"candle_start_time >= {feeds.AS_OF_SQL} - interval 24 hours"


# --- market overview --------------------------------------------------------


@query(
    f"""{BASE} select symbol, arg_max(close_price, candle_start_time) as current_price,
    max(candle_start_time) as last_updated from candles group by symbol"""
)
def latest_candle(spark, sf_dir):
    return overview.latest_candles(candles(spark, sf_dir))


@query(
    f"""{BASE} select {CANDLE_COLUMNS} from candles
    qualify row_number() over (partition by symbol order by candle_start_time desc) = 1"""
)
def latest_candle_ranked(spark, sf_dir):
    """Whole newest rows, by a ranked group limit."""
    every = candles(spark, sf_dir).drop("ingested_at")
    return first_row_per_key(every, ["symbol"], F.desc("candle_start_time"))


@query(
    f"""{BASE} select symbol, arg_min(open_price, candle_start_time) as open_price_24h,
    min(candle_start_time) as first_candle_time from candles where {RECENT} group by symbol"""
)
def first_candle_24h(spark, sf_dir):
    return overview.first_candles(candles(spark, sf_dir), feeds.AS_OF)


STATS = """max(high_price) as high_24h, min(low_price) as low_24h,
    sum(total_volume) as volume_24h, sum(buy_volume_taker) as buy_volume_24h,
    sum(sell_volume_maker) as sell_volume_24h,
    cast(sum(trade_count) as bigint) as total_trades_24h"""


@query(f"{BASE} select symbol, {STATS} from candles where {RECENT} group by symbol")
def stats_24h(spark, sf_dir):
    return overview.horizon_stats(candles(spark, sf_dir), feeds.AS_OF)


@query(
    f"""{BASE},
    recent as (
        select symbol, {STATS}, arg_max(close_price, candle_start_time) as current_price,
               arg_min(open_price, candle_start_time) as open_price_24h,
               max(candle_start_time) as last_updated
        from candles where {RECENT} group by symbol)
    select *, current_price - open_price_24h as price_change_24h,
           round((current_price - open_price_24h) / nullif(open_price_24h, 0) * 100, 2)
               as price_change_pct_24h,
           round(buy_volume_24h / nullif(volume_24h, 0) * 100, 2) as buy_ratio_pct
    from recent"""
)
def market_overview(spark, sf_dir):
    return overview.market_overview(candles(spark, sf_dir), feeds.AS_OF)


# --- candle summary ---------------------------------------------------------

DESCRIBED = f"""{BASE},
described as (
    select {CANDLE_COLUMNS},
           if(close_price >= open_price, 'Bullish', 'Bearish') as candle_type,
           round(abs(close_price - open_price) / nullif(open_price, 0) * 100, 4) as body_size_pct,
           round(buy_volume_taker / nullif(total_volume, 0) * 100, 2) as buy_pressure_pct,
           cast(extract(hour from candle_start_time) as integer) as hour_of_day,
           date_trunc('hour', candle_start_time) as candle_hour,
           cast(date_trunc('day', candle_start_time) as timestamp) as candle_date
    from candles),
hours as (
    select symbol, candle_hour,
           arg_min(open_price, candle_start_time) as hourly_open,
           max(high_price) as hourly_high, min(low_price) as hourly_low,
           arg_max(close_price, candle_start_time) as hourly_close,
           sum(total_volume) as hourly_volume, sum(buy_volume_taker) as hourly_buy_vol,
           sum(sell_volume_maker) as hourly_sell_vol,
           cast(sum(trade_count) as bigint) as hourly_trades
    from described group by symbol, candle_hour)"""


@query(f"{DESCRIBED} select * from described")
def ohlc_enriched(spark, sf_dir):
    return described_candles(candles(spark, sf_dir).drop("ingested_at"))


@query(f"{DESCRIBED} select * from hours")
def ohlc_hourly(spark, sf_dir):
    return ohlc.hourly_candles(candles(spark, sf_dir))


@query(
    f"""{DESCRIBED} select *,
           round(hourly_buy_vol / nullif(hourly_volume, 0) * 100, 2) as hourly_buy_pct
    from described left join hours using (symbol, candle_hour)"""
)
def ohlc_summary(spark, sf_dir):
    return ohlc.ohlc_summary(candles(spark, sf_dir))


@query(
    f"""{DESCRIBED} select symbol, candle_start_time,
    first_value(open_price) over (partition by symbol, candle_hour order by candle_start_time)
        as hourly_open,
    cast(row_number() over (partition by symbol, candle_hour order by candle_start_time desc)
        as integer) as minutes_from_last
    from described"""
)
def hour_positions(spark, sf_dir):
    """Running windows with the default frame, and the rank counted from the last candle."""
    of_hour = Window.partitionBy("symbol", "candle_hour")
    described = described_candles(candles(spark, sf_dir))
    return described.select(
        "symbol",
        "candle_start_time",
        F.first("open_price").over(of_hour.orderBy("candle_start_time")).alias("hourly_open"),
        F.row_number().over(of_hour.orderBy(F.desc("candle_start_time"))).alias("minutes_from_last"),
    )


# --- pipeline health --------------------------------------------------------

HEALTH = f"""{BASE},
hourly as (
    select date_trunc('hour', candle_start_time) as ingestion_hour, symbol,
           count(*) as candles_count, cast(sum(trade_count) as bigint) as total_trades,
           sum(total_volume) as total_volume, max({feeds.INGESTED_SQL}) as last_ingested_at,
           min(candle_start_time) as earliest_candle, max(candle_start_time) as latest_candle,
           cast(round(count(*) / 60.0 * 100, 1) as double) as completeness_pct,
           60 - count(*) as missing_candles
    from candles group by 1, 2),
ages as (
    select symbol, max(candle_start_time) as latest_candle_time,
           max({feeds.INGESTED_SQL}) as latest_ingestion_time,
           epoch_us({feeds.AS_OF_SQL} - max(candle_start_time)) / 6e7 as minutes_since_last_candle
    from candles group by symbol),
fresh as (
    select *, case when minutes_since_last_candle <= 5 then 'Fresh ✅'
                   when minutes_since_last_candle <= 30 then 'Stale ⚠️'
                   else 'Dead ❌' end as freshness_status
    from ages),
daily as (
    select cast(date_trunc('day', candle_start_time) as timestamp) as date,
           count(*) as total_candles, count(distinct symbol) as active_symbols,
           cast(sum(trade_count) as bigint) as total_trades, sum(total_volume) as total_volume,
           sum(trade_count) / count(*) as avg_trades_per_candle,
           round(count(*) / nullif(count(distinct symbol) * 24.0 * 60, 0) * 100, 1)::double
               as daily_completeness_pct
    from candles group by 1)"""


@query(f"{HEALTH} select * from hourly")
def hourly_ingestion(spark, sf_dir):
    return health.hourly_ingestion(candles(spark, sf_dir))


@query(f"{HEALTH} select * from fresh")
def freshness(spark, sf_dir):
    return health.freshness(candles(spark, sf_dir), feeds.AS_OF)


@query(f"{HEALTH} select * from daily")
def daily_summary(spark, sf_dir):
    return health.daily_summary(candles(spark, sf_dir))


@query(
    f"""{HEALTH},
    placed as (
        select *, max(latest_candle) over (partition by symbol) as latest_candle_time,
               cast(sum(candles_count) over one_day as bigint) as day_total_candles,
               count(distinct symbol) over one_day as day_active_symbols
        from hourly window one_day as (partition by date_trunc('day', ingestion_hour))),
    aged as (
        select *, epoch_us({feeds.AS_OF_SQL} - latest_candle_time) / 6e7
                   as minutes_since_last_candle,
               round(day_total_candles / (day_active_symbols * 24.0 * 60) * 100, 1)::double
                   as daily_completeness_pct
        from placed)
    select *, case when minutes_since_last_candle > 30 then 'Dead ❌'
                   when minutes_since_last_candle > 5 then 'Stale ⚠️' else 'Fresh ✅' end
               as freshness_status
    from aged"""
)
def pipeline_health(spark, sf_dir):
    return health.pipeline_health(candles(spark, sf_dir), feeds.AS_OF)


@query(
    f"""{BASE},
    spans as (select symbol, date_trunc('hour', min(candle_start_time)) as low,
                     date_trunc('hour', max(candle_start_time)) + interval 59 minutes as high
              from candles group by symbol),
    spine as (select symbol, unnest(generate_series(low, high, interval 1 minute))
                     as missing_minute from spans)
    select symbol, missing_minute from spine
    where (symbol, missing_minute) not in (select symbol, candle_start_time from candles)"""
)
def missing_candles(spark, sf_dir):
    return find_gaps(candles(spark, sf_dir))


@query(
    f"""{BASE},
    hours as (
        select symbol, date_trunc('hour', candle_start_time) as span_start, 60 - count(*) as missing_minutes
        from candles group by 1, 2),
    runs as (
        select symbol, span_start + interval 1 hour as span_start,
               lead(span_start) over (partition by symbol order by span_start) as span_end
        from hours)
    select symbol, span_start, span_start + interval 1 hour as span_end, missing_minutes
    from hours where missing_minutes > 0
    union all
    select symbol, span_start, span_end, epoch_us(span_end - span_start) // 60000000
    from runs where span_end > span_start"""
)
def missing_spans(spark, sf_dir):
    return find_spans(candles(spark, sf_dir))


# --- sentiment --------------------------------------------------------------

PRICES = f"""{BASE}, {feeds.SENTIMENT_SQL},
prices as (
    select cast(candle_start_time as date) as date, symbol, round(avg(close_price), 8) as avg_price,
           max(high_price) as max_price, min(low_price) as min_price,
           sum(total_volume) as total_volume
    from candles group by 1, 2)"""


def _round_average(df):
    """The average of fractional prices, free of the order in which they are summed."""
    return df.withColumn("avg_price", F.round("avg_price", 8))


@query(f"{PRICES} select * from prices")
def daily_price(spark, sf_dir):
    return _round_average(against.daily_price(candles(spark, sf_dir), symbol=None))


@query(
    f"""{PRICES} select prices.*, fng_value, fng_classification
    from prices left join sentiment using (date) where symbol = 'PURCHASE' order by date desc"""
)
def price_vs_sentiment(spark, sf_dir):
    joined = against.price_vs_sentiment(
        candles(spark, sf_dir), feeds.sentiment(spark, sf_dir), symbol="purchase"
    )
    return _round_average(joined)


# --- dashboards -------------------------------------------------------------


@query(
    f"""{DESCRIBED} select symbol, candle_type, count(*) as candles
    from described group by symbol, candle_type"""
)
def candle_mix(spark, sf_dir):
    return dashboards.candle_mix(candles(spark, sf_dir))


@query(
    f"""{DESCRIBED} select symbol, hour_of_day, sum(buy_volume_taker) as buy_volume,
           sum(total_volume) as volume,
           round(sum(buy_volume_taker) / nullif(sum(total_volume), 0) * 100, 2) as buy_pressure_pct
    from described group by symbol, hour_of_day"""
)
def buy_pressure_heatmap(spark, sf_dir):
    return dashboards.buy_pressure_heatmap(candles(spark, sf_dir))


# --- checks -----------------------------------------------------------------


@query(f"with {feeds.FAULTY_SQL} select symbol from faulty where symbol is null")
def check_not_null(spark, sf_dir):
    return checks.null_rows(feeds.faulty_trades(spark, sf_dir), "symbol")


REPEATED = """select event_id as unique_field, count(*) as n_records
    from faulty group by event_id having count(*) > 1"""


@query(f"with {feeds.FAULTY_SQL} {REPEATED}")
def check_unique(spark, sf_dir):
    return checks.repeated_values(feeds.faulty_trades(spark, sf_dir), "event_id")


@query(
    f"""with {feeds.FAULTY_SQL}
    select count(*) as failures, count(*) <> 0 as should_warn, count(*) <> 0 as should_error
    from ({REPEATED})"""
)
def check_verdict(spark, sf_dir):
    faulty = feeds.faulty_trades(spark, sf_dir)
    return checks.verdict(checks.repeated_values(faulty, "event_id"))


@query(
    f"""with {feeds.FAULTY_SQL},
    counted as (
        select 'symbol' as column_name, count(*) filter (symbol is null) as failures from faulty
        union all select 'price', count(*) filter (price is null) from faulty
        union all select 'trade_time', count(*) filter (trade_time is null) from faulty)
    select *, failures <> 0 as should_warn, failures <> 0 as should_error from counted"""
)
def check_null_counts(spark, sf_dir):
    return checks.null_counts(
        feeds.faulty_trades(spark, sf_dir), "symbol", "price", "trade_time"
    )


@query(
    f"""{BASE},
    faulty as (
        select symbol, candle_start_time from candles
        union all select symbol, candle_start_time from candles
            where extract(minute from candle_start_time) = 7
        union all select null, candle_start_time from candles
            where extract(minute from candle_start_time) = 11
        union all select symbol, null from candles
            where extract(minute from candle_start_time) = 13),
    found as (
        select 'symbol not null' as "check", count(*) filter (symbol is null) as failures from faulty
        union all
        select 'candle_start_time not null', count(*) filter (candle_start_time is null) from faulty
        union all
        select 'candle unique', count(*) from (
            select 1 from faulty where symbol is not null and candle_start_time is not null
            group by symbol, candle_start_time having count(*) > 1))
    select *, failures <> 0 as should_warn, failures <> 0 as should_error from found"""
)
def candle_checks(spark, sf_dir):
    """Candles with some twice, some without a symbol and some without a time."""
    every = candles(spark, sf_dir)
    minute = F.minute("candle_start_time")
    nameless = every.filter(minute == 11).withColumn("symbol", F.lit(None).cast("string"))
    untimed = every.filter(minute == 13).withColumn(
        "candle_start_time", F.lit(None).cast("timestamp")
    )
    faulty = every.unionByName(every.filter(minute == 7)).unionByName(nameless)
    return mart_plans.candle_checks(faulty.unionByName(untimed))
