"""Queries that write, stream or merge, and read back what they left."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from catalog import feeds
from catalog.layers import BRONZE_SQL, CANDLE_COLUMNS, SILVER_COLUMNS, candles
from catalog.marts import BASE
from catalog.registry import ORACLES, query
from tapeworks import fixed_values as fv
from tapeworks import schemas
from tapeworks.operators.upsert import absent_by_key, upsert
from tapeworks.plans import layers
from tapeworks.plans.backfill import backfill
from tapeworks.plans.late_rows import restate
from tapeworks.plans.loads import load_sentiment, load_trade_history, merge_sentiment
from tapeworks.plans.marts import MART_KEYS, build_marts
from tapeworks.plans.marts import mart_checks as verify
from tapeworks.schemas import CANDLE_DAY
from tapeworks.session import scratch
from tapeworks.sinks import tables
from tapeworks.sinks.files import reload_slices, spread_writers
from tapeworks.sources.files import candle_table, day_folder, parquet_tree
from tapeworks.sources.messages import text_messages
from tapeworks.sources.sentiment import index_replies, newest_readings
from tapeworks.sources.tables import table
from tapeworks.storage import discard, exists
from tapeworks.streaming import drains

# --- tables and views -------------------------------------------------------


@query(f"{BASE} select {CANDLE_COLUMNS} from candles")
def table_roundtrip(spark, sf_dir):
    name = f"candles_{uuid.uuid4().hex}"
    fact = candles(spark, sf_dir).drop("ingested_at")
    tables.rebuild_table(fact, name, scratch(spark, "table"))
    return table(spark, name)


@query(f"{BASE} select symbol, count(*) as candles from candles group by symbol")
def view_roundtrip(spark, sf_dir):
    name = f"candles_{uuid.uuid4().hex}"
    tables.view(candles(spark, sf_dir), name)
    return table(spark, name).groupBy("symbol").agg(F.count(F.lit(1)).alias("candles"))


@query(
    f"""{BASE},
    recent as (select symbol from candles
               where candle_start_time >= {feeds.AS_OF_SQL} - interval 24 hours group by symbol),
    days as (select cast(candle_start_time as date) as date from candles
             where symbol = 'PURCHASE' group by 1),
    hours as (select distinct symbol, date_trunc('hour', candle_start_time) from candles),
    sizes as (
        select 'market_overview.symbol' as key_column, true as once, count(*) as n from recent
        union all select 'ohlc_summary.candle_start_time', false, count(*) from candles
        union all select 'pipeline_health.ingestion_hour', false, count(*) from hours
        union all select 'price_vs_sentiment.date', true, count(*) from days),
    found as (
        select key_column || ' not null' as "check", n as failures from sizes
        union all select key_column || ' unique', n from sizes where once)
    select *, failures <> 0 as should_warn, failures <> 0 as should_error from found"""
)
def mart_checks(spark, sf_dir):
    """All marts rebuilt on disk, read back and checked.

    Every row is read twice, and once more without its key.
    """
    paths = build_marts(
        spark,
        candles(spark, sf_dir),
        feeds.sentiment(spark, sf_dir),
        scratch(spark, "marts"),
        as_of=feeds.AS_OF,
        symbol="purchase",
    )
    faulty = {}
    for name, path in paths.items():
        mart, (key, _) = spark.read.parquet(path), MART_KEYS[name]
        keyless = mart.withColumn(key, F.lit(None).cast(mart.schema[key].dataType))
        faulty[name] = mart.unionByName(mart).unionByName(keyless)
    return verify(faulty)


# --- loads ------------------------------------------------------------------


@query(
    f"""with {feeds.FAULTY_SQL}
    select symbol, price, quantity, is_buyer_maker, trade_timestamp, ingest_timestamp,
           cast(trade_timestamp as date) as trade_day from kept"""
)
def reload_idempotent(spark, sf_dir):
    """The same days loaded twice stand once."""
    path = scratch(spark, "reload")
    rows = layers.silver(feeds.faulty_trades(spark, sf_dir)).select(
        *fv.LOAD_COLUMNS, F.to_date("trade_timestamp").alias("trade_day")
    )
    reload_slices(rows, path, ["trade_day"])
    reload_slices(rows, path, ["trade_day"])
    return parquet_tree(spark, path)


@query(
    f"""with {feeds.FAULTY_SQL}
    select symbol, price, quantity, is_buyer_maker, trade_timestamp, ingest_timestamp,
           cast(trade_timestamp as date) as trade_day
    from kept where cast(trade_timestamp as date) = date '{feeds.RUN_DAY}'"""
)
def load_day(spark, sf_dir):
    """Stored silver, one day of it copied to the history; another is loaded, then emptied."""
    silver_path, history = scratch(spark, "silver"), scratch(spark, "history")
    clean = layers.silver(feeds.faulty_trades(spark, sf_dir).drop("event_id"))
    reload_slices(clean, silver_path, fv.SILVER_PARTITIONS)
    emptied = feeds.RUN_DAY + dt.timedelta(days=1)
    for _ in range(2):
        load_trade_history(spark, silver_path, history, feeds.RUN_DAY)
        load_trade_history(spark, silver_path, history, emptied)
    discard(spark, f"{silver_path}/{day_folder(emptied)}")
    load_trade_history(spark, silver_path, history, emptied)
    return parquet_tree(spark, history)


# --- sentiment --------------------------------------------------------------


@query(f"with {feeds.SENTIMENT_SQL} select date, fng_value, fng_classification from sentiment")
def sentiment_parse(spark, sf_dir):
    return _landed_readings(spark, sf_dir).drop("landed_at")


def _landed_readings(spark, sf_dir):
    """One landed reply per day; each lists the day before as a second element."""
    path = scratch(spark, "replies")

    def element(days_back, shift):
        seconds = F.unix_seconds(F.col("date").cast("timestamp")) - days_back * 86400
        return F.struct(
            (F.col("fng_value") + shift).cast("string").alias("value"),
            F.col("fng_classification").alias("value_classification"),
            seconds.cast("string").alias("timestamp"),
        )

    reply = F.to_json(F.struct(F.array(element(0, 0), element(1, 7)).alias("data")))
    feeds.sentiment(spark, sf_dir).select(reply.alias("value")).write.text(path)
    return newest_readings(index_replies(spark, path, one_per_line=True))


@query(
    f"""with {feeds.SENTIMENT_SQL}
    select date, fng_value, fng_classification, {feeds.AS_OF_SQL} as updated_at from sentiment"""
)
def sentiment_load(spark, sf_dir):
    """The same replies loaded twice: the second load finds every day and stamps it."""
    readings = _landed_readings(spark, sf_dir)
    path, staging = scratch(spark, "sentiment"), scratch(spark, "staging")
    stamped = F.lit(feeds.AS_OF).cast("timestamp")
    for _ in range(2):
        load_sentiment(spark, readings, path, staging, now=stamped)
    return spark.read.schema(schemas.SENTIMENT).parquet(path)


@query(ORACLES["sentiment_load"])
def sentiment_load_merged(spark, sf_dir):
    """The same two loads into a table that is merged when read."""
    readings, path = _landed_readings(spark, sf_dir), scratch(spark, "sentiment")
    stamped = F.lit(feeds.AS_OF).cast("timestamp")
    for run in ("first", "second"):
        found = merge_sentiment(spark, readings, path, run, now=stamped)
    return found


@query(
    f"""with {feeds.SENTIMENT_SQL},
    updates as (select date + 25 as date, fng_value + 1 as fng_value, fng_classification
                from sentiment)
    select date, coalesce(u.fng_value, s.fng_value) as fng_value,
           coalesce(u.fng_classification, s.fng_classification) as fng_classification,
           case when u.date is not null and s.date is not null then {feeds.AS_OF_SQL} end
               as updated_at
    from sentiment s full join updates u using (date)"""
)
def sentiment_upsert(spark, sf_dir):
    """All readings again 25 days later and one higher, each preceded by a draft."""
    stored = feeds.sentiment(spark, sf_dir)
    target = stored.withColumn("updated_at", F.lit(None).cast("timestamp"))
    updates = stored.select(
        F.date_add("date", 25).alias("date"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("version"),
        (F.col("fng_value") - 99).alias("draft"),
        (F.col("fng_value") + 1).alias("final"),
        "fng_classification",
    ).withColumn("fng_value", F.when(F.col("version") == 1, F.col("final")).otherwise(F.col("draft")))
    stamped = F.lit(feeds.AS_OF).cast("timestamp")
    return upsert(target, updates, ["date"], [F.desc("version")], now=stamped)


# --- streams ----------------------------------------------------------------


@query(BRONZE_SQL)
def bronze_stream(spark, sf_dir):
    path = scratch(spark, "bronze")
    drains.drain_bronze(feeds.records(spark, sf_dir, streaming=True), path, path + "-checkpoint")
    return parquet_tree(spark, path, schemas.BRONZE)


@query(
    f"""with {feeds.FAULTY_SQL} select {SILVER_COLUMNS.replace('ingest_timestamp,', '')},
    cast(year(trade_timestamp) as integer) as year, cast(month(trade_timestamp) as integer) as month,
    cast(day(trade_timestamp) as integer) as day from kept"""
)
def silver_stream(spark, sf_dir):
    """Streamed dedup keeps whichever copy came first, so its ingest time is left out."""
    path = scratch(spark, "silver")
    feed = feeds.faulty_trades(spark, sf_dir, streaming=True).drop("event_id")
    drains.drain_silver(feed, path, path + "-checkpoint")
    return parquet_tree(spark, path, schemas.SILVER).drop("ingest_timestamp", "processed_at")


@query(ORACLES["silver_stream"])
def silver_stream_by_table(spark, sf_dir):
    """The same drain, its copies told by a table of seen keys instead of operator state."""
    path = scratch(spark, "silver")
    feed = feeds.faulty_trades(spark, sf_dir, streaming=True).drop("event_id")
    drains.drain_silver_by_table(feed, path, path + "-checkpoint")
    return parquet_tree(spark, path, schemas.SILVER).drop("ingest_timestamp", "processed_at")


# A streamed candle is final once the watermark, ten minutes behind the newest trade,
# has passed its end.
FINAL = """where candle_start_time + interval 1 minute
    <= (select max(trade_timestamp) from {source}) - interval 10 minutes"""
STREAMED_SQL = f"{BASE} select {CANDLE_COLUMNS} from candles {FINAL.format(source='trades')}"


@query(STREAMED_SQL)
def candles_stream(spark, sf_dir):
    path = scratch(spark, "candles")
    feed = feeds.timed_trades(spark, sf_dir, streaming=True)
    fresh = layers.gold(feed, trade_id="event_id").withColumn(
        CANDLE_DAY, F.to_date("candle_start_time")
    )
    gathered = spread_writers(fresh, [CANDLE_DAY], 4)
    drains.append_parquet(gathered, path, path + "-checkpoint", [CANDLE_DAY]).awaitTermination()
    return candle_table(spark, path).drop("ingested_at", CANDLE_DAY)


@query(STREAMED_SQL)
def candles_foreach_upsert(spark, sf_dir):
    """The feed drained twice, with fresh checkpoints, into one keyed table."""
    path = scratch(spark, "candles")
    for attempt in ("first", "second"):
        feed = feeds.timed_trades(spark, sf_dir, streaming=True)
        drains.drain_gold(feed, path, f"{path}-{attempt}", trade_id="event_id")
    return candle_table(spark, path).drop("ingested_at", CANDLE_DAY)


LAYERS_SQL = f"""with {feeds.RECORDS_SQL},
    kept as (
        select distinct symbol, price, quantity, is_buyer_maker, timestamp as trade_timestamp, 0 as event_id
        from decoded where price > 0 and quantity > 0),
    {feeds.candles_sql('candles', 'kept')}
    select {CANDLE_COLUMNS} from candles"""


@query(LAYERS_SQL)
def layers_backfill(spark, sf_dir):
    """The same three layers in batch, where every candle is final."""
    paths = backfill(spark, feeds.records(spark, sf_dir), scratch(spark, "layers"))
    return candle_table(spark, paths["candles"]).drop("ingested_at", CANDLE_DAY)


@query(f"{LAYERS_SQL} {FINAL.format(source='kept')}")
def layers_run(spark, sf_dir):
    """Messages through bronze and silver files to the candle table, three drains."""
    root = scratch(spark, "layers")
    drained = drains.run_layers(spark, feeds.records(spark, sf_dir, streaming=True), root)
    return candle_table(spark, drained.paths["candles"]).drop("ingested_at", CANDLE_DAY)


@query(LAYERS_SQL)
def layers_run_bounded(spark, sf_dir):
    """The backlog worked off day by day."""
    root = scratch(spark, "layers")
    paths = backfill(spark, feeds.records(spark, sf_dir), root, days_at_once=7)
    return candle_table(spark, paths["candles"]).drop("ingested_at", CANDLE_DAY)


@query(f"{LAYERS_SQL} {FINAL.format(source='kept')}")
def layers_continued(spark, sf_dir):
    """The first half of the feed in batch, then a stream of the rest and some of it again."""
    root, time = scratch(spark, "layers"), F.col("trade_time")
    feed = feeds.trades(spark, sf_dir)
    low, high = feed.agg(F.min(time), F.max(time)).first()
    seam = (low + high) // 2
    backfill(spark, feeds.records_of(feed.filter(time < seam)), root)
    rest = feeds.trades(spark, sf_dir, streaming=True).filter(time >= seam - 86_400_000)
    drained = drains.run_layers(spark, feeds.records_of(rest), root)
    return candle_table(spark, drained.paths["candles"]).drop("ingested_at", CANDLE_DAY)


@query(f"{LAYERS_SQL} {FINAL.format(source='kept')}")
def layers_from_text(spark, sf_dir):
    """Envelopes landed as lines of text and read as a stream of messages."""
    landed, root = scratch(spark, "landed"), scratch(spark, "layers")
    feeds.records(spark, sf_dir).select("value").write.text(landed)
    drained = drains.run_layers(spark, text_messages(spark, landed, streaming=True), root)
    return candle_table(spark, drained.paths["candles"]).drop("ingested_at", CANDLE_DAY)


@query(f"{LAYERS_SQL} {FINAL.format(source='kept')}")
def late_restated(spark, sf_dir):
    """A tenth of the messages comes after the watermark has passed them, and is dropped by
    the streams; the restatement puts it in."""
    landed, root = scratch(spark, "landed"), scratch(spark, "layers")
    place = F.pmod(F.xxhash64("value"), F.lit(10))
    messages = feeds.records(spark, sf_dir)
    for some in (place > 0, place == 0):
        messages.filter(some).select("value").write.mode("append").text(landed)
        drained = drains.run_layers(spark, text_messages(spark, landed, streaming=True), root)
    restate(spark, drained.paths, scratch(spark, "late"))
    return candle_table(spark, drained.paths["candles"]).drop("ingested_at", CANDLE_DAY)


@query(STREAMED_SQL)
def candles_warehouse(spark, sf_dir):
    """The feed drained twice into an append-only table that takes absent candles only."""
    path = scratch(spark, "warehouse")

    def append(batch):
        if exists(spark, path):
            stored = spark.read.schema(schemas.CANDLE).parquet(path)
            batch = absent_by_key(batch, stored, drains.CANDLE_KEYS)
        batch.write.mode("append").parquet(path)

    for attempt in ("first", "second"):
        feed = feeds.timed_trades(spark, sf_dir, streaming=True)
        drains.drain_warehouse(feed, append, f"{path}-{attempt}", trade_id="event_id")
    return spark.read.schema(schemas.CANDLE).parquet(path).drop("ingested_at")
