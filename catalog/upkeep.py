"""Queries on tables of versioned parts: swaps, compaction, marts kept up by change."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import feeds, storage  # noqa: F401  (registration)
from catalog.layers import CANDLE_COLUMNS, candles
from catalog.marts import BASE
from catalog.registry import ORACLES, query
from tapeworks import fixed_values as fv
from tapeworks import schemas
from tapeworks.functions.moments import as_moment
from tapeworks.operators.dedup import first_row_per_key
from tapeworks.plans import mart_changes, quarantine
from tapeworks.plans.layers import bronze
from tapeworks.schemas import CANDLE_DAY
from tapeworks.session import scratch
from tapeworks.sinks import merging, skipping, snapshots
from tapeworks.sinks.files import write_run
from tapeworks.sources.files import parquet_tree


_COUNTS = ("total_volume", "trade_count")


def _draft(fact, by=1, columns=(*_COUNTS, "close_price", "high_price")):
    """The same candles with other numbers."""
    return fact.withColumns({c: F.col(c) + by for c in columns})


@query(f"{BASE} select {CANDLE_COLUMNS}, 2 as version from candles union all select {CANDLE_COLUMNS}, 1 from candles")
def snapshot_swap(spark, sf_dir):
    """A table published twice, with a writer in between that ended before its switch.

    Both versions are whole: the first is read by the reader that had taken it, after the
    swap, and held a correction that is undone here.
    """
    path = scratch(spark, "swapped")
    fact = candles(spark, sf_dir).drop("ingested_at").withColumn(CANDLE_DAY, F.to_date("candle_start_time"))
    taken = snapshots.replace(_draft(fact, 1, _COUNTS), path, CANDLE_DAY)
    snapshots.stage(_draft(fact, 2), path, CANDLE_DAY)
    snapshots.replace(fact, path, CANDLE_DAY)
    new = snapshots.read(spark, snapshots.current(spark, path))
    old = snapshots.read(spark, snapshots.load(spark, path, taken.version))
    undone = _draft(old, -1, _COUNTS)
    return (
        new.withColumn("version", F.lit(2))
        .unionByName(undone.withColumn("version", F.lit(1)))
        .drop(CANDLE_DAY)
    )


@query(
    f"""with {feeds.TRADES_SQL}
    select event_id, symbol, price, quantity, trade_time, cast(1 as bigint) as times_read,
           cast(1 as bigint) as times_stored
    from trades"""
)
def compacted_runs(spark, sf_dir):
    """Trades appended in runs, each delivered twice, compacted while a reader follows."""
    path = scratch(spark, "runs")
    every = feeds.trades(spark, sf_dir).withColumn(
        "trade_day", F.to_date(F.timestamp_millis("trade_time"))
    )
    followed, seen = None, 0
    for number in range(9):
        run = every.filter(F.col("event_id") % 9 == number)
        for _ in range(2):
            snapshots.append(run, path, "trade_day", f"run-{number}")
        if number % 2:
            snapshot = snapshots.current(spark, path)
            more = snapshots.since(spark, snapshot, seen)
            followed = followed.unionByName(more) if followed else more
            seen = len(snapshot.runs)
        snapshots.compact(spark, path, fan_in=3)
    last = snapshots.current(spark, path)
    followed = followed.unionByName(snapshots.since(spark, last, seen))
    columns = ["event_id", "symbol", "price", "quantity", "trade_time"]
    read = followed.groupBy(*columns).agg(F.count("*").alias("times_read"))
    stored = snapshots.read(spark, last).groupBy(*columns).agg(F.count("*").alias("times_stored"))
    return read.join(stored, columns, "full")


def _changed(spark, sf_dir):
    """The marts after three change sets: drafts and some days, the other days, corrections."""
    root, path = scratch(spark, "kept-marts"), scratch(spark, "candle-snapshots")
    fact = candles(spark, sf_dir)
    day, minute = F.dayofyear("candle_start_time"), F.minute("candle_start_time")
    late, drafted = day % 3 == 2, minute % 7 == 0
    early = fact.filter(~late)
    sets = (
        _draft(early.filter(drafted)).unionByName(early.filter(~drafted)),
        fact.filter(late),
        early.filter(drafted),
    )
    for changes in sets:
        mart_changes.put_candles(changes, path)
        mart_changes.refresh(spark, path, root)
    return mart_changes.marts(
        spark, path, root, feeds.sentiment(spark, sf_dir), feeds.AS_OF, symbol="purchase"
    )


@query(ORACLES["pipeline_health"])
def marts_incremental(spark, sf_dir):
    """Pipeline health from hours of which only changed days were folded again."""
    return _changed(spark, sf_dir)["pipeline_health"]


@query(ORACLES["ohlc_summary"])
def summary_incremental(spark, sf_dir):
    return _changed(spark, sf_dir)["ohlc_summary"]


@query(ORACLES["price_vs_sentiment"])
def prices_incremental(spark, sf_dir):
    found = _changed(spark, sf_dir)["price_vs_sentiment"]
    return found.withColumn("avg_price", F.round("avg_price", 8))


@query(ORACLES["market_overview"])
def overview_incremental(spark, sf_dir):
    return _changed(spark, sf_dir)["market_overview"]


def _faulty(spark, sf_dir):
    """The feed's messages; where k is 17 the quantity has a unit and so is text."""
    units = F.regexp_replace("value", '"quantity":17.0', '"quantity":"17.0 lots"')
    return feeds.records(spark, sf_dir).withColumn("value", units)


@query(
    f"""with {feeds.TRADES_SQL}
    select reason, cast(count(*) as bigint) as messages
    from (select case when quantity = 13 then 'no JSON object' else 'wrong type: quantity' end as reason
          from trades where quantity in (13, 17)) group by reason"""
)
def quarantine_listed(spark, sf_dir):
    """Why messages went to the dead letters, which hold their text."""
    path = scratch(spark, "letters")
    for _ in range(2):
        quarantine.quarantine(_faulty(spark, sf_dir), path, "first")
    letters = snapshots.read(spark, snapshots.current(spark, path))
    return letters.groupBy("reason").agg(F.sum("copies").alias("messages"))


@query(
    f"""with {feeds.TRADES_SQL}
    select source, symbol, price, quantity, trade_time, is_buyer_maker, ingested_at
    from trades where quantity <> 13"""
)
def quarantine_replay(spark, sf_dir):
    """Bronze after the dead letters were mended, replayed twice: each message once."""
    path, target = scratch(spark, "letters"), scratch(spark, "bronze")
    messages = _faulty(spark, sf_dir)
    quarantine.quarantine(messages, path, "first")
    write_run(bronze(quarantine.sound(messages)), target, fv.BRONZE_PARTITIONS)
    for _ in range(2):
        quarantine.replay(
            spark, path, lambda text: F.regexp_replace(text, '"([0-9.]+) lots"', "$1"), target, "lots"
        )
    return parquet_tree(spark, target, schemas.TRADE)


def _readings(spark, sf_dir):
    """Readings, and all again 25 days later and one higher, each preceded by a draft."""
    stored = feeds.sentiment(spark, sf_dir)
    updates = stored.select(
        F.date_add("date", 25).alias("date"),
        F.posexplode(F.array(F.col("fng_value") - 99, F.col("fng_value") + 1)).alias("version", "fng_value"),
        "fng_classification",
    )
    return stored.withColumn("updated_at", F.lit(None).cast("timestamp")), updates


@query(ORACLES["sentiment_upsert"])
def sentiment_merged(spark, sf_dir):
    """The upsert in three loads, each twice, all still open as deltas when it is read."""
    path = scratch(spark, "readings")
    stored, updates = _readings(spark, sf_dir)
    merging.create(stored, path, ["date"])
    for third in range(3):
        some = updates.filter(F.dayofyear("date") % 3 == third)
        for _ in range(2):
            snapshot = merging.put(
                some, path, [F.desc("version")], f"load-{third}", as_moment(feeds.AS_OF), share=9.0
            )
    return merging.read(spark, snapshot)


@query(f"{BASE} select {CANDLE_COLUMNS} from candles")
def candles_merged(spark, sf_dir):
    """Drafts of most candles corrected and the others added, in loads of unequal size,
    which are folded into the base as they outgrow their share of it."""
    path = scratch(spark, "merged")
    fact = candles(spark, sf_dir).drop("ingested_at")
    minute = F.minute("candle_start_time")
    drafts = _draft(fact.filter(minute >= 6)).withColumn("updated_at", F.lit(None).cast("timestamp"))
    merging.create(drafts, path, ["symbol", "candle_start_time"])
    for low, high in ((0, 5), (6, 8), (9, 10), (11, 59)):
        some = fact.filter(minute.between(low, high))
        snapshot = merging.put(some, path, [F.desc("trade_count")], f"to-{high}", as_moment(feeds.AS_OF))
    return merging.read(spark, snapshot).drop("updated_at")


# Some days and hours of one symbol.
_FROM, _TO = dt.datetime(2024, 1, 14, 6), dt.datetime(2024, 1, 17, 17, 59)


@query(
    f"""{BASE} select {CANDLE_COLUMNS} from candles where symbol = 'PURCHASE'
    and candle_start_time between timestamp '{_FROM}' and timestamp '{_TO}'"""
)
def symbol_hours(spark, sf_dir):
    """Some days of a symbol, of candles clustered by symbol and time: the files that may
    hold them are told by statistics."""
    path = scratch(spark, "clustered")
    candles(spark, sf_dir).drop("ingested_at").write.parquet(f"{path}/incoming")
    fact = spark.read.parquet(f"{path}/incoming")
    kept = skipping.put(fact, path, ["symbol", "candle_start_time"], rows_per_file=1000)
    asked = {
        "symbol": skipping.OneOf("PURCHASE"),
        "candle_start_time": skipping.Between(_FROM, _TO),
    }
    return skipping.scan(spark, kept, asked)


@query(
    f"""with {feeds.TRADES_SQL}
    select event_id, symbol, price, quantity, trade_time from trades
    qualify row_number() over (partition by symbol order by price desc nulls last, event_id desc) = 1"""
)
def trades_looked_up(spark, sf_dir):
    """The dearest trade of each symbol, looked up by its id through the files' filters."""
    path = scratch(spark, "looked-up")
    trades = feeds.trades(spark, sf_dir)
    kept = skipping.put(
        trades, path, ["symbol", "trade_time"], lookup=["event_id"], rows_per_file=1000
    )
    dearest = first_row_per_key(trades, ["symbol"], F.desc_nulls_last("price"), F.desc("event_id"))
    ids = [row["event_id"] for row in dearest.select("event_id").collect()]  # one per symbol
    found = skipping.scan(spark, kept, {"event_id": skipping.OneOf(*ids)})
    return found.select("event_id", "symbol", "price", "quantity", "trade_time")
