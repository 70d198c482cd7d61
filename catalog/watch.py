"""Queries that watch: freshness by timers, and checks made by the writes themselves."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import feeds, storage  # noqa: F401  (registration)
from catalog.layers import candles
from catalog.marts import BASE, HEALTH
from catalog.registry import ORACLES, query
from tapeworks.functions.moments import as_moment
from tapeworks.plans.marts import MART_KEYS, marts, write_checked_marts
from tapeworks.session import scratch
from tapeworks.sources.files import parquet_stream
from tapeworks.streaming.drains import append_parquet
from tapeworks.streaming.freshness import freshness_changes

_HALF = dt.datetime(2024, 1, 16)


def _watched(spark, sf_dir):
    """Changes of all candles, which come in two halves; at the end the clock says AS_OF.

    The second drain goes on from the state and timers of the first.
    """
    path, clock, out = (scratch(spark, name) for name in ("candles", "clock", "changes"))
    fact = candles(spark, sf_dir).select("symbol", "candle_start_time")
    before = F.col("candle_start_time") < as_moment(_HALF)
    lateness = dt.timedelta(minutes=10)
    for half, now in ((before, _HALF), (~before, feeds.AS_OF)):
        fact.filter(half).write.mode("append").parquet(path)
        tick = spark.range(1).select(as_moment(now + lateness).alias("moment"))
        tick.write.mode("append").parquet(clock)
        changes = freshness_changes(
            parquet_stream(spark, path, "symbol string, candle_start_time timestamp"),
            parquet_stream(spark, clock, "moment timestamp"),
            lateness="10 minutes",
        )
        append_parquet(changes, out, out + "-checkpoint", []).awaitTermination()
    return spark.read.parquet(out)


@query(
    f"""{BASE},
    neighbours as (
        select symbol, candle_start_time as t,
               lag(candle_start_time) over of_symbol as before,
               lead(candle_start_time) over of_symbol as next
        from candles window of_symbol as (partition by symbol order by candle_start_time)),
    changes as (
        select symbol, t as changed_at, 'Fresh ✅' as freshness_status, t as latest_candle_time
        from neighbours where before is null or t - before > interval 5 minutes
        union all
        select symbol, t + interval 300001 milliseconds, 'Stale ⚠️', t
        from neighbours where next is null or next - t > interval 5 minutes
        union all
        select symbol, t + interval 1800001 milliseconds, 'Dead ❌', t
        from neighbours where next is null or next - t > interval 30 minutes)
    select * from changes where changed_at <= {feeds.AS_OF_SQL}"""
)
def freshness_alerts(spark, sf_dir):
    """Every change of a symbol's freshness, from state and timers instead of a scan."""
    return _watched(spark, sf_dir)


@query(f"{HEALTH} select symbol, latest_candle_time, freshness_status from fresh")
def freshness_watched(spark, sf_dir):
    """The state after the last change of each symbol, which is what ``freshness`` finds."""
    last = F.max_by(F.struct("latest_candle_time", "freshness_status"), "changed_at")
    found = _watched(spark, sf_dir).groupBy("symbol").agg(last.alias("last"))
    return found.select("symbol", "last.*")


def _keyless(name, mart):
    """The mart's rows twice, and once more without their key."""
    key, _ = MART_KEYS[name]
    lost = mart.withColumn(key, F.lit(None).cast(mart.schema[key].dataType))
    return mart.unionByName(mart).unionByName(lost)


@query(ORACLES["mart_checks"])
def checks_while_writing(spark, sf_dir):
    """The verdicts of ``mart_checks`` on the same faulty marts, found by their writes."""
    fact = scratch(spark, "candles")
    candles(spark, sf_dir).write.parquet(fact)
    built = marts(
        spark.read.parquet(fact), feeds.sentiment(spark, sf_dir), feeds.AS_OF, symbol="purchase"
    )
    faulty = {name: _keyless(name, mart) for name, mart in built.items()}
    return write_checked_marts(faulty, scratch(spark, "marts"))
