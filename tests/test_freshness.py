"""Freshness by timers: every change once, by event time and by the clock."""

import datetime as dt
import time

from pyspark.sql import functions as F

from tapeworks import fixed_values as fv
from tapeworks.plans.pipeline_health import freshness
from tapeworks.streaming.drains import append_parquet
from tapeworks.streaming.freshness import freshness_changes, live_freshness_changes
from tests.helpers import at, rows
from tests.test_streaming import Feed

FRESH, STALE, DEAD = fv.STATUS_FRESH, fv.STATUS_STALE, fv.STATUS_DEAD
CANDLE = "symbol string, candle_start_time timestamp"
MS = dt.timedelta(milliseconds=1)


def drained(spark, feed, ticks, out, lateness="0 seconds"):
    changes = freshness_changes(feed.stream(), ticks.stream(), lateness)
    append_parquet(changes, out, out + "-mark", [], partitions=2).awaitTermination()
    return rows(spark.read.parquet(out))


def feeds(spark, tmp_path):
    ticks = Feed(spark, str(tmp_path / "ticks"), "moment timestamp")
    return Feed(spark, str(tmp_path / "in"), CANDLE), ticks


def made(spark, *pairs):
    return spark.createDataFrame([(s, None if c is None else at(c)) for s, c in pairs], CANDLE)


def tick(spark, clock):
    return spark.createDataFrame([(at(clock),)], "moment timestamp")


def test_changes_come_once_whatever_the_batches(spark, tmp_path):
    feed, ticks = feeds(spark, tmp_path)
    out = str(tmp_path / "out")
    # Out of order, repeated, without a time and without a symbol.
    feed.add(made(spark, ("A", "10:06:00"), ("A", "10:00:00"), ("A", "10:06:00"), ("A", None)))
    feed.add(made(spark, (None, "10:02:00"), ("B", "10:00:00"), ("B", "10:05:00")))
    ticks.add(tick(spark, "10:08:00"))
    first = [
        ("A", at("10:00:00"), FRESH, at("10:00:00")),
        ("A", at("10:05:00") + MS, STALE, at("10:00:00")),
        ("A", at("10:06:00"), FRESH, at("10:06:00")),
        ("B", at("10:00:00"), FRESH, at("10:00:00")),
        (None, at("10:02:00"), FRESH, at("10:02:00")),
        (None, at("10:07:00") + MS, STALE, at("10:02:00")),
    ]
    key = lambda r: (str(r[0]), r[1])
    assert sorted(drained(spark, feed, ticks, out), key=key) == sorted(first, key=key)
    # Nothing but the tick: the feed is silent, and the timers fire.
    ticks.add(tick(spark, "10:36:00"))
    second = [
        *first,
        ("A", at("10:11:00") + MS, STALE, at("10:06:00")),
        ("B", at("10:10:00") + MS, STALE, at("10:05:00")),
        ("B", at("10:35:00") + MS, DEAD, at("10:05:00")),
        (None, at("10:32:00") + MS, DEAD, at("10:02:00")),
    ]
    assert sorted(drained(spark, feed, ticks, out), key=key) == sorted(second, key=key)
    # At 10:36:00 A is exactly 30 minutes old, which still counts as stale.
    stood = made(spark, ("A", "10:06:00"), ("B", "10:05:00"), (None, "10:02:00")).withColumn(
        "ingested_at", F.col("candle_start_time")
    )
    last = {s: label for s, _, label, _ in sorted(second, key=lambda r: r[1])}
    told = freshness(stood, at("10:36:00")).select("symbol", "freshness_status")
    assert {r[0]: r[1] for r in told.collect()} == last


def test_candles_within_the_lateness_fill_gaps(spark, tmp_path):
    feed, ticks = feeds(spark, tmp_path)
    out = str(tmp_path / "out")
    feed.add(made(spark, ("A", "10:00:00"), ("A", "10:09:00")))
    ticks.add(tick(spark, "10:12:00"))
    assert drained(spark, feed, ticks, out, "10 minutes") == [
        ("A", at("10:00:00"), FRESH, at("10:00:00"))
    ]
    feed.add(made(spark, ("A", "10:04:00"), ("A", "10:01:00")))
    ticks.add(tick(spark, "10:24:00"))
    # 10:04 closes the gap; 10:01 is behind the watermark and changes nothing.
    assert drained(spark, feed, ticks, out, "10 minutes") == [
        ("A", at("10:00:00"), FRESH, at("10:00:00"))
    ]
    ticks.add(tick(spark, "10:25:00"))
    assert len(drained(spark, feed, ticks, out, "10 minutes")) == 2


def test_the_clock_finds_a_silent_feed(spark, tmp_path):
    feed, out = Feed(spark, str(tmp_path / "in"), CANDLE), str(tmp_path / "out")
    newest = spark.range(1).select(
        F.lit("A").alias("symbol"), F.current_timestamp().alias("candle_start_time")
    )
    feed.add(newest)
    changes = live_freshness_changes(feed.stream(), fresh=0.1, stale=0.2)
    query = append_parquet(
        changes, out, out + "-mark", [], trigger={"processingTime": "1 second"}, partitions=2
    )
    try:
        deadline = time.monotonic() + 60
        while time.monotonic() < deadline and query.isActive:
            found = spark.read.schema("freshness_status string, changed_at timestamp").parquet(out)
            if found.filter(F.col("freshness_status") == DEAD).count():
                break
            time.sleep(1)
    finally:
        query.stop()
    seen = [r[0] for r in spark.read.parquet(out).orderBy("changed_at").select("freshness_status").collect()]
    assert seen[-1] == DEAD and seen == [s for s in (FRESH, STALE, DEAD) if s in seen]
    assert STALE in seen
