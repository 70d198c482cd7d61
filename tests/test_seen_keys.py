"""Dedup by a table of seen keys: equal to the stateful dedup, also when delivered again."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.operators.dedup import distinct_trades
from tapeworks.sinks import snapshots
from tapeworks.sources.files import candle_table, parquet_stream, parquet_tree
from tapeworks.streaming import drains
from tapeworks.streaming.seen_keys import SeenKeys
from tests.helpers import RECORD, at, plan, records, rows

KEYS = ["symbol", "trade_timestamp"]
KIND = "symbol string, trade_timestamp timestamp, ingest_timestamp timestamp, price double"
LATENESS = dt.timedelta(minutes=10)


def batch(spark, *given):
    return spark.createDataFrame([(s, t, at("23:00:00"), 1.0) for s, t in given], KIND)


def plain(batches):
    """What dropDuplicates behind a watermark lets pass of each batch."""
    seen, newest, found = set(), None, []
    for given in batches:
        mark = newest - LATENESS if newest else None
        timely = {(s, t) for s, t in given if mark is None or t is None or t > mark}
        found.append((timely - seen, len({(s, t) for s, t in given if mark and t is not None and t <= mark})))
        seen |= timely
        newest = max([t for _, t in given if t is not None] + ([newest] if newest else []), default=None)
    return found


def drawn(seed):
    """Batches that overlap, go back in time, repeat one row often, or are empty."""
    draw = random.Random(seed)
    batches = []
    for number in range(6):
        span = range(number * 240, number * 240 + 900, 20)
        some = [
            (draw.choice(["A", "B", None]), at("10:00:00") + dt.timedelta(seconds=draw.choice(span)))
            for _ in range(draw.choice([0, 60, 90]) if number else 80)
        ]
        batches.append(some + [("HOT", at("10:09:00"))] * 40 + [("A", None)] * draw.randint(0, 2))
    batches.insert(3, [])
    return batches


@pytest.mark.parametrize("seed", [1, 2])
def test_each_key_passes_once(spark, path, seed):
    batches = drawn(seed)
    for number, (given, (expected, late)) in enumerate(zip(batches, plain(batches))):
        store = SeenKeys(spark, path, KEYS)  # anew, as after a restart
        run = f"batch-{number}"
        df = batch(spark, *given)
        if number % 3 == 1:  # stopped before its keys were stored
            store.admit(df, run)
        for _ in range(2 if number % 2 else 1):  # stopped before the stream took note
            passed, dropped = store.admit(df, run)
            found = [tuple(r) for r in passed.select(*KEYS).collect()]
            assert len(found) == len(set(found)) and (set(found), dropped) == (expected, late), number
            store.record(passed, run)


def test_slices_behind_the_watermark_leave_the_table(spark, path):
    store = SeenKeys(spark, path, KEYS, slice_ms=60_000)
    most = 0
    for minute in range(0, 50, 5):
        given = [("A", at("10:00:00") + dt.timedelta(minutes=minute, seconds=s)) for s in range(0, 300, 10)]
        passed, _ = store.admit(batch(spark, *given), f"run-{minute}")
        kept = store.record(passed, f"run-{minute}")
        most = max(most, snapshots.read(spark, kept).count())
    # Ten minutes and two micro-batches of six rows a minute, and the slices they end in.
    assert 60 <= most <= 6 * 22
    assert len(kept.slices) <= 22 and len(snapshots.versions(spark, path)) <= 3


def test_a_hot_key_is_limited_before_the_shuffle(spark, path):
    store = SeenKeys(spark, path, KEYS)
    store.record(store.admit(batch(spark, ("A", at("10:00:00"))), "one")[0], "one")
    hot = spark.range(0, 4000, 1, 8).select(
        F.when(F.col("id") >= 0, "HOT").alias("symbol"),
        F.when(F.col("id") >= 0, F.lit(at("10:05:00"))).alias("trade_timestamp"),
        F.timestamp_seconds("id").alias("ingest_timestamp"), F.lit("x").alias("source"),
    )
    passed, late = store.admit(hot, "two")
    assert (passed.count(), late) == (1, 0)
    shape = plan(distinct_trades(hot, KEYS))
    assert "WindowGroupLimit" in shape.split("Exchange")[1]


def test_the_moment_has_to_be_a_key(spark, path):
    with pytest.raises(ValueError):
        SeenKeys(spark, path, ["symbol"])


def test_the_drain_equals_the_stateful_one(spark, tmp_path):
    source = str(tmp_path / "in")
    stored = {}
    drained = {"state": drains.drain_silver, "table": drains.drain_silver_by_table}
    parts = [
        [("A", 1.0, 1.0, at("10:30:00"), True)] * 5 + [("B", 1.0, 1.0, at("10:30:00"), True)],
        [("A", 1.0, 1.0, at("10:30:00"), True), ("A", 2.0, 1.0, at("10:19:00"), True), ("A", 3.0, 1.0, at("10:21:00"), None)],
        [("A", 3.0, 1.0, at("10:21:00"), None), ("C", -1.0, 1.0, at("11:00:00"), True), ("C", 4.0, 1.0, at("11:00:00"), False)],
    ]
    lost = {}
    for number, part in enumerate(parts):
        records(spark, *part).coalesce(1).write.mode("append").parquet(source)
        for name, drain in drained.items():
            stream = parquet_stream(spark, source, RECORD)
            out = str(tmp_path / name)
            lost[name] = lost.get(name, 0) + drain(stream, out, f"{out}-mark", files_per_day=2)
    for name in drained:
        stored[name] = rows(
            parquet_tree(spark, str(tmp_path / name), schemas.SILVER).drop("processed_at", "ingest_timestamp")
        )
    assert stored["state"] == stored["table"] and len(stored["table"]) == 4
    assert lost == {"state": 1, "table": 1}
    with pytest.raises(RuntimeError):
        records(spark, ("A", 9.0, 1.0, at("08:00:00"), True)).coalesce(1).write.mode("append").parquet(source)
        stream = parquet_stream(spark, source, RECORD)
        drains.drain_silver_by_table(
            stream, str(tmp_path / "table"), str(tmp_path / "table-mark"), fail_on_dropped=True
        )


def test_layers_by_table_equal_layers_by_state(spark, tmp_path):
    lines = [
        f'{{"source":"f","symbol":"A","price":{p},"quantity":1.0,"trade_time":{t},"is_buyer_maker":true}}'
        for p, t in [(1.0, 60_000), (1.0, 60_000), (2.0, 61_000), (1.0, 60_000), (3.0, 7_200_000)]
    ]
    source = str(tmp_path / "in")
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(source)
    found = {}
    for by_table in (False, True):
        messages = spark.readStream.schema("value string").text(source)
        done = drains.run_layers(spark, messages, str(tmp_path / str(by_table)), by_table=by_table)
        silver = parquet_tree(spark, done.paths["silver"], schemas.SILVER)
        kept = candle_table(spark, done.paths["candles"]).drop("ingested_at")
        found[by_table] = rows(silver.select("price", "trade_timestamp")), rows(kept), done.dropped
    assert found[True] == found[False] and len(found[True][0]) == 3 and found[True][1]
