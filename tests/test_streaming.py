"""Drains: late rows, repeated rows, restarts, failing and replayed sinks."""

import itertools

import pytest
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.operators.dedup import collapsed_batches, distinct_trades_stream
from tapeworks.plans import layers
from tapeworks.plans.backfill import backfill
from tapeworks.sinks import keyed
from tapeworks.sinks.keyed import replace_by_key
from tapeworks.sources.files import candle_table, parquet_stream, parquet_tree
from tapeworks.sources.messages import text_messages
from tapeworks.storage import discard
from tapeworks.streaming import drains
from tests.helpers import RECORD, at, candle, candles, records, rows, trades

TRADE = "symbol string, price double, quantity double, trade_timestamp timestamp, is_buyer_maker boolean"


class Feed:
    """A folder that is filled between drains."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, schema

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self, **options):
        return parquet_stream(self.spark, self.path, self.schema, **options)


def trade_feed(spark, path, *clocks):
    feed = Feed(spark, path, TRADE)
    feed.add(trades(spark, *[("A", 1.0, 1.0, at(c), True) for c in clocks]))
    return feed


def collected(stream, checkpoint, trigger=None):
    """Drain into a list of (batch id, rows)."""
    seen = []
    drains.each_batch(
        stream, lambda df, i: seen.extend(df.collect()), checkpoint, trigger
    ).awaitTermination()
    return [(r.candle_start_time, r.trade_count) for r in sorted(seen)]


def test_late_trade_is_dropped_and_open_candle_waits(spark, tmp_path):
    path, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    feed = trade_feed(spark, path, "10:00:10", "10:00:50", "10:01:05", "10:30:00")
    assert collected(layers.gold(feed.stream()), mark) == [(at("10:00:00"), 2), (at("10:01:00"), 1)]
    feed.add(trades(spark, *[("A", 1.0, 1.0, at(c), True) for c in ("10:00:30", "10:25:00", "10:31:00")]))
    assert collected(layers.gold(feed.stream()), mark) == []
    feed.add(trades(spark, ("A", 1.0, 1.0, at("12:00:00"), True)))
    assert collected(layers.gold(feed.stream()), mark) == [
        (at("10:25:00"), 1), (at("10:30:00"), 1), (at("10:31:00"), 1),
    ]


def test_single_batch_trigger_emits_a_run_later(spark, tmp_path):
    path, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    once = {"once": True}
    feed = trade_feed(spark, path, "10:00:10", "10:00:50", "10:01:05", "10:30:00")
    assert collected(layers.gold(feed.stream()), mark, once) == []
    feed.add(trades(spark, ("A", 1.0, 1.0, at("10:00:30"), True)))
    assert collected(layers.gold(feed.stream()), mark, once) == [
        (at("10:00:00"), 3), (at("10:01:00"), 1),
    ]


def test_silver_drops_copies_across_drains_and_restarts(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    first = ("A", 1.0, 1.0, at("10:00:00"), True)
    second = ("A", 2.0, 1.0, at("10:00:01"), True)
    feed = Feed(spark, source, RECORD)
    feed.add(records(spark, first, first, second))
    drains.drain_silver(feed.stream(), out, mark)
    feed.add(records(spark, second, ("A", 3.0, 1.0, at("10:00:02"), None)))
    drains.drain_silver(feed.stream(), out, mark)
    drains.drain_silver(feed.stream(), out, mark)
    stored = parquet_tree(spark, out, schemas.SILVER)
    assert rows(stored, "price", "trade_side", "year", "month", "day") == [
        (1.0, "SELL", 2024, 3, 1), (2.0, "SELL", 2024, 3, 1), (3.0, "SELL", 2024, 3, 1),
    ]


def test_silver_drops_trades_behind_the_watermark(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    feed = Feed(spark, source, RECORD)
    feed.add(records(spark, ("A", 1.0, 1.0, at("10:30:00"), True)))
    drains.drain_silver(feed.stream(), out, mark, files_per_day=2)
    feed.add(records(spark, ("A", 2.0, 1.0, at("10:19:00"), True), ("A", 3.0, 1.0, at("10:21:00"), True)))
    drains.drain_silver(feed.stream(), out, mark, files_per_day=2)
    assert rows(parquet_tree(spark, out, schemas.SILVER), "price") == [(1.0,), (3.0,)]


@pytest.mark.parametrize("collapse", [True, False])
def test_a_hot_copy_passes_once(spark, tmp_path, collapse):
    source, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    feed = Feed(spark, source, TRADE)
    hot = ("A", 1.0, 1.0, at("10:00:00"), True)
    for i in range(6):
        others = [("B", float(i), 1.0, at("10:00:00"), True)]
        feed.add(trades(spark, *([hot] * 20), *others))
    seen = []
    stream = distinct_trades_stream(feed.stream(max_files=3), collapse=collapse)
    drains.each_batch(stream, lambda df, i: seen.extend(df.collect()), mark).awaitTermination()
    assert sorted((r.symbol, r.price) for r in seen) == [("A", 1.0)] + [("B", float(i)) for i in range(6)]


def test_failing_sink_fails_the_run_and_loses_nothing(spark, tmp_path):
    path, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    feed = trade_feed(spark, path, "10:00:00", "10:30:00")

    def broken(df, batch_id):
        raise RuntimeError("table is away")

    with pytest.raises(Exception, match="table is away"):
        drains.each_batch(layers.gold(feed.stream()), broken, mark).awaitTermination()
    assert collected(layers.gold(feed.stream()), mark) == [(at("10:00:00"), 1)]


@pytest.mark.parametrize("files", [None, 1])
def test_bronze_keeps_malformed_messages_apart(spark, tmp_path, files):
    landed, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    good = '{"source":"f","symbol":"A","price":1.0,"quantity":1.0,"trade_time":0,"is_buyer_maker":true}'
    spark.createDataFrame([(good,), ("not json",)], "value string").coalesce(1).write.text(landed)
    drains.drain_bronze(text_messages(spark, landed, streaming=True), out, mark, files)
    assert (tmp_path / "out" / "year=__HIVE_DEFAULT_PARTITION__").is_dir()
    assert rows(parquet_tree(spark, out, schemas.BRONZE), "symbol", "year", "hour") == [
        ("A", 1970, 0), (None, None, None),
    ]


KEYS = drains.CANDLE_KEYS


def stored(spark, path):
    return rows(candle_table(spark, path), "symbol", "candle_start_time", "close_price")


def merge(spark, path, stage, *made):
    replace_by_key(candles(spark, *made), path, KEYS, "candle_start_time", stage)


def test_keyed_sink_replaces_and_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "table")
    stages = (str(tmp_path / f"stage-{i}") for i in itertools.count())
    old, day = at("10:00:00").replace(day=2, month=2), at("10:00:00")
    merge(spark, path, next(stages), candle("A", old), candle("A", day), candle("B", day))
    for _ in range(2):
        merge(spark, path, next(stages), candle("A", day, c=7.0), candle("C", day, c=8.0))
    assert stored(spark, path) == [("A", old, 1.0), ("A", day, 7.0), ("B", day, 1.0), ("C", day, 8.0)]
    assert not list(tmp_path.glob("stage-*/*"))


def test_keyed_sink_resumes_an_interrupted_publication(spark, tmp_path, monkeypatch):
    path, stage, day = str(tmp_path / "table"), str(tmp_path / "stage"), at("10:00:00")
    merge(spark, path, str(tmp_path / "other"), candle("A", day), candle("B", day))

    with monkeypatch.context() as patch:
        # Stop after publishing, then lose the day as a half-done replacement would.
        patch.setattr(keyed, "discard", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            merge(spark, path, stage, candle("A", day, c=7.0))
    discard(spark, path + "/candle_day=2024-03-01")
    merge(spark, path, stage, candle("A", day, c=7.0))
    assert stored(spark, path) == [("A", day, 7.0), ("B", day, 1.0)]


def test_keyed_sink_takes_an_empty_batch(spark, tmp_path):
    path = str(tmp_path / "table")
    merge(spark, path, str(tmp_path / "s1"), candle("A", at("10:00:00")))
    merge(spark, path, str(tmp_path / "s2"))
    assert len(stored(spark, path)) == 1


def test_layers_in_sequence(spark, tmp_path):
    landed, root = str(tmp_path / "in"), str(tmp_path / "lake")
    body = F.to_json(F.struct("*")).alias("value")
    made = [("A", float(i), 1.0, at(f"10:{i:02d}:00"), i % 2 == 0) for i in range(1, 40)]
    records(spark, *made, *made).select(body).coalesce(1).write.text(landed)
    for _ in range(2):
        paths = drains.run_layers(spark, text_messages(spark, landed, streaming=True), root).paths
    found = rows(candle_table(spark, paths["candles"]), "candle_start_time", "trade_count")
    assert found == [(at(f"10:{i:02d}:00"), 1) for i in range(1, 29)]
    for _ in range(2):
        whole = backfill(spark, text_messages(spark, landed), str(tmp_path / "whole"))
    every = candle_table(spark, whole["candles"]).drop("ingested_at")
    assert every.count() == 39
    streamed = candle_table(spark, paths["candles"]).drop("ingested_at")
    assert rows(every.filter(F.col("candle_start_time") < at("10:29:00"))) == rows(streamed)


def test_collapsed_batches_keep_first_rows_whole(spark):
    made = [("A", 1.0, None, at("10:00:00"), True), ("B", 2.0, 1.0, at("10:00:00"), None),
            ("A", 1.0, None, at("10:00:00"), False), (None, 1.0, 1.0, None, True),
            (None, 1.0, 1.0, None, False)]
    df = trades(spark, *made).coalesce(1)
    kept = collapsed_batches(df, ["symbol", "trade_timestamp", "price", "quantity"])
    assert kept.schema == df.schema
    assert [tuple(r) for r in kept.collect()] == [made[0], made[1], made[3]]


def landed_by_tasks(spark, path, tasks=4, hours=6):
    """Messages of some hours, each hour over all of ``tasks`` files."""
    made = [
        ("A", float(i + 1), 1.0, at(f"{9 + i // 60:02d}:{i % 60:02d}:00"), i % 2 == 0)
        for i in range(hours * 60)
    ]
    body = F.to_json(F.struct("*")).alias("value")
    records(spark, *made).select(body).repartition(tasks).write.text(path)
    return made


def counts(spark, paths):
    return (
        parquet_tree(spark, paths["bronze"], schemas.BRONZE).count(),
        parquet_tree(spark, paths["silver"], schemas.SILVER).count(),
        candle_table(spark, paths["candles"]).agg(F.sum("trade_count")).first()[0],
    )


def test_files_of_several_tasks_lose_nothing(spark, tmp_path):
    landed = str(tmp_path / "in")
    made = landed_by_tasks(spark, landed)
    messages = text_messages(spark, landed, streaming=True)
    drained = drains.run_layers(
        spark, messages, str(tmp_path / "lake"), partitions=3, files_per_hour=2,
        files_per_day=2, fail_on_dropped=True,
    )
    assert drained.dropped == {"silver": 0, "candles": 0}
    # The last candle whose end the watermark, ten minutes behind, has passed.
    assert counts(spark, drained.paths) == (len(made), len(made), len(made) - 11)
    for days in (None, 1):
        root = str(tmp_path / f"whole-{days}")
        paths = backfill(spark, text_messages(spark, landed), root, days_at_once=days, gather=False)
        assert counts(spark, paths) == (len(made),) * 3
    state = list((tmp_path / "lake/_checkpoints/silver/state/0").iterdir())
    assert sorted(p.name for p in state if p.name.isdigit()) == ["0", "1", "2"]


def test_the_callers_partitions_stand(spark, tmp_path):
    feed = trade_feed(spark, str(tmp_path / "in"), "10:00:00", "10:30:00")
    mark = tmp_path / "mark"
    collected(layers.gold(feed.stream()), str(mark))
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len([p for p in (mark / "state/0").iterdir() if p.name.isdigit()]) == wanted
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == wanted


def test_dropped_rows_are_counted_and_can_fail(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    feed = Feed(spark, source, RECORD)
    feed.add(records(spark, ("A", 1.0, 1.0, at("10:30:00"), True)))
    assert drains.drain_silver(feed.stream(), out, mark) == 0
    feed.add(records(spark, ("A", 2.0, 1.0, at("10:10:00"), True)))
    assert drains.drain_silver(feed.stream(), out, mark) == 1
    feed.add(records(spark, ("A", 2.0, 1.0, at("10:11:00"), True)))
    with pytest.raises(RuntimeError, match="behind the watermark"):
        drains.drain_silver(feed.stream(), out, mark, fail_on_dropped=True)


def test_a_stream_goes_on_after_a_backfill(spark, tmp_path):
    root = str(tmp_path / "lake")
    body = F.to_json(F.struct("*")).alias("value")
    made = [
        ("A", float(i + 1), 1.0, at(f"{9 + i // 120:02d}:{i // 2 % 60:02d}:{i % 2 * 30:02d}"), True)
        for i in range(240)
    ]
    early, late = str(tmp_path / "early"), str(tmp_path / "late")
    # The seam lies within a minute; twenty trades are delivered again.
    records(spark, *made[:121]).select(body).write.text(early)
    records(spark, *made[101:]).select(body).write.text(late)
    backfill(spark, text_messages(spark, early), root)
    for _ in range(2):
        drained = drains.run_layers(spark, text_messages(spark, late, streaming=True), root)
    bronze, silver, _ = counts(spark, drained.paths)
    assert (bronze, silver) == (121 + 139, 240)
    table = candle_table(spark, drained.paths["candles"])
    assert {r.trade_count for r in table.collect()} == {2}
    assert table.count() == 109  # candles that end before 10:49:30, where the watermark is
    seam = table.filter(F.col("candle_start_time") == at("10:00:00")).first()
    assert (seam.open_price, seam.close_price) == (121.0, 122.0)
