"""Upserts, reloads, loads, marts on disk and option maps."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv
from tapeworks import session
from tapeworks.operators.upsert import absent_by_key, replaced_by_key, upsert
from tapeworks.plans import layers, loads, marts
from tapeworks.sinks import files, tables
from tapeworks.storage import discard
from tapeworks.sources import files as source_files
from tapeworks.sources import sentiment
from tapeworks.sources.messages import topic_options
from tapeworks.sources.object_store import s3a_settings
from tapeworks.sources.tables import jdbc_options
from tests.helpers import DAY, at, candle, candles, records, rows

TARGET = "date date, fng_value int, fng_classification string, updated_at timestamp"
D1, D2, D3 = (dt.date(2024, 3, d) for d in (1, 2, 3))


def readings(spark, *made):
    return spark.createDataFrame(
        list(made), "date date, fng_value int, fng_classification string, landed_at timestamp"
    )


def test_upsert_stamps_conflicts_only_and_takes_the_last(spark):
    target = spark.createDataFrame([(D1, 1, "a", None), (D2, 2, "b", at("01:00:00"))], TARGET)
    updates = readings(
        spark, (D2, 8, "x", at("02:00:00")), (D2, 9, None, at("03:00:00")), (D3, 3, "c", at("02:00:00"))
    )
    now = F.lit(at("04:00:00"))
    merged = upsert(target, updates, ["date"], [F.desc("landed_at")], now=now)
    assert rows(merged) == [(D1, 1, "a", None), (D2, 9, None, at("04:00:00")), (D3, 3, "c", None)]


def test_sentiment_load_twice_and_after_interruption(spark, tmp_path):
    path, stage = str(tmp_path / "t"), str(tmp_path / "s")
    now = F.lit(at("04:00:00"))

    def load(*made):
        loads.load_sentiment(spark, readings(spark, *made), path, stage, now=now)

    load((D1, 1, "a", at("01:00:00")))
    load((D1, 2, "b", at("02:00:00")), (D2, 5, "c", at("02:00:00")))
    stored = [(D1, 2, "b", at("04:00:00")), (D2, 5, "c", None)]
    assert rows(spark.read.parquet(path)) == stored
    # The table is lost after the result was staged: the next load restores it first.
    files.rebuild(spark.read.parquet(path), stage)
    discard(spark, path)
    load((D3, 7, "d", at("03:00:00")))
    assert rows(spark.read.parquet(path)) == [*stored, (D3, 7, "d", None)]


def test_index_replies(spark, tmp_path):
    def reply(*elements):
        return json.dumps({"name": "index", "data": list(elements)}, indent=1)

    seconds = int((DAY - dt.datetime(1970, 1, 1)).total_seconds())
    good = {"value": "40", "value_classification": "Fear", "timestamp": str(seconds)}
    older = {"value": "50", "value_classification": "Greed", "timestamp": str(seconds - 86400)}
    (tmp_path / "1.json").write_text(reply(good, older))
    (tmp_path / "2.json").write_text(reply())
    (tmp_path / "3.json").write_text(reply({**good, "value": "n/a"}))
    found = sentiment.newest_readings(sentiment.index_replies(spark, str(tmp_path)))
    assert rows(found, "date", "fng_value", "fng_classification") == [(D1, 40, "Fear")]


def test_reload_replaces_only_its_slices(spark, path):
    def day(n, *values):
        return spark.createDataFrame([(v, n) for v in values], "v int, day int")

    files.reload_slices(day(1, 1, 2).unionAll(day(2, 3)), path, ["day"])
    files.reload_slices(day(2, 4, 5), path, ["day"])
    assert rows(spark.read.parquet(path), "day", "v") == [(1, 1), (1, 2), (2, 4), (2, 5)]


def test_tree_merges_columns(spark, path):
    spark.createDataFrame([(1, "x")], "id int, a string").write.parquet(path + "/day=1/h=1")
    spark.createDataFrame([(2,)], "id int").write.parquet(path + "/day=2/h=1")
    assert rows(source_files.parquet_tree(spark, path), "id", "a", "day") == [(1, "x", 1), (2, None, 2)]


def test_history_load_of_a_missing_day_is_empty(spark, tmp_path):
    silver, history = str(tmp_path / "silver"), str(tmp_path / "history")
    clean = layers.silver(records(spark, ("A", 1.0, 1.0, at("10:00:00"), True)))
    files.reload_slices(clean, silver, fv.SILVER_PARTITIONS)
    loads.load_trade_history(spark, silver, history, D1)
    loads.load_trade_history(spark, silver, history, D2)
    loads.load_trade_history(spark, silver, history, D1, D2)
    assert rows(spark.read.parquet(history), "symbol", "trade_day") == [("A", D1)]


def test_marts_on_disk_pass_their_checks(spark, tmp_path):
    fact = candles(spark, candle("btcusdt", at("10:00:00")), candle("ethusdt", at("10:00:00")))
    mood = spark.createDataFrame([(D1, 40, "Fear", None)], TARGET)
    for _ in range(2):
        paths = marts.build_marts(spark, fact, mood, str(tmp_path), as_of=at("11:00:00"))
    built = {name: spark.read.parquet(p) for name, p in paths.items()}
    assert {n: df.count() for n, df in built.items()} == {
        "market_overview": 2, "ohlc_summary": 2, "pipeline_health": 2, "price_vs_sentiment": 1,
    }
    verdicts = marts.mart_checks(built)
    assert verdicts.count() == 6 and verdicts.filter("should_error").count() == 0
    twice = fact.unionAll(fact)
    assert rows(marts.candle_checks(twice).filter("should_error"), "check", "failures") == [("candle unique", 2)]


def test_only_absent_rows_are_appended(spark):
    stored = candles(spark, candle("A", at("10:00:00")))
    batch = candles(spark, candle("A", at("10:00:00")), candle("A", at("10:01:00")))
    fresh = absent_by_key(batch, stored, ["symbol", "candle_start_time"])
    assert rows(fresh, "candle_start_time") == [(at("10:01:00"),)]


def test_topic_options():
    assert topic_options("host:1", "trades", maxOffsetsPerTrigger="5") == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "trades",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5",
    }


def test_jdbc_options():
    base = jdbc_options("jdbc:x", "t", "driver", user="u", password="p")
    assert tables.jdbc_write_options(base, connections=4) == {
        "url": "jdbc:x", "dbtable": "t", "driver": "driver", "user": "u", "password": "p",
        "batchsize": "1000", "numPartitions": "4",
    }


def test_object_store_settings():
    found = s3a_settings("http://store", "a", "b")
    assert found["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert found["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_scratch_lies_in_the_shared_folder(spark):
    assert session.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("span, days", [((D1, D1), 1), ((D1, D3), 3), ((D2, D3), 2)])
def test_day_range(spark, span, days):
    from tapeworks.functions.moments import within_days

    df = spark.createDataFrame([(2024, 3, d) for d in range(1, 4)], "year int, month int, day int")
    assert df.filter(within_days(*span)).count() == days


def test_a_null_key_is_replaced(spark):
    stored = spark.createDataFrame([(None, 1), ("a", 1)], "symbol string, n int")
    incoming = spark.createDataFrame([(None, 2)], "symbol string, n int")
    assert rows(replaced_by_key(stored, incoming, ["symbol"])) == [("a", 1), (None, 2)]
    assert absent_by_key(incoming, stored, ["symbol"]).count() == 0
