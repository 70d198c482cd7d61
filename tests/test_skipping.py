"""Clustered tables: equal to the plain filter, with few files read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeworks.sinks import skipping, snapshots
from tapeworks.sinks.skipping import Between, OneOf
from tests.helpers import at, rows

ROWS = 4096


@pytest.fixture(scope="module")
def ticks(spark):
    """A third of all rows is of one symbol; some have no symbol, time or id."""
    i = F.col("id")
    moment = F.timestamp_seconds(F.unix_timestamp(F.lit(at("00:00:00"))) + (i * 7919 % ROWS) * 30)
    return spark.range(ROWS).select(
        F.when(F.xxhash64(i) % 3 == 0, "HOT").when(i % 97 == 1, None).otherwise(F.concat(F.lit("S+ %"), i % 11)).alias("symbol"),
        F.when(i % 89 != 2, moment).alias("moment"),
        F.when(i % 83 != 3, i).alias("trade_id"),
        (i / 7).alias("price"),
        F.to_date(moment).cast("string").alias("day"),
    )


def put(ticks, path, **options):
    options = {"rows_per_file": 128, "lookup": ["trade_id", "symbol"]} | options
    return skipping.put(ticks, path, ["symbol", "moment"], **options)


HOUR = {"symbol": OneOf("HOT"), "moment": Between(at("05:00:00"), at("05:59:59"))}
ASKED = [
    HOUR,
    {"symbol": OneOf("S+ %4", "HOT", None), "moment": Between(high=at("01:00:00"))},
    {"trade_id": OneOf(1234, 77, 3)},
    {"price": Between(10.0, 20.5)},
    {"symbol": OneOf("absent")},
    {"symbol": OneOf()},
    {"moment": Between()},
    {},
]


def plain(df, where):
    for name, asked in where.items():
        if isinstance(asked, OneOf):
            known = [v for v in asked.values if v is not None]
            df = df.filter(F.col(name).isin(known) if known else F.lit(False))
        else:
            df = df.filter(F.col(name).isNotNull())
            df = df.filter(F.col(name) >= asked.low) if asked.low is not None else df
            df = df.filter(F.col(name) <= asked.high) if asked.high is not None else df
    return df


@pytest.mark.parametrize("slice_by", [None, "day", "symbol"])
def test_scans_equal_the_plain_filter(spark, ticks, path, slice_by):
    snapshot = put(ticks, path, slice_by=slice_by)
    for where in ASKED:
        assert rows(skipping.scan(spark, snapshot, where)) == rows(plain(ticks, where)), where


def test_few_files_are_read_for_a_symbol_and_an_hour(spark, ticks, path):
    snapshot = put(ticks, path)
    every = skipping.files(spark, snapshot, {})
    assert len(every) == ROWS // 128
    some = skipping.scan(spark, snapshot, HOUR)
    assert len(some.inputFiles()) <= 4
    assert rows(some) and len(skipping.files(spark, snapshot, HOUR)) == len(some.inputFiles())
    # Neither the range of the hot symbol nor of the hour alone would do.
    assert len(skipping.files(spark, snapshot, {"symbol": HOUR["symbol"]})) > 4
    assert len(skipping.files(spark, snapshot, {"moment": HOUR["moment"]})) >= 4


def test_a_value_is_looked_up_in_the_filters_where_ranges_tell_nothing(spark, ticks, path):
    snapshot = put(ticks, path)
    for value in (5, 1234, 4000):
        assert len(skipping.files(spark, snapshot, {"trade_id": OneOf(value)})) <= 2
    assert skipping.files(spark, snapshot, {"symbol": OneOf("absent")}) == []


def test_only_replaced_slices_are_written_and_told_anew(spark, ticks, path):
    first = put(ticks, path, slice_by="day")
    day = str(at("00:00:00").date() + dt.timedelta(days=1))
    change = ticks.filter(F.col("day") == day).withColumn("price", -F.col("price"))
    second = put(change, path, slice_by="day", slices=[day])
    assert {p for p in first.parts if p.slice != day} < set(second.parts)
    expected = ticks.filter(F.col("day") != day).unionByName(change)
    for where in ASKED:
        assert rows(skipping.scan(spark, second, where)) == rows(plain(expected, where))
        assert rows(skipping.scan(spark, first, where)) == rows(plain(ticks, where))
    with pytest.raises(ValueError):
        put(change, path, slice_by="day", slices=["2001-01-01"])


def test_statistics_are_merged_when_they_are_many(spark, ticks, path, monkeypatch):
    monkeypatch.setattr(skipping, "FAN_IN", 3)
    put(ticks, path, slice_by="day")
    day = str(at("00:00:00").date())
    for factor in range(4):
        change = ticks.filter(F.col("day") == day).withColumn("price", F.col("price") + factor)
        last = put(change, path, slice_by="day", slices=[day])
        assert last.notes["stats"].count("statistics/") < 3
    expected = ticks.filter(F.col("day") != day).unionByName(change)
    for where in ASKED:
        assert rows(skipping.scan(spark, last, where)) == rows(plain(expected, where))
    assert skipping.expire(spark, path, keep=1)
    assert rows(skipping.scan(spark, last, HOUR)) == rows(plain(expected, HOUR))


def test_appended_parts_are_read_until_they_are_clustered(spark, ticks, path):
    numbered = ticks.withColumn(snapshots.RUN_NUMBER, F.lit(0).cast("long"))
    put(numbered, path, slice_by="day")
    snapshot = snapshots.append(ticks.limit(5), path, "day", "late")
    found = skipping.scan(spark, snapshot, HOUR).drop(snapshots.RUN_NUMBER)
    assert rows(found) == rows(plain(ticks.unionByName(ticks.limit(5)), HOUR))
    assert len(skipping.files(spark, snapshot, {"symbol": OneOf("absent")})) == len(
        {p for p in snapshot.parts if p.last_run > 0}
    )


def test_equal_rows_are_dealt_to_many_files_and_none_is_an_empty_table(spark, ticks, path):
    equal = spark.range(2000).select(
        F.lit("A").alias("symbol"), F.lit(at("00:00:00")).alias("moment"), (F.col("id") % 50).alias("n")
    )
    snapshot = skipping.put(equal, path, ["symbol", "moment"], rows_per_file=200)
    sizes = [spark.read.parquet(f).count() for f in skipping.files(spark, snapshot, {})]
    assert sum(sizes) == 2000 and max(sizes) < 700
    empty = put(ticks.limit(0), f"{path}-none")
    assert rows(skipping.scan(spark, empty, HOUR)) == []
