"""Candles, marts, gaps and checks on hand-made rows."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tapeworks.functions import labels
from tapeworks.functions.amounts import trade_order
from tapeworks.operators import checks
from tapeworks.operators.candles import described_candles, merged_candles, to_candles
from tapeworks.operators.gaps import missing_candles, missing_spans
from tapeworks.plans.market_overview import market_overview
from tapeworks.plans.ohlc_summary import hourly_candles, ohlc_summary
from tapeworks.plans.pipeline_health import daily_summary, hourly_ingestion, pipeline_health
from tapeworks.plans.price_vs_sentiment import price_vs_sentiment
from tests.helpers import DAY, at, candle, candles, rows, trades


def test_candle_by_event_time_and_sides(spark):
    df = to_candles(
        trades(
            spark,
            ("A", 5.0, 1.0, at("10:00:59"), True),
            ("A", 3.0, 2.0, at("10:00:00"), False),
            ("A", 9.0, 4.0, at("10:00:30"), None),
            ("A", 7.0, 8.0, at("10:01:00"), True),
        )
    ).drop("ingested_at")
    assert rows(df) == [
        (at("10:00:00"), "A", 3.0, 9.0, 3.0, 5.0, 7.0, 2.0, 1.0, 3),
        (at("10:01:00"), "A", 7.0, 7.0, 7.0, 7.0, 8.0, 0.0, 8.0, 1),
    ]


def test_unpriced_trades_do_not_open_a_candle(spark):
    df = to_candles(
        trades(
            spark,
            ("A", None, 1.0, at("10:00:01"), True),
            ("A", 4.0, 1.0, at("10:00:02"), True),
            ("A", None, 1.0, at("10:00:03"), True),
        )
    )
    assert rows(df, "open_price", "close_price", "trade_count") == [(4.0, 4.0, 3)]


def test_trade_order_keeps_time_before_id(spark):
    ids = [-(2**63), -5, 0, 7, 2**63 - 1]
    times = [dt.datetime(1969, 12, 31, 23), DAY, at("00:00:00", 1), dt.datetime(9999, 12, 31)]
    made = [(t, i) for t in times for i in ids]
    df = spark.createDataFrame(made, "t timestamp, i bigint")
    packed = df.select("t", "i", trade_order(F.col("t"), F.col("i")).alias("o")).orderBy("o").collect()
    assert [(r.t, r.i) for r in packed] == sorted(made)


def test_candles_against_brute_force(spark):
    rng = random.Random(3)
    made = []
    for i in range(800):
        moment = at("09:00:00") + dt.timedelta(seconds=rng.randrange(400))
        symbol = "HOT" if rng.random() < 0.5 else rng.choice("ABC")
        made.append((symbol, float(rng.randrange(1, 50)), float(rng.randrange(9)), moment,
                     rng.choice([True, False]), i))
    expected = defaultdict(list)
    for row in made:
        expected[(row[3].replace(second=0), row[0])].append(row)
    want = []
    for (start, symbol), group in expected.items():
        group.sort(key=lambda r: (r[3], r[5]))
        prices = [r[1] for r in group]
        volume = sum(r[2] for r in group)
        bought = sum(r[2] for r in group if not r[4])
        want.append((start, symbol, prices[0], max(prices), min(prices), prices[-1], volume,
                     bought, volume - bought, len(group)))
    df = spark.createDataFrame(
        made,
        "symbol string, price double, quantity double, trade_timestamp timestamp, "
        "is_buyer_maker boolean, id bigint",
    ).repartition(6)
    found = to_candles(df, trade_id="id").drop("ingested_at")
    assert rows(found) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    five = F.window("candle_start_time", "5 minutes").start.alias("candle_start_time")
    folded = merged_candles(found, "symbol", five).select(*found.columns)
    assert rows(folded) == rows(to_candles(df, width="5 minutes", trade_id="id").drop("ingested_at"))


def test_described_edges(spark):
    df = described_candles(
        candles(
            spark,
            candle("flat", at("10:05:00")),
            candle("fell", at("10:05:00"), o=2.0, c=1.0),
            candle("zero", at("10:05:00"), o=0.0, volume=0.0, buy=0.0),
            candle("none", at("10:05:00"), o=None),
        )
    )
    columns = ("symbol", "candle_type", "body_size_pct", "buy_pressure_pct", "hour_of_day")
    assert rows(df, *columns) == [
        ("fell", "Bearish", 50.0, 100.0, 10),
        ("flat", "Bullish", 0.0, 100.0, 10),
        ("none", "Bearish", None, 100.0, 10),
        ("zero", "Bullish", None, None, 10),
    ]


def test_overview_bounds_and_values(spark):
    as_of = at("12:00:00")
    day = dt.timedelta(days=1)
    df = market_overview(
        candles(
            spark,
            candle("A", as_of - day - dt.timedelta(microseconds=1), o=1.0, c=1.0, h=99.0),
            candle("A", as_of - day, o=2.0, c=3.0, h=5.0, volume=4.0, buy=1.0, sell=3.0, n=2),
            candle("A", at("11:59:00"), o=3.0, c=4.0, h=4.0, low=0.5, volume=4.0, buy=2.0, sell=2.0),
            candle("gone", as_of - 2 * day),
            candle("late", as_of + day, o=0.0, volume=0.0, buy=0.0),
        ),
        as_of,
    )
    assert rows(df) == [
        ("A", 4.0, 2.0, 5.0, 0.5, 100.0, 2.0, 8.0, 3.0, 5.0, 37.5, 3, at("11:59:00")),
        ("late", 1.0, 0.0, 1.0, 1.0, None, 1.0, 0.0, 0.0, 0.0, None, 1, as_of + day),
    ]


def test_overview_of_nothing(spark):
    assert market_overview(candles(spark), at("12:00:00")).count() == 0


def test_summary_has_one_row_per_candle_and_no_foreign_hours(spark):
    fact = candles(
        spark,
        candle("A", at("10:00:00"), o=1.0, c=2.0, h=3.0, volume=2.0, buy=1.0),
        candle("A", at("10:59:00"), o=5.0, c=6.0, h=7.0, volume=2.0, buy=2.0),
        candle("A", at("11:00:00"), o=8.0, c=9.0, h=9.0),
        candle("B", at("10:30:00"), o=70.0, c=80.0, h=90.0),
    )
    df = ohlc_summary(fact)
    assert len(df.columns) == 25
    columns = ("symbol", "candle_start_time", "hourly_open", "hourly_high", "hourly_close",
               "hourly_volume", "hourly_buy_pct")
    assert rows(df, *columns) == [
        ("A", at("10:00:00"), 1.0, 7.0, 6.0, 4.0, 75.0),
        ("A", at("10:59:00"), 1.0, 7.0, 6.0, 4.0, 75.0),
        ("A", at("11:00:00"), 8.0, 9.0, 9.0, 1.0, 100.0),
        ("B", at("10:30:00"), 70.0, 90.0, 80.0, 1.0, 100.0),
    ]
    assert rows(hourly_candles(fact), "symbol", "hourly_open", "hourly_close") == [
        ("A", 1.0, 6.0), ("A", 8.0, 9.0), ("B", 70.0, 80.0),
    ]


@pytest.mark.parametrize(
    "minutes, status",
    [(5.0, "Fresh ✅"), (5.01, "Stale ⚠️"), (30.0, "Stale ⚠️"), (30.01, "Dead ❌"), (None, "Dead ❌")],
)
def test_freshness_bounds(spark, minutes, status):
    df = spark.createDataFrame([(minutes,)], "m double")
    assert df.select(labels.freshness_status(F.col("m"))).first()[0] == status


def test_completeness(spark):
    full = [candle("full", at("10:00:00") + dt.timedelta(minutes=m)) for m in range(60)]
    short = [candle("short", at("10:00:00") + dt.timedelta(minutes=m)) for m in range(1, 60)]
    fact = candles(spark, *full, *short)
    assert rows(hourly_ingestion(fact), "symbol", "completeness_pct", "missing_candles") == [
        ("full", 100.0, 0), ("short", 98.3, 1),
    ]
    assert rows(missing_candles(fact)) == [("short", at("10:00:00"))]
    columns = ("total_candles", "active_symbols", "avg_trades_per_candle", "daily_completeness_pct")
    assert rows(daily_summary(fact), *columns) == [(119, 2, 1.0, 4.1)]


def test_health_joins_the_day_and_the_age(spark):
    fact = candles(
        spark,
        candle("A", at("09:10:00")),
        candle("A", at("11:55:00")),
        candle("B", at("11:00:00") - dt.timedelta(days=1)),
        candle("B", at("11:31:00")),
        candle(None, at("11:31:00")),
    )
    df = pipeline_health(fact, at("12:00:00"))
    columns = ("symbol", "minutes_since_last_candle", "freshness_status", "day_total_candles",
               "day_active_symbols")
    assert rows(df, *columns) == [
        ("A", 5.0, "Fresh ✅", 4, 2),
        ("A", 5.0, "Fresh ✅", 4, 2),
        ("B", 29.0, "Stale ⚠️", 1, 1),
        ("B", 29.0, "Stale ⚠️", 4, 2),
        (None, None, None, 4, 2),
    ]
    hours = [(r.ingestion_hour, r.symbol) for r in df.collect()]
    assert [h for h, _ in hours] == sorted((h for h, _ in hours), reverse=True)


def test_gaps_cross_empty_hours_and_reach_the_horizon(spark):
    fact = candles(spark, candle("A", at("08:00:00")), candle("A", at("11:59:00")))
    found = rows(missing_candles(fact))
    assert len(found) == 4 * 60 - 2
    assert found[0] == ("A", at("08:01:00")) and found[-1] == ("A", at("11:58:00"))
    assert missing_candles(fact, until=F.lit(at("13:30:00"))).count() == 5 * 60 - 2
    assert missing_candles(fact, until=F.lit(at("09:00:00"))).count() == 4 * 60 - 2


def test_price_against_sentiment_in_any_case(spark):
    fact = candles(
        spark,
        candle("btcusdt", at("10:00:00"), c=2.0, h=3.0),
        candle("BTCUSDT", at("10:01:00"), c=4.0, h=5.0),
        candle("BTCUSDT", at("10:00:00") - dt.timedelta(days=1)),
        candle("ethusdt", at("10:00:00")),
    )
    mood = spark.createDataFrame([(DAY.date(), 40, "Fear")], "date date, fng_value int, fng_classification string")
    df = price_vs_sentiment(fact, mood)
    assert [tuple(r) for r in df.collect()] == [
        (DAY.date(), "BTC", 3.0, 5.0, 1.0, 2.0, 40, "Fear"),
        (DAY.date() - dt.timedelta(days=1), "BTC", 1.0, 1.0, 1.0, 1.0, None, None),
    ]
    assert price_vs_sentiment(fact, mood, exact_case=True).count() == 1


def test_checks_on_one_and_null(spark):
    df = spark.sql("select 1 as id union all select null")
    assert rows(checks.verdict(checks.null_rows(df, "id"))) == [(1, True, True)]
    assert rows(checks.verdict(checks.repeated_values(df, "id"))) == [(0, False, False)]
    twice = df.unionAll(df)
    assert rows(checks.repeated_values(twice, "id")) == [(1, 2)]
    only = df.filter("id = 1")
    assert rows(checks.verdict(checks.null_rows(only, "id"))) == [(0, False, False)]
    assert rows(checks.null_counts(df, "id")) == [("id", 1, True, True)]


def test_ties_without_an_id_do_not_follow_the_order_of_arrival(spark):
    rnd = random.Random(4)
    made = [("A", float(rnd.randint(1, 9)), float(rnd.randint(1, 9)), at("10:00:00"), True) for _ in range(300)]
    found = set()
    for seed in range(4):
        random.Random(seed).shuffle(made)
        row = to_candles(trades(spark, *made).repartition(1 + 3 * seed)).first()
        found.add((row.open_price, row.close_price))
    assert len(found) == 1


def test_a_far_off_candle_is_one_span(spark):
    far = at("10:00:00").replace(year=2924)
    fact = candles(spark, candle("A", at("10:00:00")), candle("A", at("10:02:00")), candle("A", far))
    spans = rows(missing_spans(fact), "span_start", "span_end", "missing_minutes")
    hours = (far - at("10:00:00")) // dt.timedelta(hours=1)
    assert spans == sorted([
        (at("10:00:00"), at("11:00:00"), 58),
        (at("11:00:00"), far, (hours - 1) * 60),
        (far, far + dt.timedelta(hours=1), 59),
    ], key=lambda r: tuple((v is None, str(v)) for v in r))
    near = fact.filter(F.col("candle_start_time") < at("12:00:00"))
    listed = missing_candles(near.unionByName(candles(spark, candle("A", at("13:30:00")))))
    assert listed.count() == 58 + 120 + 59
    assert listed.distinct().count() == listed.count()
