"""Messages, cleaning, enrichment and dedup on hand-made rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tapeworks.operators import messages
from tapeworks.operators.concat import concat
from tapeworks.operators.dedup import distinct_trades
from tapeworks.operators.trades import enriched_trades, standardized_trades, valid_trades
from tapeworks.plans import layers
from tests.helpers import at, records, rows


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def wire(**changes):
    data = {"s": "BTCUSDT", "p": "10.5", "q": "2", "T": 1000, "m": False, "E": 5, **changes}
    return json.dumps({"stream": "x", "data": {k: v for k, v in data.items() if v != "absent"}})


@pytest.mark.parametrize(
    "message, kept",
    [
        (wire(), True),
        (wire(p=10.5), True),
        (wire(p=" 1e3 "), True),
        (wire(p="abc"), False),
        (wire(p="10d"), False),
        (wire(p="0x1p3"), False),
        (wire(q=None), False),
        (wire(s=None), True),
        (wire(m=None), True),
        (wire(m="absent"), False),
        (wire(T="absent"), False),
        ('{"stream": "x"}', False),
        ('{"data": null}', False),
        ('{"data": "text"}', False),
        ("not json", False),
        ("[1]", False),
    ],
)
def test_envelope_kept_or_dropped(spark, message, kept):
    assert messages.normalize_envelopes(texts(spark, message), "feed").count() == int(kept)


def test_envelope_fields(spark):
    df = messages.normalize_envelopes(texts(spark, wire(m=True)), "feed", now=F.lit(at("01:02:03")))
    assert rows(df) == [("feed", "BTCUSDT", 10.5, 2.0, 1000, True, "2024-03-01T01:02:03.000000")]


def test_malformed_message_is_a_row_of_nulls(spark):
    good = json.dumps({"symbol": "A", "price": 1.0})
    df = layers.bronze(texts(spark, good, "not json", ""))
    assert df.count() == 3
    assert messages.undecodable(df).count() == 2
    assert df.filter("year is null").count() == 3


def test_published_message_writes_nulls(spark):
    out = messages.to_messages(spark.createDataFrame([("A", None)], "symbol string, price double"))
    key, value = out.first()
    assert key == "A" and json.loads(value) == {"symbol": "A", "price": None}


def test_validity_bounds(spark):
    t = at("10:00:00")
    df = records(
        spark,
        ("A", 999_999.99, 1.0, t, True),
        ("B", 1_000_000.0, 1.0, t, True),
        ("C", 0.0, 1.0, t, True),
        ("D", -1.0, 1.0, t, True),
        ("E", 1.0, 0.0, t, True),
        ("F", None, 1.0, t, True),
        ("G", 1.0, None, t, True),
        (None, 1.0, 1.0, t, True),
        ("I", 1.0, 1.0, None, True),
        ("J", 1.0, 1.0, t, None),
    )
    assert rows(valid_trades(df), "symbol") == [("A",), ("J",)]


def test_enrichment(spark):
    t = at("10:00:00")
    df = records(
        spark,
        ("edge", 100.0, 100.0, t, True),
        ("over", 100.0, 100.0001, t, False),
        ("unknown", 0.123456789, 1.0, t, None),
    )
    done = enriched_trades(standardized_trades(df))
    columns = ("symbol", "price", "trade_value", "trade_side", "price_magnitude", "is_large_trade")
    assert rows(done, *columns) == [
        ("edge", 100.0, 10000.0, "SELL", 2.0, False),
        ("over", 100.0, 10000.01, "BUY", 2.0, True),
        ("unknown", 0.12345679, 0.12345679, "SELL", -0.91, False),
    ]


def test_unreadable_ingest_time_is_null(spark):
    df = records(spark, ("A", 1.0, 1.0, at("10:00:00"), True)).withColumn("ingested_at", F.lit("garbage"))
    assert rows(standardized_trades(df), "ingest_timestamp") == [(None,)]


def test_silver_columns(spark):
    df = layers.silver(records(spark, ("A", 1.0, 1.0, at("10:00:00"), True)))
    assert set(df.columns) == {
        "source", "symbol", "price", "quantity", "is_buyer_maker", "trade_timestamp",
        "ingest_timestamp", "trade_value", "trade_side", "price_magnitude", "is_large_trade",
        "processed_at", "year", "month", "day",
    }


@pytest.mark.parametrize("with_text", [True, False])
def test_dedup_keeps_the_first_arrival_whole(spark, with_text):
    rng = random.Random(7)
    made = [
        (rng.choice("AB"), rng.choice([1.0, 2.0]), 1.0, at(f"10:00:0{rng.randrange(3)}"),
         rng.choice([True, False, None]))
        for _ in range(300)
    ]
    typed = standardized_trades(records(spark, *made))
    typed = typed if with_text else typed.drop("source")
    first = {}
    for i, (symbol, price, quantity, moment, maker) in enumerate(made):
        first.setdefault((symbol, moment, price, quantity), (i, maker))
    expected = sorted((k[0], k[2], str(k[1]), i, str(m)) for k, (i, m) in first.items())
    kept = distinct_trades(typed.repartition(5)).collect()
    actual = sorted(
        (r.symbol, r.price, str(r.trade_timestamp),
         int((r.ingest_timestamp - at("00:00:00")).total_seconds()), str(r.is_buyer_maker))
        for r in kept
    )
    assert actual == expected


def test_dedup_keeps_rows_without_arrival_time(spark):
    typed = standardized_trades(records(spark, ("A", 1.0, 1.0, at("10:00:00"), True)))
    blank = typed.drop("source").withColumn("ingest_timestamp", F.lit(None).cast("timestamp"))
    assert rows(distinct_trades(blank), "symbol", "is_buyer_maker") == [("A", True)]


def test_concat_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    assert rows(concat(a, b)) == [(1, "x", None), (2, None, "y")]


def test_absurd_times_are_kept_in_bronze_and_dropped_in_silver(spark):
    bodies = [json.dumps({"symbol": "A", "price": 1.0, "quantity": 1.0, "trade_time": t})
              for t in (2**63 - 1, -(2**63), 253_402_300_800_000, 0)]
    df = layers.bronze(texts(spark, *bodies))
    assert rows(df, "trade_time", "year") == sorted(
        [(0, 1970), (2**63 - 1, None), (-(2**63), None), (253_402_300_800_000, None)],
        key=lambda r: str(r[0]),
    )
    assert rows(layers.silver(df), "year") == [(1970,)]
