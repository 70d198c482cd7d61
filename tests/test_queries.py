"""Every registered query against its SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from catalog import layers
from catalog.registry import ORACLES, QUERIES
from tapeworks.operators.gaps import missing_candles
from tapeworks.plans.pipeline_health import hourly_ingestion
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = contract.queries()[name](spark, sf_dir)
    assert differences(df, contract.oracle_sql()[name], con) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_candle_invariants(spark, sf_dir):
    fact = layers.candles(spark, sf_dir)
    low, high = F.col("low_price"), F.col("high_price")
    sides = F.col("buy_volume_taker") + F.col("sell_volume_maker")
    sound = (
        F.col("open_price").between(low, high)
        & F.col("close_price").between(low, high)
        & (sides == F.col("total_volume"))
    )
    assert fact.filter(~sound).count() == 0
    trades = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert fact.agg(F.sum("trade_count")).first()[0] == trades


def test_gaps_agree_with_the_missing_counts(spark, sf_dir):
    fact = layers.candles(spark, sf_dir)
    hour = F.date_trunc("hour", "missing_minute").alias("ingestion_hour")
    listed = missing_candles(fact).groupBy("symbol", hour).agg(F.count("*").alias("listed"))
    counted = hourly_ingestion(fact).select("symbol", "ingestion_hour", "missing_candles")
    both = counted.join(listed, ["symbol", "ingestion_hour"], "left").fillna(0, ["listed"])
    assert both.filter("missing_candles <> listed").count() == 0
