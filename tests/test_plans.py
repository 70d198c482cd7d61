"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from catalog import storage
from catalog.registry import QUERIES
from tapeworks import fixed_values as fv
from tapeworks.functions.labels import same_symbol
from tapeworks.operators.candles import to_candles
from tapeworks.operators.dedup import distinct_trades, first_row_per_key
from tapeworks.operators.gaps import missing_candles
from tapeworks.operators.trades import standardized_trades, valid_trades
from tapeworks.plans import layers
from tapeworks.plans.market_overview import market_overview
from tapeworks.plans.marts import candle_checks
from tapeworks.plans.ohlc_summary import ohlc_summary
from tapeworks.plans.pipeline_health import daily_summary, pipeline_health
from tapeworks.sinks import files
from tapeworks.sources.files import candle_table, silver_days
from tests.helpers import DAY, at, candle, candles, plan, records

WRITING = {name for name in vars(storage) if name in QUERIES}


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    from tapeworks.streaming.drains import CANDLE_KEYS
    from tapeworks.sinks.keyed import replace_by_key

    root = tmp_path_factory.mktemp("fact")
    made = candles(spark, candle("A", at("10:00:00")), candle("B", at("10:00:00")))
    replace_by_key(made, str(root / "t"), CANDLE_KEYS, "candle_start_time", str(root / "s"))
    return candle_table(spark, str(root / "t"))


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze") / "t")
    records(spark, ("A", 1.0, 1.0, at("10:00:00"), True)).write.parquet(path)
    return spark.read.parquet(path)


def test_overview_reads_the_horizon_once(fact):
    text = plan(market_overview(fact, at("12:00:00")))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "GreaterThanOrEqual(candle_start_time" in text
    assert "PartitionFilters: [isnotnull(candle_day" in text
    assert "Join" not in text and "SortAggregate" not in text


def test_summary_has_one_shuffle_and_no_join(fact):
    text = plan(ohlc_summary(fact))
    assert "Join" not in text
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1 and text.count("Window [") == 1


def test_health_holds_no_day_in_a_task(fact):
    text = plan(pipeline_health(fact, at("12:00:00"), ordered=False))
    assert text.count("FileScan") == 2 and text.count("Window [") == 1
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert all("_day" not in line.split("windowspecdefinition")[1] for line in windows)
    assert "struct<candle_start_time:timestamp,symbol:string>" in text  # the totals' scan


def test_daily_summary_needs_no_distinct(fact):
    text = plan(daily_summary(fact))
    assert "distinct" not in text and text.count("FileScan") == 1


def test_gaps_build_no_spine(fact):
    text = plan(missing_candles(fact))
    assert "Join" not in text and "Cartesian" not in text and text.count("FileScan") == 1


@pytest.mark.parametrize("trade_id", [None, "trade_time"])
def test_candles_are_hashed_before_the_shuffle(bronze, trade_id):
    timed = bronze.selectExpr("*", "timestamp_millis(trade_time) as trade_timestamp")
    text = plan(to_candles(timed, trade_id=trade_id))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2
    assert text.index("Exchange") < text.index("partial_min_by")


def test_cleaning_reaches_the_scan(bronze):
    text = plan(valid_trades(bronze).select("symbol"))
    for pushed in ("GreaterThan(price,0.0)", "LessThan(price,1000000.0)", "IsNotNull(symbol)"):
        assert pushed in text


def test_dedup_hashes_fixed_width_rows_and_limits_others(bronze):
    typed = standardized_trades(bronze)
    hashed = plan(distinct_trades(typed.drop("source")))
    assert "SortAggregate" not in hashed and "Window" not in hashed
    ranked = plan(distinct_trades(typed))
    assert ranked.count("WindowGroupLimit") == 2


def test_top_row_is_limited_before_the_shuffle(fact):
    text = plan(first_row_per_key(fact, ["symbol"], fact["candle_start_time"].desc()))
    assert text.count("WindowGroupLimit") == 2


def test_a_day_lists_only_its_partition(spark, bronze, path):
    files.reload_slices(layers.silver(bronze), path, fv.SILVER_PARTITIONS)
    text = plan(silver_days(spark, path, DAY.date()).select("symbol"))
    assert "(1 paths)" in text and f"{path}/year=2024/month=3/day=1]" in text
    assert "ReadSchema: struct<symbol:string>" in text
    assert silver_days(spark, path, DAY.date().replace(year=2001)).count() == 0


def test_symbol_filter_reaches_the_scan(fact):
    text = plan(fact.filter(same_symbol(F.col("symbol"), "btcUSDT")))
    assert "PushedFilters: [In(symbol, [BTCUSDT,btcUSDT,btcusdt])]" in text


def test_checks_scan_once(fact):
    assert plan(candle_checks(fact)).count("FileScan") == 1


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_rows_and_no_cross_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for banned in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text
