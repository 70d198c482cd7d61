"""Late rows: found in bronze, put into silver, and their candles made again."""

import pytest
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.plans import late_rows
from tapeworks.plans.backfill import backfill
from tapeworks.sources.files import candle_table, parquet_tree, silver_stream
from tapeworks.sources.messages import text_messages
from tapeworks.streaming import drains
from tests.helpers import DAY, at, records, rows

EARLY = [
    ("A", 10.0, 1.0, at("10:00:10"), False),
    ("A", 12.0, 1.0, at("10:00:50"), True),
    ("A", 11.0, 1.0, at("12:00:00"), True),
    ("B", 5.0, 2.0, at("12:30:00"), None),
]
LATE = [
    ("A", 99.0, 3.0, at("10:00:30"), False),  # inside a finished candle
    ("A", 12.0, 1.0, at("10:00:50"), True),  # a copy
    ("C", 7.0, 1.0, at("09:00:00"), False),  # a candle of its own
    ("C", -7.0, 1.0, at("09:00:00"), False),  # not valid
]


def landed(spark, path, given):
    body = F.to_json(F.struct(*records(spark, *given).columns))
    records(spark, *given).select(body.alias("value")).write.mode("append").text(path)


@pytest.fixture
def drained(spark, tmp_path):
    source, root = str(tmp_path / "landed"), str(tmp_path / "layers")
    for given in (EARLY, LATE):
        landed(spark, source, given)
        made = drains.run_layers(spark, text_messages(spark, source, streaming=True), root)
    assert made.dropped["silver"] >= 2
    return made.paths


def candle_rows(spark, path):
    return rows(candle_table(spark, path).drop("ingested_at", schemas.CANDLE_DAY))


def test_restated_candles_equal_those_of_a_batch(spark, tmp_path, drained):
    assert late_rows.late_trades(spark, drained["bronze"], drained["silver"]).count() == 2
    other = DAY.date().replace(day=2)
    assert late_rows.late_trades(spark, drained["bronze"], drained["silver"], [other]).count() == 0
    staging = str(tmp_path / "one")
    assert late_rows.restate(spark, drained, staging, [DAY.date()]) == 2
    # The same again, as after a crash, changes nothing; a new one finds nothing.
    once = candle_rows(spark, drained["candles"])
    assert late_rows.restate(spark, drained, staging) == 2
    assert candle_rows(spark, drained["candles"]) == once
    assert late_rows.restate(spark, drained, str(tmp_path / "two")) == 0
    assert parquet_tree(spark, drained["silver"], schemas.SILVER).count() == 6
    batch = str(tmp_path / "batch")
    paths = backfill(spark, text_messages(spark, str(tmp_path / "landed")), batch)
    final = [r for r in candle_rows(spark, paths["candles"]) if r[0] < at("12:20:00")]
    assert once == final


def test_streams_leave_late_parts_alone(spark, tmp_path, drained):
    late_rows.restate(spark, drained, str(tmp_path / "one"))
    seen = silver_stream(spark, drained["silver"])
    query = seen.writeStream.format("memory").queryName("live_silver").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("live_silver").count() == 4
