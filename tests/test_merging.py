"""Tables merged when read: equal to upserts one after the other, with little written."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeworks.operators.upsert import upsert
from tapeworks.sinks import merging, snapshots
from tests.helpers import at, plan, rows

TABLE = "k string, d date, a int, b string, updated_at timestamp"
DAY = dt.date(2024, 3, 1)


def table(spark, *given):
    return spark.createDataFrame([(k, DAY, a, b, None) for k, a, b in given], TABLE)


def loads(spark):
    """Repeated keys, new keys, nulls as values, keys without a part, fewer columns."""
    one = spark.createDataFrame(
        [("x", DAY, 10, None, 1), ("x", DAY, 11, "n", 2), ("new", DAY, 1, "c", 1), (None, DAY, 7, "q", 1)],
        "k string, d date, a int, b string, v int",
    )
    two = spark.createDataFrame([("x", DAY, None, 1), ("z", DAY, 5, 1)], "k string, d date, a int, v int")
    three = spark.createDataFrame(
        [("new", DAY, "late", 1), (None, DAY, "again", 1)], "k string, d date, b string, v int"
    )
    return [one, two, one.limit(0), three]


@pytest.mark.parametrize("share", [0.0, 0.9, 100.0])
def test_reads_equal_upserts_in_turn(spark, path, share):
    expected = table(spark, ("x", 1, "a"), ("y", 2, "b"), (None, 3, "c"), *[(f"r{i}", i, "r") for i in range(6)])
    merging.create(expected, path, ["k", "d"])
    for number, updates in enumerate(loads(spark)):
        now = F.lit(at(f"0{number}:00:00"))
        for _ in range(2):  # the second time it is there already
            merging.put(updates, path, [F.desc("v")], f"load-{number}", now, share)
        expected = upsert(expected, updates, ["k", "d"], [F.desc("v")], now=now)
        snapshot = snapshots.current(spark, path)
        assert rows(merging.read(spark, snapshot)) == rows(expected)
    levels = {part.level for part in snapshot.parts}
    assert (0 in levels) == (share == 100.0 or (share == 0.9 and snapshot.notes["delta_rows"] != "0"))
    merging.fold(spark, path)
    assert rows(merging.read(spark, snapshots.current(spark, path))) == rows(expected)


def test_an_empty_table_takes_its_first_rows(spark, path):
    merging.create(table(spark), path, ["k", "d"])
    merging.put(loads(spark)[1], path, [F.desc("v")], "first", share=100.0)
    found = merging.read(spark, snapshots.current(spark, path))
    assert rows(found, "k", "a", "b", "updated_at") == [("x", None, None, None), ("z", 5, None, None)]


def test_a_load_writes_its_own_rows_only(spark, path):
    base = spark.range(5000).select(
        F.col("id").cast("string").alias("k"), F.lit(DAY).alias("d"), F.col("id").cast("int").alias("a"),
        F.lit("b").alias("b"), F.lit(None).cast("timestamp").alias("updated_at"),
    )
    first = merging.create(base, path, ["k", "d"])
    second = merging.put(loads(spark)[1], path, [F.desc("v")], "one")
    new = set(second.parts) - set(first.parts)
    assert set(first.parts) < set(second.parts)
    assert sum(spark.read.parquet(f"{path}/{p.folder}").count() for p in new) == 2
    assert second.notes["delta_rows"] == "2"
    # The base is joined where it lies: no exchange above its scan but the union's.
    found = merging.read(spark, second)
    found.collect()
    assert "BroadcastHashJoin" in plan(found) and "SortMergeJoin" not in plan(found).split("Initial Plan")[0]


def test_a_second_writer_is_told(spark, path, monkeypatch):
    merging.create(table(spark, ("x", 1, "a")), path, ["k", "d"])
    stale = snapshots.current(spark, path)
    merging.put(loads(spark)[1], path, [F.desc("v")], "one", share=100.0)
    monkeypatch.setattr(snapshots, "current", lambda *_: stale)
    with pytest.raises(snapshots.Conflict):
        merging.put(loads(spark)[3], path, [F.desc("v")], "two", share=100.0)
