"""Checks by the write itself: proofs, exact counts, and versions that do not appear."""

import pytest
from pyspark.sql import functions as F

from tapeworks.operators.checks import key_checks
from tapeworks.sinks import checked, snapshots
from tests.helpers import rows

KEYS = ({"k": "k not null"}, {"k unique": ["k"]})


def never():
    raise AssertionError("a proven table was read again")


def checks(df, path, read=None, buckets=checked.BUCKETS, keys=KEYS):
    spark = df.sparkSession
    return checked.write_checked(
        df,
        lambda frame: frame.write.mode("overwrite").parquet(path),
        read or (lambda: spark.read.schema(df.schema).parquet(path)),
        *keys,
        buckets,
    )


def test_a_small_unique_key_is_proven_without_reading(spark, path):
    df = spark.range(60).select(F.concat(F.lit("S"), "id").alias("k"), "id")
    found = checks(df, path, never)
    assert rows(found) == [("k not null", 0, False, False), ("k unique", 0, False, False)]
    assert spark.read.parquet(path).count() == 60


@pytest.mark.parametrize("n", [50, 20_000])
def test_planted_repeats_are_counted_exactly(spark, path, n):
    """Of 20,000 keys many share a bit without being equal."""
    once = spark.range(n).select(F.col("id").cast("string").alias("k"))
    hot = spark.range(n // 2).select(F.lit("7").alias("k"))
    pair = spark.createDataFrame([("11",), ("13",), (None,), (None,)], "k string")
    df = once.unionByName(hot).unionByName(pair)
    found = checks(df, path)
    assert rows(found) == rows(key_checks(df, *KEYS))
    assert rows(found, "check", "failures") == [("k not null", 2), ("k unique", 3)]


def test_only_open_buckets_are_read(spark, path, monkeypatch):
    seen = []
    exact = checked._repeated
    monkeypatch.setattr(checked, "_repeated", lambda *a: seen.append(a[2]) or exact(*a))
    df = spark.range(40).union(spark.createDataFrame([(3,)], "id long")).toDF("k")
    assert rows(checks(df, path), "failures") == [(0,), (1,)]
    assert [len(numbers) for numbers in seen] == [1]


def test_compound_keys_with_missing_parts(spark, path):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 2), ("b", None), ("b", None), (None, None)], "s string, t int"
    )
    keys = ({"s": "s not null", "t": "t not null"}, {"unique": ["s", "t"]})
    assert rows(checks(df, path, keys=keys)) == rows(key_checks(df, *keys))


def test_empty_tables_hold(spark, path):
    for df in (spark.createDataFrame([], "k string"), spark.range(9).toDF("k").filter("k > 20")):
        assert rows(checks(df, path, never), "failures") == [(0,), (0,)]


def test_a_version_that_fails_is_not_published(spark, path):
    good = spark.range(5).select(F.col("id").cast("string").alias("k"))
    checked.replace_checked(good, path, *KEYS)
    with pytest.raises(checked.ChecksFailed, match="k unique"):
        checked.replace_checked(good.unionByName(good), path, *KEYS)
    now = snapshots.current(spark, path)
    assert now.version == 1
    assert rows(snapshots.read(spark, now)) == rows(good)
    told = checked.replace_checked(good.unionByName(good), path, *KEYS, strict=False)
    assert rows(told, "check", "failures") == [("k not null", 0), ("k unique", 5)]
    assert snapshots.read(spark, snapshots.current(spark, path)).count() == 10
