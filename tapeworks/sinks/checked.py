"""Checks made while a table is written, and tables that appear only when they hold.

Missing keys are counted by the write itself (``DataFrame.observe``). For unique keys it
fills a sketch of fixed size: a bitmap of hashed keys per bucket. A bucket with as many
set bits as rows has no key twice, which is a proof; only the keys of the other buckets
are read again, that column alone, and counted exactly. Small key sets, such as symbols
or days, are as a rule proven; of a very large one most buckets are read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapeworks.sinks import snapshots

BUCKETS = 16
_BITS = 32_768  # of one bitmap aggregate

VERDICT = "check string, failures bigint, should_warn boolean, should_error boolean"


class ChecksFailed(ValueError):
    """The rows that were staged do not hold; ``verdicts`` says which check."""

    def __init__(self, path: str, verdicts: DataFrame) -> None:
        failed = {r["check"]: r["failures"] for r in verdicts.collect() if r["should_error"]}
        super().__init__(f"{path} was not published: {failed}")
        self.verdicts = verdicts


def _whole(columns: list[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def _slot(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets * _BITS))


def _bucket(columns: list[str], buckets: int) -> Column:
    return F.floor(_slot(columns, buckets) / _BITS).cast("int")


def write_checked(
    df: DataFrame,
    write: Callable[[DataFrame], None],
    read: Callable[[], DataFrame],
    not_null: dict[str, str],
    unique: dict[str, list[str]],
    buckets: int = BUCKETS,
) -> DataFrame:
    """Write ``df`` and return the verdicts on its keys, one row per check.

    ``not_null`` names a check for each column, ``unique`` the columns that a check takes
    together; a key that lacks a part is no repeated one. ``failures`` counts rows without
    a value, and values that repeat. ``write`` stores what it is given in one job and
    without a shuffle, for a stage before a shuffle counts again what it does again;
    ``read`` returns what was stored, and is called only if a sketch leaves keys open.
    """
    watched = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in not_null]
    for check, taken in unique.items():
        whole, bucket = _whole(taken), _bucket(taken, buckets)
        bit = F.pmod(_slot(taken, buckets), F.lit(_BITS))
        for number in range(buckets):
            inside = whole & (bucket == number)
            marked = F.bitmap_construct_agg(F.when(inside, bit))
            metrics.append(F.count_if(inside).alias(f"rows {number} {check}"))
            metrics.append(F.bitmap_count(marked).alias(f"bits {number} {check}"))
    write(df.observe(watched, *metrics))
    # Of a plan that Spark finds empty nothing is observed.
    found = watched.get or {}
    failures = {check: found.get(f"null {c}", 0) for c, check in not_null.items()}
    for check, taken in unique.items():
        open_buckets = [
            n
            for n in range(buckets)
            if found.get(f"rows {n} {check}", 0) != found.get(f"bits {n} {check}", 0)
        ]
        failures[check] = _repeated(read(), taken, open_buckets, buckets) if open_buckets else 0
    return _verdicts(df.sparkSession, failures)


def _repeated(stored: DataFrame, taken: list[str], open_buckets: list[int], buckets: int) -> int:
    """How many keys of these buckets occur more than once; rows are combined per task."""
    keys = stored.select(*taken).filter(_whole(taken))
    if len(open_buckets) < buckets:
        keys = keys.filter(_bucket(taken, buckets).isin(open_buckets))
    counted = keys.groupBy(*taken).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter("_rows > 1").count()


def _verdicts(spark: SparkSession, failures: dict[str, int]) -> DataFrame:
    rows = [(check, n, n != 0, n != 0) for check, n in failures.items()]
    return spark.createDataFrame(rows, VERDICT)


def rebuild_checked(
    df: DataFrame, path: str, not_null: dict[str, str], unique: dict[str, list[str]]
) -> DataFrame:
    """Replace a whole parquet table, as ``files.rebuild``, and return the verdicts."""
    spark, schema = df.sparkSession, df.schema
    return write_checked(
        df,
        lambda rows: rows.write.mode("overwrite").parquet(path),
        lambda: spark.read.schema(schema).parquet(path),
        not_null,
        unique,
    )


def replace_checked(
    df: DataFrame,
    path: str,
    not_null: dict[str, str],
    unique: dict[str, list[str]],
    strict: bool = True,
    **notes: str,
) -> DataFrame:
    """A new version of a versioned table, published only if all its checks hold.

    Otherwise ``ChecksFailed``: readers stay with the version before, the staged part
    belongs to none. With ``strict=False`` it is published whatever the verdicts.
    """
    spark, schema = df.sparkSession, df.schema
    base, staged = snapshots.current(spark, path), []

    def stored() -> DataFrame:
        return spark.read.schema(schema).parquet(*[f"{path}/{part.folder}" for part in staged])

    verdicts = write_checked(
        df, lambda rows: staged.extend(snapshots.stage(rows, path)), stored, not_null, unique
    )
    if strict and not verdicts.filter("should_error").isEmpty():
        raise ChecksFailed(path, verdicts)
    snapshots.publish(spark, path, base, staged, schema, notes=notes)
    return verdicts
