"""Keyed insert-or-replace between two DataFrames."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.moments import as_moment
from tapeworks.operators.dedup import first_row_per_key


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    latest_by: list[Column],
    stamp: str = "updated_at",
    now: Column | None = None,
) -> DataFrame:
    """``target`` with ``updates`` applied.

    New keys are inserted with an empty ``stamp``. On a known key the columns present
    in ``updates`` replace the stored ones, nulls included, and ``stamp`` is set. When
    a key is updated more than once the first row under ``latest_by`` wins.
    """
    order_columns = [c for c in updates.columns if c in target.columns]
    fresh = first_row_per_key(updates, keys, *latest_by).select(*order_columns)
    replaced = [c for c in order_columns if c not in keys]
    incoming = fresh.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in replaced], F.lit(True).alias("_incoming")
    )
    stored = target.withColumn("_stored", F.lit(True))
    joined = stored.join(incoming, keys, "full_outer")
    hit = F.col("_incoming").isNotNull()
    conflict = hit & F.col("_stored").isNotNull()

    def result(column: str) -> Column:
        if column in keys:
            return F.col(column)
        if column == stamp:
            return F.when(conflict, as_moment(now)).otherwise(F.col(stamp)).alias(stamp)
        if column in replaced:
            return F.when(hit, F.col(f"_new_{column}")).otherwise(F.col(column)).alias(column)
        return F.col(column)

    return joined.select(*[result(c) for c in target.columns])


def replaced_by_key(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """``stored`` without the rows whose key ``incoming`` carries, plus ``incoming``.

    NULL is a key like any other.
    """
    kept = _without(stored, incoming, keys)
    return kept.select(*incoming.columns).unionByName(incoming)


def absent_by_key(incoming: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``incoming`` whose key is not stored yet."""
    return _without(incoming, stored, keys)


def _without(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    taken = others.select(*[F.col(key).alias(f"_{key}") for key in keys])
    equal = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    return rows.join(taken, equal, "left_anti")
