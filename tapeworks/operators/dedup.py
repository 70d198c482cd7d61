"""Removing repeated rows, in batch and in a stream."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks import fixed_values as fv

# Room for a hash of 64 bits behind a number, within 38 digits.
_ROOM = Decimal(10) ** 19

# Column types that Spark aggregates in place, in a hash map.
_FIXED_WIDTH = (
    T.NumericType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def first_row_per_key(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of every key under ``order``.

    The rank filter becomes a group limit before the shuffle too, so a key holding a
    large part of all rows sends one row per input task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def distinct_trades(
    trades: DataFrame,
    keys: Sequence[str] = fv.DEDUP_KEYS,
    earliest_by: str = "ingest_timestamp",
) -> DataFrame:
    """One row per key, the one that arrived first.

    Of copies that arrived at the same instant the one whose columns hash lowest stays.
    Copies are collapsed inside each input task before the shuffle. When every other
    column is of fixed width this is a hash aggregate. A text column would turn it into
    a sort of all rows twice over; then a ranked group limit is no worse.
    """
    payload = [f for f in trades.schema.fields if f.name not in keys]
    arrival = _arrival(trades, earliest_by)
    turn = F.xxhash64(*[f.name for f in payload])
    if all(isinstance(f.dataType, _FIXED_WIDTH) for f in payload):
        # All of these see the same rows in the same order, hence they agree on the row
        # they keep.
        order = arrival.cast("decimal(19,0)") * F.lit(_ROOM) + turn.cast("decimal(19,0)")
        kept = trades.groupBy(*keys).agg(
            *[F.min_by(f.name, order).alias(f.name) for f in payload]
        )
        return kept.select(*trades.columns)
    return first_row_per_key(trades, keys, arrival, turn)


def _arrival(df: DataFrame, name: str) -> Column:
    """A time or integral column as a number; min_by skips NULL, so NULL goes last."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        column = F.unix_micros(column.cast("timestamp"))
    return F.coalesce(column, F.lit(2**63 - 1))


def collapsed_batches(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose key an earlier row of the same Arrow batch has. No shuffle, no state."""
    names = list(keys)

    # Nested on purpose: it travels to the executors by value and needs no package there.
    def first_copies(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            columns = {name: batch.column(name) for name in names}
            row = pa.array(np.arange(batch.num_rows))
            groups = pa.table({**columns, "_row": row}).group_by(names).aggregate([("_row", "min")])
            first = groups.column("_row_min").combine_chunks()
            yield batch if len(first) == batch.num_rows else batch.take(first.sort())

    return df.mapInArrow(first_copies, df.schema)


def distinct_trades_stream(
    trades: DataFrame,
    keys: Sequence[str] = fv.DEDUP_KEYS,
    moment: str = "trade_timestamp",
    lateness: str = fv.LATENESS,
    collapse: bool = False,
) -> DataFrame:
    """Streaming dedup: the first arrival of a key passes, later ones do not.

    ``moment`` is one of the keys, so a key leaves the state once the watermark passes
    it. A stateful dedup has no partial step before its shuffle: a key repeated by a
    third of a micro-batch would load a single task. For such feeds ``collapse`` drops
    copies inside each Arrow batch first, which leaves one row of such a key per some
    thousand. The result is the same. Built-in operators could only do this with a second
    state store on salted keys, which made the whole dedup nearly twice as slow.
    """
    if collapse:
        trades = collapsed_batches(trades, keys)
    return trades.withWatermark(moment, lateness).dropDuplicates([*keys])
