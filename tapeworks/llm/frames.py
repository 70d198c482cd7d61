"""Helpers on frames that the operators share: free column names, stored steps, exact
running totals over many tasks, and the way back from a narrow plan to whole rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from contextvars import ContextVar

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks import session, storage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The code points of [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"

#: Rows that one task orders at a time, on average.
LANE_ROWS = 20_000
#: Lanes per key, as a power of two, however small the table is: enough to spread one
#: key that holds most of the rows.
LEAST_LANE_BITS = 8
#: Bits of the filter of wanted row keys; a full one lets others pass.
FILTER_BITS = 1 << 24
#: Paths of the steps stored since the innermost ``concluded`` began.
_STEPS: ContextVar[list[str] | None] = ContextVar("steps", default=None)
_BEFORE = (Window.unboundedPreceding, -1)


def free(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores added where ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    It cuts the lineage: what is built on it is not computed again when an executor is
    lost, and a result that depends on the order of arrival stays as it was. The shuffle
    files behind it go when it is written.
    """
    path = session.scratch(df.sparkSession, label)
    with session.step_settings(df.sparkSession):
        df.write.parquet(path)
    if (steps := _STEPS.get()) is not None:
        steps.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def concluded(build: Callable[[], DataFrame], label: str) -> DataFrame:
    """``build()``, stored; the steps that ``build`` stores are discarded then.

    No frame that it leaves to others may read these steps.
    """
    outer, own = _STEPS.get(), []
    token = _STEPS.set(own)
    try:
        result = stored(build(), label)
    finally:
        _STEPS.reset(token)
    for path in own[:-1]:
        storage.discard(result.sparkSession, path)
    if outer is not None:
        outer.append(own[-1])
    return result


def tasks(df: DataFrame) -> int:
    """The number of shuffle partitions the session asks for."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def whole_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64 bits of a row's id and text; equal rows have equal keys."""
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), whole_text(text))


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bit for each ``row_key``, as a bitmap of ``FILTER_BITS`` bits."""
    place = F.pmod(F.col("row_key"), F.lit(FILTER_BITS)).alias("place")
    bit = F.expr("shiftleft(1L, cast(place & 31 AS int))")
    words = keys.select(place).groupBy(F.shiftright("place", 5).alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )
    with session.step_settings(keys.sparkSession):
        found = words.toArrow()
    bitmap = np.zeros(FILTER_BITS // 32, np.uint32)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return bitmap


def passing(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which row keys a filter lets pass: all that are in it, and some others."""
    place = np.mod(keys, len(bitmap) * 32)
    return ((bitmap[place >> 5] >> (place & 31).astype(np.uint32)) & 1).astype(bool)


def lane_bits(rows: int) -> int:
    return max(LEAST_LANE_BITS, math.ceil(math.log2(max(1, rows / LANE_ROWS))))


def running(
    df: DataFrame,
    keys: list[str],
    spread: str,
    ties: list[str],
    value: Column,
    name: str,
    bits: int,
) -> DataFrame:
    """Add ``name``: the total of ``value`` over the rows of the same ``keys`` before it.

    The order is that of ``spread``, a hash of 64 bits, then of ``ties``. A key is cut
    into 2**bits lanes by the leading bits of the hash; each lane is summed on its own and
    the lanes' totals are added up in a table of one row per key and lane. So no task
    sees a whole key. ``keys`` and ``spread`` are never NULL; ``df`` is read twice.
    """
    (lane, base) = free(df, "lane", "lane_base")
    laned = df.withColumn(lane, F.shiftrightunsigned(F.col(spread), 64 - bits))
    sums = laned.groupBy(*keys, lane).agg(F.sum(value).alias(base))
    of_key = Window.partitionBy(*keys).orderBy(lane).rowsBetween(*_BEFORE)
    bases = sums.withColumn(base, F.coalesce(F.sum(base).over(of_key), F.lit(0)))
    in_lane = Window.partitionBy(*keys, lane).orderBy(spread, *ties).rowsBetween(*_BEFORE)
    summed = laned.withColumn(name, F.coalesce(F.sum(value).over(in_lane), F.lit(0)))
    return (
        summed.join(bases, [*keys, lane])
        .withColumn(name, F.col(name) + F.col(base))
        .drop(lane, base)
    )


def first_rows(docs: DataFrame, key: str, nth: str) -> DataFrame:
    """``docs`` with ``key``, one row of those that have the same."""
    nth_row = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return docs.withColumn(key, row_key()).withColumn(nth, nth_row).filter(F.col(nth) == 1)


def attach(docs: DataFrame, plan: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``docs`` with ``columns`` of ``plan``, which has one row for each row of ``docs``.

    ``key`` of ``plan`` is ``row_key`` of the row. Rows with the same key are told apart
    by counting them on both sides, so repeated rows each get a row of the plan of their
    own. The text is shuffled once.
    """
    (own, nth, rows) = free(docs, "row_key", "nth_row", "planned_rows")
    counted = docs.withColumn(own, row_key()).withColumn(
        nth, F.row_number().over(Window.partitionBy(own).orderBy(own))
    )
    planned = plan.groupBy(F.col(key).alias(own)).agg(
        F.sort_array(F.collect_list(F.struct(*columns))).alias(rows)
    )
    one = F.element_at(F.col(rows), F.col(nth))
    return counted.join(planned, own).select(
        *docs.columns, *(one[c].alias(c) for c in columns)
    )
