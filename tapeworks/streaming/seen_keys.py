"""Dedup of a stream against a table of the keys it has seen, instead of operator state.

A stateful dedup shuffles every row to the state of its key, so a key repeated by a third
of the rows loads one task. Here a micro-batch is first made distinct like a batch, which
leaves one row per key and input task before the shuffle, and then anti-joined with the
keys of earlier micro-batches. These are 128 bits each, in slices of event time under a
manifest (``sinks.snapshots``); a slice is left out of the table one micro-batch after the
watermark has passed it, and keys behind the next watermark are not stored at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks import fixed_values as fv
from tapeworks.operators.dedup import distinct_trades
from tapeworks.operators.upsert import absent_by_key
from tapeworks.sinks import snapshots
from tapeworks.sinks.snapshots import RUN_NUMBER, Snapshot
from tapeworks.storage import discard

_SLICE, _HIGH, _LOW = "slice_start", "key_high", "key_low"
_LATE = "_late"


class SeenKeys:
    """The keys that one stream has let pass, below ``path``.

    ``moment`` is one of ``keys`` and the event time. As for ``dropDuplicates`` behind a
    watermark, rows at or behind it, taken from earlier micro-batches, are dropped; NULL
    keys equal one another, and a row without a ``moment`` is never behind. Unlike there, no
    row of the first micro-batch is behind, also none of 1970 or before. One writer.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = fv.DEDUP_KEYS,
        moment: str = "trade_timestamp",
        lateness: str = fv.LATENESS,
        slice_ms: int = 600_000,
        keep: int = 2,
    ):
        if moment not in keys:
            raise ValueError(f"{moment} is no key: equal keys could lie on both sides of the watermark")
        self.spark, self.path, self.keys, self.moment = spark, path, list(keys), moment
        self.slice_ms, self.keep = slice_ms, keep
        zero = F.lit("1970-01-01").cast("timestamp")
        self.lateness_ms = spark.range(1).select(
            F.unix_millis(zero + F.expr(f"INTERVAL {lateness}"))
        ).first()[0]

    def admit(self, batch: DataFrame, run: str, earliest_by: str = "ingest_timestamp") -> tuple[DataFrame, int]:
        """The rows of ``batch`` whose key passes for the first time, stored, and the number
        of different late keys. ``run`` names the micro-batch: delivered again it passes the same keys.

        ``record`` has to follow before the next micro-batch.
        """
        before = snapshots.current(self.spark, self.path)
        watermark = self._watermark(before, run)
        late = F.lit(False)
        if watermark is not None:
            late = F.coalesce(F.unix_millis(self.moment) <= F.lit(watermark), F.lit(False))
        single = distinct_trades(batch.withColumn(_LATE, late), self.keys, earliest_by)
        known = self._known(before, run, watermark)
        if known is not None:
            start, high, low = self._digest()
            # A late row has no slice here, so it is counted whether its key is known or not.
            narrow = {_SLICE: F.when(~F.col(_LATE), start), _HIGH: high, _LOW: low}
            single = absent_by_key(single.withColumns(narrow), known, [_SLICE, _HIGH, _LOW])
        staging = f"{self.path}/staging/{run}"
        single.select(*batch.columns, _LATE).write.mode("overwrite").parquet(staging)
        staged = self.spark.read.schema(T.StructType([*batch.schema, T.StructField(_LATE, T.BooleanType())])).parquet(staging)
        return staged.filter(~F.col(_LATE)).drop(_LATE), staged.filter(_LATE).count()

    def record(self, passed: DataFrame, run: str) -> Snapshot:
        """Add the keys of ``passed``, that is what ``admit`` gave, and move the watermark."""
        before = snapshots.current(self.spark, self.path)
        if before and run in before.runs:
            return before
        latest = passed.agg(F.max(F.unix_millis(self.moment))).first()[0]
        passed_by = self._watermark(before, run)
        reached = None if latest is None else latest - self.lateness_ms
        watermark = max([mark for mark in (passed_by, reached) if mark is not None], default=None)
        number = int(before.notes["number"]) + 1 if before else 1
        keys = passed.select(
            *[part.alias(name) for part, name in zip(self._digest(), (_SLICE, _HIGH, _LOW))],
            F.lit(number).cast("long").alias(RUN_NUMBER),
            F.unix_millis(self.moment).alias("_ms"),
        )
        if watermark is not None:
            keys = keys.filter(F.col("_ms").isNull() | (F.col("_ms") > F.lit(watermark)))
        keys = keys.drop("_ms")
        made = snapshots.stage(keys, self.path, _SLICE, number)
        # Those that this micro-batch was judged by stay, should it be delivered again.
        kept = [part for part in before.parts if self._open(part.slice, passed_by)] if before else []
        notes = {
            "number": str(number),
            "watermark": "" if watermark is None else str(watermark),
            "watermark_before": "" if passed_by is None else str(passed_by),
        }
        # Only the last micro-batch can be delivered again, so its name is all that is kept.
        snapshots.publish(self.spark, self.path, before, [*kept, *made], keys.schema, _SLICE, (run,), notes)
        discard(self.spark, f"{self.path}/staging/{run}")
        snapshots.compact(self.spark, self.path)
        snapshots.expire(self.spark, self.path, self.keep)
        return snapshots.current(self.spark, self.path)

    def _digest(self) -> tuple[Column, Column, Column]:
        """The slice of a key and two hashes of it. A hash passes over NULLs, so they are told."""
        told = [F.col(key).isNull() for key in self.keys]
        start = F.unix_millis(self.moment)
        return (
            F.coalesce(start - F.pmod(start, F.lit(self.slice_ms)), F.lit(-1).cast("long")),
            F.xxhash64(*self.keys, *told),
            F.xxhash64(F.lit("second hash"), *told, *self.keys),
        )

    def _watermark(self, before: Snapshot | None, run: str) -> int | None:
        """What was known before the micro-batch ``run``."""
        if before is None:
            return None
        told = before.notes["watermark_before" if run in before.runs else "watermark"]
        return int(told) if told else None

    def _open(self, start: str, watermark: int | None) -> bool:
        return int(start) < 0 or watermark is None or int(start) + self.slice_ms > watermark

    def _known(self, before: Snapshot | None, run: str, watermark: int | None) -> DataFrame | None:
        if before is None:
            return None
        found = snapshots.read(
            self.spark, before, [s for s in before.slices if self._open(s, watermark)]
        )
        if run in before.runs:
            found = found.filter(F.col(RUN_NUMBER) < F.lit(int(before.notes["number"])))
        return found.drop(RUN_NUMBER)
