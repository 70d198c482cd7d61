"""Keyed tables that are merged when they are read.

A table is a base, sorted by key, and the updates since as small delta parts, one per
load, under the manifests of ``sinks.snapshots``. ``put`` writes rows in proportion to
the update; ``read`` joins the deltas, folded to one row per key, to the base, which is
not shuffled while they are small enough to be broadcast. When the deltas outgrow a share
of the base, ``put`` folds them into a new one. The rows are those of ``operators.upsert.upsert``
applied load by load.

Keys of the base are unique. A key that lacks a part equals no other, as in ``upsert``.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.functions.moments import as_moment
from tapeworks.operators.dedup import first_row_per_key
from tapeworks.sinks import snapshots
from tapeworks.sinks.snapshots import RUN_NUMBER, Part, Snapshot
from tapeworks.storage import discard

#: Deltas are folded when they hold more rows than this share of the base.
SHARE = 0.2

_GIVEN, _IN_BASE, _APPLIED = "_given", "_in_base", "_applied"
_DELTA = f"{RUN_NUMBER} bigint, {_GIVEN} array<string>, {_IN_BASE} boolean, {_APPLIED} timestamp"


def create(df: DataFrame, path: str, keys: list[str], stamp: str = "updated_at") -> Snapshot:
    """The first version, or a whole new one: ``df``, whose keys are unique, as the base."""
    spark = df.sparkSession
    base = snapshots.current(spark, path)
    return _publish_base(df, path, base, keys, stamp, base.runs if base else ())


def put(
    updates: DataFrame,
    path: str,
    latest_by: list[Column],
    run: str,
    now: Column | None = None,
    share: float = SHARE,
) -> Snapshot:
    """Apply ``updates`` as the load ``run``; a load that is there already adds nothing.

    Insert, replacement, stamp and ``latest_by`` are those of ``upsert``: new keys get an
    empty stamp, of a known key the columns in ``updates`` are replaced, nulls included.
    """
    spark = updates.sparkSession
    before = snapshots.current(spark, path)
    if run in before.runs:
        return before
    keys, stamp = json.loads(before.notes["keys"]), before.notes["stamp"]
    kind = T.StructType.fromJson(json.loads(before.schema))
    known = [c for c in _columns(before) if c != stamp]
    given = [c for c in updates.columns if c in known]
    incoming = f"{path}/incoming/{uuid.uuid4().hex}"
    first_row_per_key(updates, keys, *latest_by).select(*given).write.parquet(incoming)
    fresh = spark.read.parquet(incoming)
    number = len(before.runs) + 1
    rows = _told_in_base(fresh, before, keys).select(
        *[
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in kind.fields
            if f.name in _columns(before)
        ],
        F.lit(number).cast("long").alias(RUN_NUMBER),
        F.array(*[F.lit(c) for c in given]).alias(_GIVEN),
        _IN_BASE,
        as_moment(now).alias(_APPLIED),
    )
    made = snapshots.stage(rows.sortWithinPartitions(*keys), path, run=number)
    held = sum(spark.read.parquet(f"{path}/{part.folder}").count() for part in made)
    waiting = int(before.notes["delta_rows"]) + held
    after = snapshots.publish(
        spark, path, before, [*before.parts, *made], kind, None, (*before.runs, run),
        before.notes | {"delta_rows": str(waiting)},
    )
    discard(spark, incoming)
    return fold(spark, path) if waiting > share * int(before.notes["base_rows"]) else after


def read(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """The rows of a version, deltas applied."""
    keys, stamp = json.loads(snapshot.notes["keys"]), snapshot.notes["stamp"]
    columns = _columns(snapshot)
    base = _base(spark, snapshot).select(*columns)
    if not _deltas(snapshot):
        return base
    folded = _folded(spark, snapshot, keys, stamp)
    values = [c for c in columns if c not in keys and c != stamp]

    def value(c: str, otherwise: Column) -> Column:
        chosen = F.col(f"_new_{c}")
        return F.when(chosen.isNotNull(), chosen[c]).otherwise(otherwise)

    stored = base.join(folded.drop(_IN_BASE, "_loads"), keys, "left").select(
        *keys,
        *[value(c, F.col(c)).alias(c) for c in values],
        F.coalesce(_APPLIED, stamp).alias(stamp),
    )
    added = folded.filter(~F.col(_IN_BASE)).select(
        *keys,
        *[value(c, F.lit(None)).alias(c) for c in values],
        F.when(F.col("_loads") > 1, F.col(_APPLIED)).alias(stamp),
    )
    return stored.unionByName(added).select(*columns)


def fold(spark: SparkSession, path: str) -> Snapshot:
    """Write base and deltas as a new base. Readers go on with the version they have."""
    base = snapshots.current(spark, path)
    if not _deltas(base):
        return base
    keys, stamp = json.loads(base.notes["keys"]), base.notes["stamp"]
    return _publish_base(read(spark, base), path, base, keys, stamp, base.runs)


def _columns(snapshot: Snapshot) -> list[str]:
    names = T.StructType.fromJson(json.loads(snapshot.schema)).names
    return [c for c in names if c not in (RUN_NUMBER, _GIVEN, _IN_BASE, _APPLIED)]


def _deltas(snapshot: Snapshot) -> list[Part]:
    return [part for part in snapshot.parts if part.level == 0]


def _parts(spark: SparkSession, snapshot: Snapshot, parts: list[Part]) -> DataFrame:
    kind = T.StructType.fromJson(json.loads(snapshot.schema))
    if not parts:
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(*[f"{snapshot.path}/{part.folder}" for part in parts])


def _base(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    return _parts(spark, snapshot, [part for part in snapshot.parts if part.level > 0])


def _told_in_base(fresh: DataFrame, before: Snapshot, keys: list[str]) -> DataFrame:
    """``fresh`` with whether the base holds the key.

    Of the base only key columns are read, and of its sorted files only those that can
    hold a first key between the least and the greatest of the update.
    """
    stored = _base(fresh.sparkSession, before).select(*keys)
    low, high = fresh.agg(F.min(keys[0]), F.max(keys[0])).first()
    if low is not None:
        stored = stored.filter(F.col(keys[0]).between(F.lit(low), F.lit(high)))
    found = stored.join(fresh.select(*keys), keys, "left_semi").withColumn(_IN_BASE, F.lit(True))
    flagged = fresh.join(found, keys, "left")
    return flagged.withColumn(_IN_BASE, F.coalesce(_IN_BASE, F.lit(False)))


def _folded(spark: SparkSession, snapshot: Snapshot, keys: list[str], stamp: str) -> DataFrame:
    """One row per key of the deltas: of each column the newest value that was given."""
    alone = reduce(or_, [F.col(key).isNull() for key in keys])
    values = [c for c in _columns(snapshot) if c not in keys and c != stamp]
    newest = [
        F.max_by(F.struct(c), F.when(F.array_contains(_GIVEN, c), F.col(RUN_NUMBER))).alias(f"_new_{c}")
        for c in values
    ]
    found = _parts(spark, snapshot, _deltas(snapshot)).withColumn(
        "_alone", F.when(alone, F.col(RUN_NUMBER))
    )
    return (
        found.groupBy(*keys, "_alone")
        .agg(
            *newest,
            F.max(_IN_BASE).alias(_IN_BASE),
            F.max_by(_APPLIED, RUN_NUMBER).alias(_APPLIED),
            F.count(F.lit(1)).alias("_loads"),
        )
        .drop("_alone")
    )


def _publish_base(
    df: DataFrame, path: str, base: Snapshot | None, keys: list[str], stamp: str, runs: tuple[str, ...]
) -> Snapshot:
    """``df`` in ranges of the key, sorted. The hash parts rows that all lack a key."""
    spark = df.sparkSession
    kind = T.StructType([*df.schema.fields, *T.DataType.fromDDL(_DELTA).fields])
    ranged = df.repartitionByRange(*keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)
    made = [
        Part(part.folder, part.slice, 1, 0, len(runs)) for part in snapshots.stage(ranged, path)
    ]
    held = sum(spark.read.parquet(f"{path}/{part.folder}").count() for part in made)
    notes = {"keys": json.dumps(keys), "stamp": stamp, "base_rows": str(held), "delta_rows": "0"}
    return snapshots.publish(spark, path, base, made, kind, None, runs, notes)
