"""Versioned tables whose scans read only the files that may hold what is asked for.

``put`` lays the rows of every slice along a Z-order curve of some columns, so that a file
holds a box of them, and writes statistics of each file beside the manifest: least and
greatest value of these columns, and for columns that are asked for by value a Bloom filter
in blocks. ``scan`` first filters the statistics, a small table of its own, and then reads
the files that are left; the rows are those of the plain filter.

Parts without statistics (appended or compacted since) are always read, so any writer of
``sinks.snapshots`` may work on the same table.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.sinks import snapshots
from tapeworks.sinks.snapshots import Part, Snapshot
from tapeworks.storage import discard

#: A column is cut into 2 ** BITS ranges of about equally many rows.
BITS = 8
ROWS_PER_FILE = 1_000_000
#: Bits of a Bloom block, the fixed size of Spark's bitmaps, and bits set per value in it.
BLOCK_BITS = 32_768
HASHES = 4
BITS_PER_VALUE = 10
#: Folders of statistics that are merged into one when there are as many.
FAN_IN = 8

_PLACE, _TIE, _FILE = "_place", "_tie", "_file"


@dataclass(frozen=True)
class Between:
    """Values from ``low`` to ``high``, both included; None is no bound."""

    low: Any = None
    high: Any = None


@dataclass(frozen=True)
class OneOf:
    values: tuple

    def __init__(self, *values: Any):
        object.__setattr__(self, "values", values)


Where = Mapping[str, Between | OneOf]


def put(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    slice_by: str | None = None,
    slices: Collection[str | None] | None = None,
    lookup: Sequence[str] = (),
    rows_per_file: int = ROWS_PER_FILE,
) -> Snapshot:
    """``df`` as the whole table, or in the place of ``slices``, clustered by ``by``.

    ``lookup`` names columns that get a Bloom filter. Files are ranges of (slice, curve, hash
    of the row), so neither a frequent value nor many equal rows end in one task.
    """
    spark = df.sparkSession
    base = snapshots.current(spark, path)
    kind = df.schema
    rows, placed = _placed(df, by)
    files = max(1, math.ceil(rows / rows_per_file))
    order = [*([slice_by] if slice_by else []), _PLACE, _TIE]
    ranged = (
        placed.withColumn(_TIE, F.xxhash64(*kind.names))
        .repartitionByRange(files, *order)
        .sortWithinPartitions(*order[:-1], *by)
        .drop(_PLACE, _TIE)
    )
    made = snapshots.stage_as_dealt(ranged, path, slice_by)
    kept: list[Part] = []
    known: dict[str, list[str]] = {}
    if slices is not None:
        if beyond := {part.slice for part in made}.difference(slices):
            raise ValueError(f"rows of slices that are not replaced: {sorted(map(str, beyond))}")
        kept = [part for part in base.parts if part.slice not in slices] if base else []
        known = _live(json.loads(base.notes.get("stats", "{}")) if base else {}, kept)
    if made:
        columns = [*dict.fromkeys([*by, *([slice_by] if slice_by else [])])]
        blocks = max(1, math.ceil(min(rows, rows_per_file) * BITS_PER_VALUE / BLOCK_BITS))
        folder = _write_statistics(spark, path, made, kind, columns, lookup, blocks)
        known[folder] = sorted({_root(part) for part in made})
    if len(known) >= FAN_IN:
        known = _merged(spark, path, known, kept + made)
    notes = {"stats": json.dumps(known)}
    return snapshots.publish(spark, path, base, [*kept, *made], kind, slice_by, notes=notes)


def scan(spark: SparkSession, snapshot: Snapshot, where: Where) -> DataFrame:
    """The rows of a version for which every condition of ``where`` holds."""
    kind = T.StructType.fromJson(json.loads(snapshot.schema))
    paths = files(spark, snapshot, where)
    found = spark.read.schema(kind).parquet(*paths) if paths else spark.createDataFrame([], kind)
    return found.filter(_all(_holds(F.col(name), asked) for name, asked in where.items()))


def files(spark: SparkSession, snapshot: Snapshot, where: Where) -> list[str]:
    """The files that may hold such rows, and the folders of parts without statistics.

    The driver holds the names of what is read, as it does for any scan.
    """
    kind = T.StructType.fromJson(json.loads(snapshot.schema))
    known = json.loads(snapshot.notes.get("stats", "{}"))
    told = {root for roots in known.values() for root in roots}
    plain = [part.folder for part in snapshot.parts if _root(part) not in told]
    chosen: set[str] = set()
    live = {part.folder for part in snapshot.parts}
    for folder in known:
        own = _statistics(spark, snapshot.path, folder)
        ranges = own.filter(_all(_may_hold(own, kind, name, asked) for name, asked in where.items()))
        for name, asked in where.items():
            if isinstance(asked, OneOf) and name in _looked_up(own):
                ranges = ranges.join(
                    _in_blooms(spark, snapshot.path, folder, kind[name], asked, own), _FILE, "left_semi"
                )
        for row in ranges.select(_FILE).collect():
            if row[_FILE].rsplit("/", 1)[0] in live:
                chosen.add(row[_FILE])
    return [f"{snapshot.path}/{name}" for name in [*plain, *sorted(chosen)]]


def _all(conditions) -> Column:
    return reduce(and_, conditions, F.lit(True))


def _holds(column: Column, asked: Between | OneOf) -> Column:
    if isinstance(asked, OneOf):
        return column.isin(*asked.values) if asked.values else F.lit(False)
    bounds = []
    if asked.low is not None:
        bounds.append(column >= F.lit(asked.low))
    if asked.high is not None:
        bounds.append(column <= F.lit(asked.high))
    return _all([column.isNotNull(), *bounds])


def _may_hold(own: DataFrame, kind: T.StructType, name: str, asked: Between | OneOf) -> Column:
    """Whether the range of a file meets what is asked; a column without a range may."""
    if f"low_{name}" not in own.columns:
        return F.lit(True)
    low, high = F.col(f"low_{name}"), F.col(f"high_{name}")
    if isinstance(asked, OneOf):
        inside = [(low <= F.lit(v)) & (high >= F.lit(v)) for v in asked.values if v is not None]
        return reduce(or_, inside, F.lit(False))
    bounds = [low.isNotNull()]
    if asked.low is not None:
        bounds.append(high >= F.lit(asked.low))
    if asked.high is not None:
        bounds.append(low <= F.lit(asked.high))
    return _all(bounds)


def _placed(df: DataFrame, by: Sequence[str]) -> tuple[int, DataFrame]:
    """The number of rows, and ``df`` with each row's place on the curve.

    One pass finds the cuts of every column, which are as many at every size.
    """
    shares = [k / 2**BITS for k in range(1, 2**BITS)]
    numbers = {name: _number(df, name) for name in by}
    told = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.percentile_approx(number, shares, 2**14).alias(name) for name, number in numbers.items()],
    ).first()
    place = F.lit(0).cast("long")
    for turn, (name, number) in enumerate(numbers.items()):
        bucket = _bucket(number, told[name] or [])
        for bit in range(BITS):
            own = F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place + F.shiftleft(own, bit * len(by) + turn)
    return told["rows"], df.withColumn(_PLACE, place)


def _number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column; of texts the first seven bytes count."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        seven = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0")
        return F.conv(seven, 16, 10).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, T.BooleanType):
        return column.cast("int")
    return column


def _bucket(number: Column, cuts: Sequence) -> Column:
    """How many cuts are not above the number, by bisection; 0 for NULL."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(cut) for cut in cuts])
    steps = F.array(*[F.lit(2**bit) for bit in reversed(range(BITS))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda below, step: below
        + F.when(F.get(bounds, below + step - F.lit(1)) <= number, step).otherwise(F.lit(0)),
    )


def _root(part: Part) -> str:
    """The folder one ``put`` has written; its slices lie below."""
    return "/".join(part.folder.split("/")[:2])


def _live(known: dict[str, list[str]], parts: Collection[Part]) -> dict[str, list[str]]:
    """The folders of statistics that still tell of one of ``parts``."""
    roots = {_root(part) for part in parts}
    kept = {folder: [root for root in own if root in roots] for folder, own in known.items()}
    return {folder: own for folder, own in kept.items() if own}


def _file_name() -> Column:
    """The path of a row's file below the table. Paths come encoded, but for the plus sign."""
    encoded = F.substring_index(F.col("_metadata.file_path"), "/parts/", -1)
    return F.concat(F.lit("parts/"), F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))))


def _write_statistics(
    spark: SparkSession, path: str, made: list[Part], kind: T.StructType,
    columns: Sequence[str], lookup: Sequence[str], blocks: int,
) -> str:
    """Ranges and Bloom blocks of the files of ``made``; only these columns are read."""
    folder = f"statistics/{uuid.uuid4().hex}"
    stored = spark.read.schema(kind).parquet(*[f"{path}/{part.folder}" for part in made])
    named = stored.select(*dict.fromkeys([*columns, *lookup]), _file_name().alias(_FILE))
    bounds = [
        bound for name in columns
        for bound in (F.min(name).alias(f"low_{name}"), F.max(name).alias(f"high_{name}"))
    ]
    named.groupBy(_FILE).agg(
        F.count(F.lit(1)).alias("rows"),
        *bounds,
        F.lit(blocks).alias("blocks"),
        F.lit(",".join(lookup)).alias("lookup"),
    ).write.parquet(f"{path}/{folder}/ranges")
    for name in lookup:
        value = F.col(name)
        (
            named.filter(value.isNotNull())
            .select(_FILE, _block(value, blocks).alias("block"), F.explode(_spots(value)).alias("spot"))
            .groupBy(_FILE, "block")
            .agg(F.bitmap_construct_agg("spot").alias("bits"))
            .write.parquet(f"{path}/{folder}/blooms/{name}")
        )
    return folder


def _block(value: Column, blocks: int | Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(blocks) if isinstance(blocks, int) else blocks)


def _spots(value: Column) -> Column:
    return F.array(
        *[F.pmod(F.xxhash64(value, F.lit(k)), F.lit(BLOCK_BITS)) for k in range(HASHES)]
    )


def _statistics(spark: SparkSession, path: str, folder: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{folder}/ranges")


def _looked_up(own: DataFrame) -> set[str]:
    told = own.select("lookup").first()
    return set(told["lookup"].split(",")) - {""} if told else set()


def _in_blooms(
    spark: SparkSession, path: str, folder: str, field: T.StructField, asked: OneOf, own: DataFrame
) -> DataFrame:
    """The files whose filter has all bits of one of the values. One block is read per value."""
    values = [F.lit(v).cast(field.dataType) for v in asked.values if v is not None]
    blooms = spark.read.parquet(f"{path}/{folder}/blooms/{field.name}")
    blocks = own.select(F.max("blocks")).first()[0]
    return blooms.filter(
        reduce(
            or_,
            [(F.col("block") == _block(value, blocks)) & _all_set(value) for value in values],
            F.lit(False),
        )
    ).select(_FILE)


def _all_set(value: Column) -> Column:
    def is_set(spot: Column) -> Column:
        byte = F.substring(F.col("bits"), (F.floor(spot / 8) + 1).cast("int"), F.lit(1))
        number = F.conv(F.hex(byte), 16, 10).cast("int")
        return F.call_function("getbit", number, (spot % 8).cast("int")) == 1

    return F.forall(_spots(value), is_set)


def _merged(
    spark: SparkSession, path: str, known: dict[str, list[str]], parts: Collection[Part]
) -> dict[str, list[str]]:
    """The statistics of all live files in one folder per layout of their columns."""
    live = spark.createDataFrame([(part.folder,) for part in parts], "folder string")
    layouts: dict[tuple, list[str]] = {}
    for folder in known:
        own = _statistics(spark, path, folder)
        first = own.select("lookup", "blocks").first()
        layout = (tuple(own.columns), first["lookup"], first["blocks"])
        layouts.setdefault(layout, []).append(folder)
    made: dict[str, list[str]] = {}
    for (_, lookup, _blocks), group in layouts.items():
        target = group[0]
        if len(group) > 1:
            target = f"statistics/{uuid.uuid4().hex}"
            for kind in ("ranges", *[f"blooms/{name}" for name in lookup.split(",") if name]):
                every = spark.read.parquet(*[f"{path}/{folder}/{kind}" for folder in group])
                own = F.regexp_replace(_FILE, "/[^/]*$", "")
                every.join(live, own == F.col("folder"), "left_semi").write.parquet(
                    f"{path}/{target}/{kind}"
                )
        made[target] = sorted({root for folder in group for root in known[folder]})
    return made


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """``snapshots.expire``, and the statistics that no kept version names."""
    before = snapshots.versions(spark, path)
    named = [set(json.loads(snapshots.load(spark, path, v).notes.get("stats", "{}"))) for v in before]
    gone = snapshots.expire(spark, path, keep)
    stale = set().union(*named[:-keep]) - set().union(*named[-keep:])
    for folder in stale:
        discard(spark, f"{path}/{folder}")
    return [*gone, *sorted(stale)]
