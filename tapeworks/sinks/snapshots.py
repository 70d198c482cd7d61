"""Tables of immutable parts, published by switching a manifest.

A table is a folder with ``parts``, complete parquet folders that are never changed, and
``manifests``, one small file per version that lists the parts of the whole table. Writers
first write new parts, which nobody reads yet, and then the next manifest, in one step; so
readers find the old or the new table, whole, wherever a writer is killed. Two writers
that start from the same version cannot both publish: the second gets ``Conflict``.

A part belongs to one slice, the value of a column (a day, say). A version that replaces
some slices lists the parts of the others again, unread; what changed between two versions is
told by their manifests. Appended rows carry the number of their run, so parts may be
merged by levels while readers follow the table run by run (``since``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Iterable
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.storage import children, discard, read_text, write_once

#: Number of the run that appended a row.
RUN_NUMBER = "run_number"
_SLICE = "_slice"
_NONE = "__HIVE_DEFAULT_PARTITION__"
#: Parts of one level and slice that are merged into one of the next level.
FAN_IN = 4


class Conflict(RuntimeError):
    """Another writer has published since the base version was read."""


@dataclass(frozen=True)
class Part:
    folder: str
    slice: str | None = None
    level: int = 0
    first_run: int = 0
    last_run: int = 0


@dataclass(frozen=True)
class Snapshot:
    """One version of a table. ``notes`` are the writer's own, kept with the version."""

    path: str
    version: int
    schema: str
    parts: tuple[Part, ...]
    slice_by: str | None = None
    runs: tuple[str, ...] = ()
    notes: dict[str, str] = field(default_factory=dict)

    @property
    def slices(self) -> set[str | None]:
        return {part.slice for part in self.parts}


def _manifest(path: str, version: int) -> str:
    return f"{path}/manifests/{version:020d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    names = children(spark, f"{path}/manifests")
    return [int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit()]


def load(spark: SparkSession, path: str, version: int) -> Snapshot:
    told = json.loads(read_text(spark, _manifest(path, version)))
    parts = tuple(Part(**part) for part in told.pop("parts"))
    runs = tuple(told["runs"])
    return Snapshot(path, version, told["schema"], parts, told["slice_by"], runs, told["notes"])


def current(spark: SparkSession, path: str) -> Snapshot | None:
    """The newest version, or None before the first."""
    known = versions(spark, path)
    return load(spark, path, known[-1]) if known else None


def read(
    spark: SparkSession, snapshot: Snapshot, slices: Collection[str | None] | None = None
) -> DataFrame:
    """The rows of a version; with ``slices``, only of these, and no other part is listed."""
    return _rows(spark, snapshot, [p for p in snapshot.parts if slices is None or p.slice in slices])


def _rows(spark: SparkSession, snapshot: Snapshot, parts: Iterable[Part]) -> DataFrame:
    kind = T.StructType.fromJson(json.loads(snapshot.schema))
    folders = [f"{snapshot.path}/{part.folder}" for part in parts]
    if not folders:
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(*folders)


def stage(df: DataFrame, path: str, slice_by: str | None = None, run: int = 0) -> list[Part]:
    """Write ``df`` as new parts, one per value of ``slice_by``; nobody reads them yet.

    The rebalance gathers a slice into few files and splits one that holds most rows.
    """
    if slice_by is not None:
        df = df.hint("rebalance", F.col(slice_by))
    return stage_as_dealt(df, path, slice_by, run)


def stage_as_dealt(df: DataFrame, path: str, slice_by: str | None = None, run: int = 0) -> list[Part]:
    """The same without a shuffle: every task writes the slices it has."""
    spark, name = df.sparkSession, f"parts/{uuid.uuid4().hex}"
    if slice_by is None:
        df.write.parquet(f"{path}/{name}")
        return [Part(name, None, 0, run, run)]
    sliced = df.withColumn(_SLICE, F.col(slice_by).cast("string"))
    sliced.write.partitionBy(_SLICE).parquet(f"{path}/{name}")
    found = []
    for folder in children(spark, f"{path}/{name}"):
        key, _, value = folder.partition("=")
        if key == _SLICE:
            own = None if value == _NONE else unquote(value)
            found.append(Part(f"{name}/{folder}", own, 0, run, run))
    return found


def publish(
    spark: SparkSession,
    path: str,
    base: Snapshot | None,
    parts: Iterable[Part],
    schema: T.StructType,
    slice_by: str | None = None,
    runs: Iterable[str] = (),
    notes: dict[str, str] | None = None,
) -> Snapshot:
    """Make ``parts`` the table, if ``base`` is still its newest version."""
    version = base.version + 1 if base else 1
    made = Snapshot(path, version, schema.json(), tuple(parts), slice_by, tuple(runs), notes or {})
    told = {
        "schema": made.schema,
        "parts": [asdict(part) for part in made.parts],
        "slice_by": made.slice_by,
        "runs": list(made.runs),
        "notes": made.notes,
    }
    if not write_once(spark, _manifest(path, version), json.dumps(told)):
        raise Conflict(f"version {version} of {path} is there already")
    return made


def replace(df: DataFrame, path: str, slice_by: str | None = None, **notes: str) -> Snapshot:
    """A whole new table in the place of the old one."""
    spark = df.sparkSession
    base = current(spark, path)
    return publish(spark, path, base, stage(df, path, slice_by), df.schema, slice_by, notes=notes)


def replace_slices(
    df: DataFrame, path: str, slice_by: str, slices: Collection[str | None], **notes: str
) -> Snapshot:
    """``df`` in the place of all rows of ``slices``; other slices are not read.

    A slice without a row in ``df`` ends empty. ``df`` may have rows of ``slices`` only.
    """
    spark = df.sparkSession
    base = current(spark, path)
    made = stage(df, path, slice_by) if slices else []
    if beyond := {part.slice for part in made}.difference(slices):
        raise ValueError(f"rows of slices that are not replaced: {sorted(map(str, beyond))}")
    kept = [part for part in base.parts if part.slice not in slices] if base else []
    return publish(spark, path, base, [*kept, *made], df.schema, slice_by, notes=notes)


def touched(before: Snapshot | None, after: Snapshot) -> set[str | None]:
    """The slices whose parts differ between two versions."""
    own = {part.folder: part.slice for part in after.parts}
    other = {part.folder: part.slice for part in before.parts} if before else {}
    return {own.get(folder, other.get(folder)) for folder in own.keys() ^ other.keys()}


def append(df: DataFrame, path: str, slice_by: str, run: str) -> Snapshot:
    """Add the rows of ``run`` as parts of level 0; a run that is there already adds nothing.

    So a micro-batch that is delivered twice stands once. ``run_number`` is added to the
    rows, and grows by one with every run.
    """
    spark = df.sparkSession
    base = current(spark, path)
    if base and run in base.runs:
        return base
    runs = (*base.runs, run) if base else (run,)
    numbered = df.withColumn(RUN_NUMBER, F.lit(len(runs)).cast("long"))
    made = stage(numbered, path, slice_by, len(runs))
    parts = [*(base.parts if base else ()), *made]
    notes = base.notes if base else None
    return publish(spark, path, base, parts, numbered.schema, slice_by, runs, notes)


def since(spark: SparkSession, snapshot: Snapshot, run_number: int) -> DataFrame:
    """The rows of runs behind ``run_number``, each once, merged or not."""
    some = [part for part in snapshot.parts if part.last_run > run_number]
    return _rows(spark, snapshot, some).filter(F.col(RUN_NUMBER) > run_number)


def compact(spark: SparkSession, path: str, fan_in: int = FAN_IN) -> Snapshot | None:
    """Merge parts by levels until no slice has ``fan_in`` parts of one level.

    n appended runs leave at most ``fan_in`` - 1 parts on each of about log n levels, and a
    row is written once per level. All merges of a round are published by one switch; where
    another writer was faster, the round starts again from the new version.
    """
    while True:
        base = current(spark, path)
        full = _full_levels(base, fan_in) if base else {}
        if not full:
            return base
        gone = {part for group in full.values() for part in group}
        made = []
        for level in {level for _, level in full}:
            made += _merged(spark, base, level, {k[0]: g for k, g in full.items() if k[1] == level})
        kept = [part for part in base.parts if part not in gone]
        kind = T.StructType.fromJson(json.loads(base.schema))
        try:
            publish(spark, path, base, [*kept, *made], kind, base.slice_by, base.runs, base.notes)
        except Conflict:
            for part in made:
                discard(spark, f"{path}/{part.folder}")


def _full_levels(base: Snapshot, fan_in: int) -> dict[tuple[str | None, int], list[Part]]:
    found: dict[tuple[str | None, int], list[Part]] = {}
    for part in base.parts:
        found.setdefault((part.slice, part.level), []).append(part)
    return {key: group for key, group in found.items() if len(group) >= fan_in}


def _merged(spark: SparkSession, base: Snapshot, level: int, groups: dict) -> list[Part]:
    """New parts of the next level, of all slices by one job."""
    rows = _rows(spark, base, [part for group in groups.values() for part in group])
    return [
        Part(
            part.folder, part.slice, level + 1,
            min(p.first_run for p in groups[part.slice]), max(p.last_run for p in groups[part.slice]),
        )
        for part in stage(rows, base.path, base.slice_by)
    ]


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove old versions and the parts that no kept one lists, also those a killed writer
    left. Not while a writer is at work: its new parts are in no manifest yet."""
    known = versions(spark, path)
    kept = [load(spark, path, version) for version in known[-keep:]]
    for version in known[:-keep]:
        discard(spark, _manifest(path, version))
    used = {part.folder for snapshot in kept for part in snapshot.parts}
    gone = []
    for name in children(spark, f"{path}/parts"):
        folder = f"parts/{name}"
        own = [f"{folder}/{x}" for x in children(spark, f"{path}/{folder}") if x.startswith(f"{_SLICE}=")]
        stale = [x for x in own if x not in used] if any(x in used for x in own) else [folder]
        if folder in used:
            continue
        for one in stale:
            discard(spark, f"{path}/{one}")
            gone.append(one)
    return gone
