"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # One clock everywhere: calendar parts and day boundaries are UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesced shuffles, skew splits, joins broadcast only
    # once the measured size of a side allows it.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Dedup keys do not fit the heap of an executor: keep stream state on its disk and
# upload changelogs instead of whole snapshots.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Settings for a step that is stored: its shuffle files go as soon as it is written, and
# Arrow batches of whole texts stay small, in the executors and in their Python workers.
STEP_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}
PARTITIONS = "spark.sql.shuffle.partitions"
_STARTING = threading.Lock()
_LOCAL_FOLDERS: dict[str, str] = {}


def build(app_name: str = "tapeworks", **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` entries win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def stream_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings for a stream that is started inside the block.

    A stream copies its settings when it starts and splits its state for good into the
    session's number of shuffle partitions, or into ``partitions``. State settings made
    by the caller stand. Streams are started one after the other, so that none sees the
    settings of another.
    """
    with _STARTING:
        wanted = {k: v for k, v in STATE_SETTINGS.items() if spark.conf.get(k, None) is None}
        if partitions:
            wanted[PARTITIONS] = str(partitions)
        with _set(spark, wanted):
            yield


@contextmanager
def step_settings(spark: SparkSession) -> Iterator[None]:
    """``STEP_SETTINGS`` for what is run inside the block."""
    with _set(spark, STEP_SETTINGS):
        yield


@contextmanager
def _set(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def pin_utc(spark: SparkSession) -> SparkSession:
    """Put an existing session on UTC, which every plan here assumes."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, a master whose executors are threads of the driver gets a folder
    of this machine, one per application; any other has to name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="tapeworks-")
    return _LOCAL_FOLDERS[application]


def scratch(spark: SparkSession, label: str) -> str:
    """A path nobody used before, below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
