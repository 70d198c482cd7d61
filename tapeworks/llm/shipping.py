"""Functions over Arrow batches in tasks that need this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import tapeworks

_ARCHIVE = "tapeworks.zip"


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | T.StructType,
) -> DataFrame:
    """``mapInArrow`` after the package's code has been handed to the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def ship(spark: SparkSession) -> None:
    """Give the executors the package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if any(name.endswith(f"/{_ARCHIVE}") for name in context.listFiles):
        return
    root = os.path.dirname(os.path.abspath(tapeworks.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tapeworks-code-"), _ARCHIVE)
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
