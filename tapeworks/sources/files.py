"""Partitioned parquet, as a batch or a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.storage import exists


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    max_files: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """A file stream of the declared columns. ``max_files`` bounds its micro-batches.

    Files are taken in the order of their modification time, so a bounded batch pushes a
    watermark past files that are not read yet, and their rows are dropped. The bound is
    for steps without a watermark; ``plans.backfill`` works a large backlog off day by day.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path).select(*columns_of(schema))


def columns_of(schema: str) -> list[str]:
    """The column names of a declared schema."""
    return [column.split()[0] for column in schema.split(",")]


def _live(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The parts that streams wrote; a backlog and late rows went through all layers already."""
    parts = parquet_stream(spark, path, f"{schema}, {schemas.RUN} string")
    run = F.col(schemas.RUN)
    done = (run == schemas.BACKLOG) | run.startswith(f"{schemas.LATE}-")
    return parts.filter(~done).drop(schemas.RUN)


def bronze_stream(spark: SparkSession, path: str) -> DataFrame:
    """Bronze files of streams, unbounded: silver keeps a watermark over them."""
    return _live(spark, path, schemas.BRONZE)


def silver_stream(spark: SparkSession, path: str) -> DataFrame:
    """Silver files of streams, unbounded: candles keep a watermark over them."""
    return _live(spark, path, schemas.SILVER)


def parquet_tree(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All parquet files below ``path``, whatever their depth and columns.

    Partition folders become columns. With a declared schema its columns are returned.
    Without one the footers are merged, so a file lacking a column yields NULL for it.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path).select(*columns_of(schema))
    return spark.read.option("mergeSchema", "true").parquet(path)


def day_folder(day: dt.date) -> str:
    return f"year={day.year}/month={day.month}/day={day.day}"


def silver_days(
    spark: SparkSession, path: str, first: dt.date, last: dt.date | None = None
) -> DataFrame:
    """Silver trades of the given days; only their folders are listed."""
    days = range((last or first).toordinal() - first.toordinal() + 1)
    folders = [f"{path}/{day_folder(first + dt.timedelta(days=k))}" for k in days]
    there = [folder for folder in folders if exists(spark, folder)]
    if not there:
        return spark.createDataFrame([], schemas.SILVER)
    reader = spark.read.schema(schemas.SILVER).option("basePath", path)
    return reader.parquet(*there).select(*columns_of(schemas.SILVER))


def candle_table(spark: SparkSession, path: str) -> DataFrame:
    """The candle table as written by the keyed sink, with its day partition."""
    return spark.read.schema(f"{schemas.CANDLE}, {schemas.CANDLE_DAY} date").parquet(path)
