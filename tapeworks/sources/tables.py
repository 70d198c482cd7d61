"""Catalog tables and tables behind JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the catalog."""
    return spark.table(name)


def jdbc_options(url: str, name: str, driver: str, **extra: str) -> dict:
    """Connection options; ``user`` and ``password`` are passed through ``extra``."""
    return {"url": url, "dbtable": name, "driver": driver, **extra}


def jdbc_table(
    spark: SparkSession,
    options: dict,
    split_by: str | None = None,
    bounds: tuple[str, str] | None = None,
    splits: int = 32,
) -> DataFrame:
    """A remote table. ``split_by`` with ``bounds`` reads it in parallel ranges instead
    of through one connection; filters and column selection are pushed to the database."""
    reader = spark.read.format("jdbc").options(**options)
    if split_by and bounds:
        reader = reader.options(
            partitionColumn=split_by,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=str(splits),
        )
    return reader.load()
