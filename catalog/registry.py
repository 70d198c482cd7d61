"""Registration of a query together with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Zone-free timestamps, the type of the given tables and of the oracle."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def query(sql: str) -> Callable[[Query], Query]:
    """Register the decorated function under its name."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(spark, sf_dir))

        QUERIES[build.__name__] = run
        ORACLES[build.__name__] = sql
        return run

    return register
