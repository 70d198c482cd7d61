"""Data checks: each returns the offending rows; a verdict counts them."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """The values, all NULL, of the rows that lack ``column``."""
    return df.filter(F.col(column).isNull()).select(column)


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter("n_records > 1")
    )


def key_checks(df: DataFrame, not_null: dict[str, str], unique: dict[str, list[str]]) -> DataFrame:
    """Verdicts on key columns from a single scan, one row per check.

    ``not_null`` names a check for each column, ``unique`` the columns that a check takes
    together; a key that lacks a part is no repeated one. Rows are counted per value of
    all these columns, on the map side first, and the checks follow from the counts.
    A check of uniqueness takes all of the columns that the other checks take.
    """
    columns = list(dict.fromkeys([*not_null, *(c for taken in unique.values() for c in taken)]))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    found = {
        check: F.sum(F.when(F.col(column).isNull(), F.col("_rows")).otherwise(0))
        for column, check in not_null.items()
    }
    for check, taken in unique.items():
        if set(taken) != set(columns):
            raise ValueError(f"{check}: a unique key of other columns needs a scan of its own")
        whole = reduce(and_, [F.col(c).isNotNull() for c in taken])
        found[check] = F.count_if(whole & (F.col("_rows") > 1))
    totals = counted.agg(*[F.coalesce(v, F.lit(0)).alias(k) for k, v in found.items()])
    listed = F.array(*[F.struct(F.lit(k).alias("check"), F.col(f"`{k}`").alias("failures")) for k in found])
    return totals.select(F.inline(listed)).withColumns(
        {"should_warn": F.col("failures") != 0, "should_error": F.col("failures") != 0}
    )


def verdict(failing: DataFrame) -> DataFrame:
    """One row: how many rows fail, and whether that warrants a warning or an error."""
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        "failures",
        (F.col("failures") != 0).alias("should_warn"),
        (F.col("failures") != 0).alias("should_error"),
    )


def null_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Not-null verdicts of many columns from a single scan, one row per column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "failures").withColumns(
        {"should_warn": F.col("failures") != 0, "should_error": F.col("failures") != 0}
    )
