"""Partitioned parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.schemas import BACKLOG, RUN


def reload_slices(df: DataFrame, path: str, slices: Sequence[str], gather: bool = True) -> None:
    """Write ``df`` so that it replaces exactly the partitions it has rows for.

    The rebalance hint gathers each partition into few files; the adaptive planner
    splits a partition that holds most of the rows and merges tiny ones. Without
    ``gather`` every task writes the partitions it sees, which saves the shuffle.
    """
    rows = df.hint("rebalance", *[F.col(s) for s in slices]) if gather else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*slices)
        .parquet(path)
    )


def write_run(
    df: DataFrame, path: str, slices: Sequence[str], run: str = BACKLOG, gather: bool = False
) -> None:
    """Write ``df`` as the part named ``run`` of each partition it has rows for.

    Parts of other runs stay. The same run written again replaces what it wrote, so a
    micro-batch that is delivered twice stands once, and batches and streams share a
    table without a log of files that would hide one from the readers of the other.
    """
    reload_slices(df.withColumn(RUN, F.lit(run)), path, [*slices, RUN], gather)


def rebuild(df: DataFrame, path: str) -> None:
    """Replace a whole parquet table."""
    df.write.mode("overwrite").parquet(path)


def spread_writers(df: DataFrame, slices: Sequence[str], files: int) -> DataFrame:
    """Send each partition to ``files`` writers, whatever its rows hold.

    For streams, whose shuffles are not re-planned: without it every task writes a file
    into every partition it sees, with a plain repartition one task writes a whole day.
    Rows are dealt by their place in the input (a seeded draw), so neither equal rows nor
    rows of NULLs meet in one writer.
    """
    lane = F.floor(F.rand(seed=0) * files)
    return df.withColumn("_lane", lane).repartition(*slices, "_lane").drop("_lane")
