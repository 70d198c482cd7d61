"""Catalog tables, views and JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv
from tapeworks.operators.upsert import absent_by_key


def rebuild_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table by the result; at ``path`` if given."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def view(df: DataFrame, name: str) -> None:
    """A view of the session: the plan is kept, not the rows."""
    df.createOrReplaceTempView(name)


def jdbc_write_options(options: dict, connections: int = 16, chunk: int = fv.JDBC_CHUNK) -> dict:
    """Chunked inserts over a bounded number of connections."""
    return {**options, "batchsize": str(chunk), "numPartitions": str(connections)}


def jdbc_append(df: DataFrame, options: dict, columns: tuple[str, ...] | None = None, **limits) -> None:
    """Append the given columns.

    The number of connections is also the number of tasks that compute ``df`` where no
    shuffle stands before the write: store a costly frame first.
    """
    chosen = df.select(*columns) if columns else df
    chosen.write.format("jdbc").options(**jdbc_write_options(options, **limits)).mode("append").save()


def jdbc_append_absent(
    df: DataFrame, options: dict, keys: list[str], bounded_by: str, **limits
) -> None:
    """Append only the rows whose key the table lacks, so that a replay adds nothing.

    The keys already stored are read back for the range of ``bounded_by`` that ``df``
    covers; the database applies that filter. ``df`` is used twice: pass a stored one.
    """
    low, high = df.agg(F.min(bounded_by), F.max(bounded_by)).first()
    if low is None:
        return
    stored = df.sparkSession.read.format("jdbc").options(**options).load()
    stored = stored.filter(F.col(bounded_by).between(F.lit(low), F.lit(high)))
    jdbc_append(absent_by_key(df, stored, keys), options, **limits)
