"""Replace-by-key into partitioned parquet, safe against lost executors and replays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.operators.upsert import replaced_by_key
from tapeworks.schemas import CANDLE_DAY
from tapeworks.storage import discard, exists


def replace_by_key(
    batch: DataFrame,
    path: str,
    keys: list[str],
    moment: str,
    staging: str,
    slice_by: str = CANDLE_DAY,
    spark: SparkSession | None = None,
    settle: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> None:
    """Merge ``batch`` into the table at ``path``: equal keys are replaced.

    The table is partitioned by ``slice_by``, the day of ``moment``; only the days that
    the batch touches are read and rewritten. Each step ends in a complete folder:

    1. the batch itself, so that its plan runs once;
    2. the touched days after the merge;
    3. the same days published over the table.

    Publishing replaces folders one by one. If it is interrupted, the next attempt with
    the same ``staging`` finds step 2 complete and publishes it again, instead of
    merging into a half-replaced table.

    ``settle`` may correct the rows whose key is stored already: it gets the incoming rows
    and the stored ones of the touched days and returns the rows to merge.

    ``batch`` holds each key once. Inside a stream pass the outer session as ``spark``:
    the session of a micro-batch runs without adaptive planning.
    """
    spark = spark or batch.sparkSession
    schema = batch.withColumn(slice_by, F.to_date(moment)).schema
    incoming_path, merged_path = f"{staging}/incoming", f"{staging}/merged"
    if not exists(spark, f"{merged_path}/_SUCCESS"):
        sliced = batch.withColumn(slice_by, F.to_date(moment))
        sliced.write.mode("overwrite").parquet(incoming_path)
        incoming = spark.read.schema(schema).parquet(incoming_path)
        merged = incoming
        if exists(spark, path):
            # One value per calendar day of the batch; as literals they prune the scan.
            days = [row[0] for row in incoming.select(slice_by).distinct().collect()]
            stored = spark.read.schema(schema).parquet(path).filter(F.col(slice_by).isin(days))
            if settle:
                incoming = settle(incoming, stored).select(*incoming.columns)
            merged = replaced_by_key(stored, incoming, keys)
        (
            merged.hint("rebalance", F.col(slice_by))
            .write.mode("overwrite")
            .partitionBy(slice_by)
            .parquet(merged_path)
        )
    (
        spark.read.schema(schema)
        .parquet(merged_path)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(slice_by)
        .parquet(path)
    )
    discard(spark, staging)
