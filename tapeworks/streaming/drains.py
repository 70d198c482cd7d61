"""Drain-and-stop runs of the layers, each with its own checkpoint.

``availableNow`` works off what has arrived and, unlike ``once``, ends with a batch that
lets the watermark release finished windows.

Every layer is written through batch callbacks into plain partitioned tables: a part of
its own for each micro-batch (``sinks.files.write_run``). So a stream goes on where
``plans.backfill`` ended, in the same tables.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks import fixed_values as fv
from tapeworks import schemas
from tapeworks.operators.trades import (
    enriched_trades,
    standardized_trades,
    valid_trades,
    with_calendar,
)
from tapeworks.operators.upsert import absent_by_key
from tapeworks.plans.layers import bronze, gold, silver
from tapeworks.session import stream_settings
from tapeworks.sinks.files import spread_writers, write_run
from tapeworks.sinks.keyed import replace_by_key
from tapeworks.sources.files import bronze_stream, parquet_tree, silver_stream
from tapeworks.storage import any_match, create
from tapeworks.streaming.seen_keys import SeenKeys

CANDLE_KEYS = ["symbol", "candle_start_time"]
_DAY = list(fv.SILVER_PARTITIONS)
_log = logging.getLogger(__name__)


@dataclass
class Drained:
    """Where the layers are, and how many rows each drain dropped behind its watermark."""

    paths: dict[str, str]
    dropped: dict[str, int] = field(default_factory=dict)


def append_parquet(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    slices: Sequence[str],
    trigger: dict | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Append a stream to parquet by ``slices``; exactly once through the file log.

    For tables that this stream alone writes: readers see the files of the log only.
    ``partitions`` is the number of state partitions of a new checkpoint.
    """
    with stream_settings(stream.sparkSession, partitions):
        return (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .partitionBy(*slices)
            .trigger(**(trigger or {"availableNow": True}))
            .start(path)
        )


def each_batch(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``write``. What it raises fails the query, so the
    checkpoint does not move past a batch that was not written."""
    with stream_settings(stream.sparkSession, partitions):
        return (
            stream.writeStream.outputMode("append")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that fell behind the watermark, in the micro-batches the query still reports."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def _drained(query: StreamingQuery, layer: str, fail_on_dropped: bool) -> int:
    query.awaitTermination()
    return _reported(dropped_rows(query), layer, fail_on_dropped)


def _reported(dropped: int, layer: str, fail_on_dropped: bool) -> int:
    if dropped and fail_on_dropped:
        raise RuntimeError(f"{dropped} rows for {layer} came behind the watermark")
    if dropped:
        _log.warning("%d rows for %s came behind the watermark and were dropped", dropped, layer)
    return dropped


def _run_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """A name for the part a micro-batch writes: unique to the checkpoint, equal on replay."""
    found = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id"))
    return f"live-{found.first()[0]}-{batch_id}"


def drain_bronze(
    messages: DataFrame, path: str, checkpoint: str, files_per_hour: int | None = None
) -> None:
    """Messages to bronze files by hour.

    Without a shuffle: every task writes the hours it has read. ``files_per_hour`` adds
    one, for topics read by so many tasks that their files would be small.
    """
    spark = messages.sparkSession
    create(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        if files_per_hour:
            batch = spread_writers(batch, fv.BRONZE_PARTITIONS, files_per_hour)
        write_run(batch, path, fv.BRONZE_PARTITIONS, _run_name(spark, checkpoint, batch_id))

    each_batch(bronze(messages), write, checkpoint).awaitTermination()


def drain_silver(
    records: DataFrame,
    path: str,
    checkpoint: str,
    files_per_day: int | None = None,
    partitions: int | None = None,
    fail_on_dropped: bool = False,
    **options,
) -> int:
    """Bronze records to silver files by day; returns the number of late rows dropped.

    The state of the dedup knows what this checkpoint has seen. What a backfill has
    stored is looked up in the table, for days that have such a part.

    ``files_per_day`` bounds the files a micro-batch adds to a day; the rows of a busy
    day still go through that many tasks.
    """
    spark = records.sparkSession
    create(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        if any_match(spark, f"{path}/*/*/*/{schemas.RUN}={schemas.BACKLOG}"):
            batch = _not_backfilled(spark, batch, path, f"{checkpoint}/staging/{batch_id}")
        if files_per_day:
            batch = spread_writers(batch, fv.SILVER_PARTITIONS, files_per_day)
        write_run(batch, path, fv.SILVER_PARTITIONS, _run_name(spark, checkpoint, batch_id))

    query = each_batch(silver(records, **options), write, checkpoint, partitions=partitions)
    return _drained(query, "silver", fail_on_dropped)


def drain_silver_by_table(
    records: DataFrame,
    path: str,
    checkpoint: str,
    files_per_day: int | None = None,
    fail_on_dropped: bool = False,
    keys: Sequence[str] = fv.DEDUP_KEYS,
    lateness: str = fv.LATENESS,
    now: Column | None = None,
) -> int:
    """The same rows by a table of seen keys in place of operator state.

    For feeds in which one trade may come again very often: every task sends one copy of
    it. Of copies within a micro-batch the first ingested stays. See ``streaming.seen_keys``.
    """
    spark = records.sparkSession
    create(spark, path)
    seen = SeenKeys(spark, f"{checkpoint}/keys", keys, lateness=lateness)
    late_rows = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal late_rows
        run = _run_name(spark, checkpoint, batch_id)
        passed, late = seen.admit(batch, run)
        trades = with_calendar(enriched_trades(passed, now=now), "trade_timestamp")
        if any_match(spark, f"{path}/*/*/*/{schemas.RUN}={schemas.BACKLOG}"):
            trades = _not_backfilled(spark, trades, path, f"{checkpoint}/staging/{batch_id}")
        if files_per_day:
            trades = spread_writers(trades, fv.SILVER_PARTITIONS, files_per_day)
        write_run(trades, path, fv.SILVER_PARTITIONS, run)
        # Last: until the keys stand in the table the micro-batch passes the same rows again.
        seen.record(passed, run)
        late_rows += late

    query = each_batch(standardized_trades(valid_trades(records)), write, checkpoint)
    query.awaitTermination()
    return _reported(late_rows, "silver", fail_on_dropped)


def _not_backfilled(spark: SparkSession, batch: DataFrame, path: str, staging: str) -> DataFrame:
    """The trades of a micro-batch that the backfilled parts of its days do not hold."""
    # Stored, so that the plan of the micro-batch, with its state, runs once.
    batch.write.mode("overwrite").parquet(staging)
    staged = spark.read.schema(batch.schema).parquet(staging)
    days = staged.select(*_DAY).distinct().collect()  # one row per calendar day
    if not days:
        return staged
    touched = F.struct(*_DAY).isin([F.struct(*[F.lit(day[c]) for c in _DAY]) for day in days])
    known = spark.read.schema(f"{schemas.SILVER}, {schemas.RUN} string").parquet(path)
    known = known.filter((F.col(schemas.RUN) == schemas.BACKLOG) & touched)
    return absent_by_key(staged, known, list(fv.DEDUP_KEYS))


def drain_gold(
    trades: DataFrame,
    path: str,
    checkpoint: str,
    partitions: int | None = None,
    silver_path: str | None = None,
    fail_on_dropped: bool = False,
    **options,
) -> int:
    """Silver trades to the candle table; returns the number of late rows dropped.

    A candle that is stored already is made again from all trades of its minute below
    ``silver_path``: the stream may only have seen those after a backfill. Without that
    path the new candle replaces it.

    Staging lies below the checkpoint: a new checkpoint never meets old staging.
    """
    spark = trades.sparkSession

    def settle(incoming: DataFrame, stored: DataFrame) -> DataFrame:
        again = incoming.join(stored.select(*CANDLE_KEYS), CANDLE_KEYS, "left_semi")
        minutes = again.select(*CANDLE_KEYS, schemas.CANDLE_DAY)
        days = [row[0] for row in minutes.select(schemas.CANDLE_DAY).distinct().collect()]
        if not days:
            return incoming
        width = options.get("width", fv.CANDLE_WIDTH)
        kept = parquet_tree(spark, silver_path, schemas.SILVER).filter(
            F.make_date("year", "month", "day").isin(days)
        )
        start = F.window("trade_timestamp", width)["start"]
        whole = kept.withColumn("candle_start_time", start).join(
            minutes.select(*CANDLE_KEYS), CANDLE_KEYS, "left_semi"
        )
        made = gold(whole.drop("candle_start_time"), **options)
        made = made.withColumn(schemas.CANDLE_DAY, F.to_date("candle_start_time"))
        return absent_by_key(incoming, again, CANDLE_KEYS).unionByName(made)

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_by_key(
            batch,
            path,
            CANDLE_KEYS,
            "candle_start_time",
            f"{checkpoint}/staging/{batch_id}",
            spark=spark,
            settle=settle if silver_path else None,
        )

    query = each_batch(gold(trades, **options), write, checkpoint, partitions=partitions)
    return _drained(query, "candles", fail_on_dropped)


def drain_warehouse(
    trades: DataFrame,
    append: Callable[[DataFrame], None],
    checkpoint: str,
    partitions: int | None = None,
    fail_on_dropped: bool = False,
    **options,
) -> int:
    """Silver trades as candles to a warehouse; returns the number of late rows dropped.

    ``append`` gets every micro-batch of finished candles, stored, so that it may use it
    more than once; it has to leave out candles that a replay brings again, as
    ``sinks.tables.jdbc_append_absent`` does.
    """
    spark = trades.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        staging = f"{checkpoint}/staging/{batch_id}"
        batch.write.mode("overwrite").parquet(staging)
        append(spark.read.schema(batch.schema).parquet(staging))

    query = each_batch(gold(trades, **options), write, checkpoint, partitions=partitions)
    return _drained(query, "warehouse", fail_on_dropped)


def run_layers(
    spark: SparkSession,
    messages: DataFrame,
    root: str,
    partitions: int | None = None,
    files_per_hour: int | None = None,
    files_per_day: int | None = None,
    fail_on_dropped: bool = False,
    by_table: bool = False,
    **candle_options,
) -> Drained:
    """Drain all three layers below ``root`` in order.

    A drain takes all files the layer before has, in one micro-batch: a bound on files
    would push the watermark past files that are not read yet. ``plans.backfill`` splits
    a backlog by days instead. ``by_table`` tells copies of trades by a table of seen keys
    in place of operator state; a checkpoint goes on with what it began with.
    """
    path = {layer: f"{root}/{layer}" for layer in ("bronze", "silver", "candles")}
    mark = {layer: f"{root}/_checkpoints/{layer}" for layer in path}
    drain_bronze(messages, path["bronze"], mark["bronze"], files_per_hour)
    records = bronze_stream(spark, path["bronze"])
    to_silver = (records, path["silver"], mark["silver"], files_per_day)
    dropped = {
        "silver": drain_silver_by_table(*to_silver, fail_on_dropped)
        if by_table
        else drain_silver(*to_silver, partitions, fail_on_dropped),
        "candles": drain_gold(
            silver_stream(spark, path["silver"]),
            path["candles"],
            mark["candles"],
            partitions,
            path["silver"],
            fail_on_dropped,
            **candle_options,
        ),
    }
    return Drained(path, dropped)
