"""Between wire messages, trade records and keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.functions.amounts import parse_float
from tapeworks.functions.moments import as_moment


def normalize_envelopes(
    envelopes: DataFrame,
    feed: str,
    value: str = "value",
    now: Column | None = None,
) -> DataFrame:
    """Wire messages to trade records labelled ``feed``.

    A message is dropped when it is no JSON object, has no ``data`` object, lacks one
    of the five trade fields, or has a price or quantity that is no number. A field
    that is present but null is kept as null, except for the two amounts.
    """
    data = F.from_json(F.col(value).cast("string"), schemas.ENVELOPE)["data"]
    complete = F.col("data").isNotNull()
    for field in ("s", "p", "q", "T", "m"):
        complete = complete & F.map_contains_key("data", F.lit(field))
    record = F.struct(
        F.lit(feed).alias("source"),
        F.col("data")["s"].alias("symbol"),
        parse_float(F.col("data")["p"]).alias("price"),
        parse_float(F.col("data")["q"]).alias("quantity"),
        F.col("data")["T"].try_cast("bigint").alias("trade_time"),
        F.col("data")["m"].try_cast("boolean").alias("is_buyer_maker"),
        F.date_format(as_moment(now), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"),
    )
    # Generators of one row, so that messages and numbers are parsed once. As plain columns
    # they would be copied into every filter that Catalyst pushes below them.
    return (
        envelopes.select(F.explode(F.array(data)).alias("data"))
        .filter(complete)
        .select(F.inline(F.array(record)))
        .filter("price is not null and quantity is not null")
    )


def decode_trades(messages: DataFrame, value: str = "value") -> DataFrame:
    """Message payloads to trade records. Unreadable text becomes a row of NULLs."""
    record = F.from_json(F.col(value).cast("string"), schemas.TRADE)
    return messages.select(record.alias("record")).select("record.*")


def untimed(epoch_ms: Column, moment: Column) -> Column:
    """Whether a record has a time that no timestamp can hold; it ends in bronze."""
    return epoch_ms.isNotNull() & moment.isNull()


def undecodable(records: DataFrame) -> DataFrame:
    """The rows that decoding left empty."""
    empty = F.lit(True)
    for name in ("source", "symbol", "price", "quantity", "trade_time", "is_buyer_maker"):
        empty = empty & F.col(name).isNull()
    return records.filter(empty)


def to_messages(records: DataFrame, key: str = "symbol") -> DataFrame:
    """Records to keyed JSON messages; nulls are written out, not skipped."""
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return records.select(F.col(key).cast("string").alias("key"), body.alias("value"))
