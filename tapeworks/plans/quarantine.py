"""Messages that cannot be decoded: kept as text with a reason, and replayed once mended.

Decoding leaves a row of NULLs where a message is no trade record, and its text is lost. Here
such messages go to a dead-letter table (``sinks.snapshots``) with their text. A replay
decodes them again after a correction; those that it mends are added to bronze as a part of
their own and leave the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks import fixed_values as fv
from tapeworks import schemas
from tapeworks.plans.layers import bronze
from tapeworks.sinks import snapshots
from tapeworks.sinks.files import write_run

EMPTY, NO_OBJECT, WRONG_TYPE = "empty", "no JSON object", "wrong type: "
_CORRUPT = "_corrupt"


def fault(value: Column, schema: str = schemas.TRADE) -> Column:
    """Why a message cannot be decoded as ``schema``; NULL where it can.

    A field of the wrong type is named; several are listed in the schema's order. A field
    that is absent or null is no fault.
    """
    text = value.cast("string")
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    record = F.from_json(text, f"{schema}, {_CORRUPT} string", options)
    told = F.from_json(text, "map<string,string>")
    wrong = F.array_compact(
        F.array(
            *(
                F.when(told[name].isNotNull() & record[name].isNull(), F.lit(name))
                for name in T._parse_datatype_string(schema).fieldNames()
            )
        )
    )
    return (
        F.when(text.isNull() | (F.trim(text) == ""), F.lit(EMPTY))
        .when(record[_CORRUPT].isNull(), F.lit(None).cast("string"))
        .when(told.isNull() | (F.size(wrong) == 0), F.lit(NO_OBJECT))
        .otherwise(F.concat(F.lit(WRONG_TYPE), F.array_join(wrong, ", ")))
    )


def dead_letters(messages: DataFrame, value: str = "value") -> DataFrame:
    """(letter_id, value, reason, copies) of the messages with a fault, equal texts once."""
    text = F.col(value).cast("string")
    return (
        messages.select(text.alias("value"), fault(text).alias("reason"))
        .filter("reason IS NOT NULL")
        .groupBy("value", "reason")
        .agg(F.count("*").alias("copies"))
        .select(F.sha2(F.coalesce("value", F.lit("")), 256).alias("letter_id"), "value", "reason", "copies")
    )


def sound(messages: DataFrame, value: str = "value") -> DataFrame:
    """The messages without a fault."""
    return messages.filter(fault(F.col(value)).isNull())


def quarantine(messages: DataFrame, path: str, run: str) -> snapshots.Snapshot:
    """Add the dead letters of a run to the table at ``path``; once, if it is repeated."""
    return snapshots.append(dead_letters(messages), path, "reason", run)


def replay(
    spark: SparkSession, path: str, mend: Callable[[Column], Column], bronze_path: str, run: str
) -> int:
    """Decode the dead letters again after ``mend`` of their text; returns how many were mended.

    First the mended messages are written to bronze, as the part ``replay-<run>``, then the
    table without them is published. A replay that was interrupted is repeated under the
    same ``run``: it writes the same part again, or finds nothing left, so each message is added
    once. A run's name is used for one correction only.
    """
    base = snapshots.current(spark, path)
    letters = snapshots.read(spark, base)
    mended = letters.withColumn("value", mend(F.col("value")))
    good = sound(mended).dropDuplicates(["letter_id"])
    found = good.count()
    if not found:
        return 0
    write_run(bronze(good.select("value")), bronze_path, fv.BRONZE_PARTITIONS, f"replay-{run}", gather=True)
    left = mended.select("letter_id", fault(F.col("value")).alias("_fault")).filter("_fault IS NOT NULL")
    rest = letters.join(left.select("letter_id").distinct(), "letter_id", "left_semi").select(*letters.columns)
    parts = snapshots.stage(rest, path, "reason", len(base.runs))
    snapshots.publish(spark, path, base, parts, rest.schema, "reason", base.runs, {"replayed": run})
    return found
