"""Mixing sources to target weights along a time-varying curriculum.

The sources share a budget of words by weight; none gives more than ``most`` times what
it has, and what it cannot give is shared among the others again. A source's weight
changes over the training: its schedule runs in a straight line from ``1 + lean`` times
its weight to ``1 - lean`` times it. The integral of the schedule is the source's
cumulative demand; its inverse tells when the word at a given place of the source is
asked for, and that is the training position of the document that begins there.

Everything is DataFrame code. Documents of a source are taken in an order of hashes, in
lanes, so that a source of a third of all rows is no task of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.llm import frames

WEIGHTS = (5, 2, 1)
#: How far the schedules of these weights lean to the beginning: 0 is constant.
LEANS = (0.5, 0.0, -0.5)
BUDGET = 1.5
MOST = 2.0
WORD = r"[^\x20\x09-\x0D]+"


def targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    leans: tuple[float, ...] = LEANS,
    budget: float = BUDGET,
    most: float = MOST,
) -> DataFrame:
    """``sizes`` (source_key, source_size) with weight, lean and target of each source.

    Keys are in order of code points; weights go around. If the sources that are full at
    level L, where a source takes L times its weight, are known, L follows from sums; the
    sources fill up in order of the level at which they do. The table has one row per
    source; the windows run over these.
    """
    order = Window.orderBy("source_key")
    place = (F.row_number().over(order) - 1) % len(weights)
    pick = lambda of: F.element_at(F.array(*map(F.lit, of)), (place + 1).cast("int"))
    by_level = Window.orderBy("full_at", "source_key")
    until = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    known = (
        sizes.withColumn("weight", pick([float(w) for w in weights]))
        .withColumn("lean", pick([float(a) for a in leans]))
        .withColumn("full_size", F.col("source_size") * F.lit(float(most)))
        .withColumn("full_at", F.col("full_size") / F.col("weight"))
        .withColumn("words", F.sum("source_size").over(everything) * F.lit(float(budget)))
        .withColumn("spent", F.coalesce(F.sum("full_size").over(until), F.lit(0.0)))
        .withColumn(
            "rest",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(until), F.lit(0.0)),
        )
        # The level if this source and all after it were not full.
        .withColumn("level", (F.col("words") - F.col("spent")) / F.col("rest"))
        .withColumn("is_full", F.col("level") >= F.col("full_at"))
    )
    # The first that is not full has it; the levels of later ones are too low.
    level = F.max(F.when(~F.col("is_full"), F.col("level"))).over(everything)
    return known.select(
        "source_key",
        "source_size",
        "weight",
        "lean",
        F.when(F.col("is_full"), F.col("full_size"))
        .otherwise(level * F.col("weight"))
        .alias("target"),
    )


def position(demand: Column, lean: Column) -> Column:
    """When a share ``demand`` (0 to 1) of a source's words has been asked for.

    The demand until t is the integral of 1 + lean - 2 * lean * u for u from 0 to t.
    """
    slope = 1 + lean
    return 2 * demand / (slope + F.sqrt(F.greatest(slope * slope - 4 * lean * demand, F.lit(0.0))))


def plan(docs: DataFrame, whole: bool = False, **shares) -> DataFrame:
    """One row per row of ``docs`` with what the mix takes of it.

    Columns: row_key, doc_id, size, source_size, target, taken, position. A source is
    read around: full rounds first, then a last round in which documents are taken until
    the target is reached; the document at its end is taken in part. With ``whole`` that
    document is taken whole if half of it or more is wanted, and left else.
    ``position`` is that of the document's first word taken, NULL if none is.

    NULL is a source of its own and the last one; NULL and empty texts have size 0. Equal
    rows are documents of their own. An empty table gives no rows.
    """
    narrow = frames.stored(
        docs.select(
            frames.row_key().alias("row_key"),
            "doc_id",
            # NULL after every string, whatever its first code point is.
            F.when(F.col("source").isNull(), F.lit("1"))
            .otherwise(F.concat(F.lit("0"), F.col("source").cast("string")))
            .alias("source_key"),
            F.regexp_count(frames.whole_text(), F.lit(WORD)).cast("long").alias("size"),
        ).withColumn("spread", order_hash()),
        "mix-rows",
    )
    bits = frames.lane_bits(narrow.count())
    sizes = narrow.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    known = targets(sizes, **shares)
    ordered = frames.running(
        narrow, ["source_key"], "spread", ["doc_id", "row_key"], F.col("size"), "before", bits
    )
    size, goal = F.col("size"), F.col("target")
    rounds = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0)
    rest = F.floor(goal - F.col("rounds") * F.col("source_size") + 0.5).cast("long")
    last = (
        F.when(F.col("before") + size / 2 <= F.col("rest"), size).otherwise(0)
        if whole
        else F.least(size, F.greatest(F.col("rest") - F.col("before"), F.lit(0)))
    )
    return (
        ordered.join(known, "source_key")
        .withColumn("rounds", rounds.cast("long"))
        .withColumn("rest", rest)
        .withColumn("taken", (size * F.col("rounds") + last).cast("long"))
        .withColumn(
            "position",
            F.when(
                F.col("taken") > 0, position(F.try_divide("before", goal), F.col("lean"))
            ),
        )
        .select(
            "row_key", "doc_id", "size", "source_size", "target", "taken", "position",
            "before", "lean",
        )
    )


def order_hash() -> Column:
    """The order of a source's documents: the leading 60 bits of an MD5 of the doc_id."""
    name = F.coalesce(F.col("doc_id"), F.col("row_key")).cast("string")
    digits = F.substring(F.md5(name.cast("binary")), 1, 15)
    return F.shiftleft(F.conv(digits, 16, 10).cast("long"), 4)


def mixed(docs: DataFrame, **shares) -> DataFrame:
    """``docs`` as the mix takes them, in training order: whole documents, some twice.

    Each copy has a position of its own, later for the second round. A document that the
    mix leaves is not returned. Positions lie between 0 and 1 and a schedule's density
    between known bounds, so the ranges of the sort are even slices of the training and
    no sample of the text is taken to find them.
    """
    planned = plan(docs, whole=True, **shares)
    carried = ["size", "source_size", "target", "taken", "before", "lean"]
    columns = frames.free(docs, *carried)
    renamed = planned.select(
        "row_key", *(F.col(c).alias(n) for c, n in zip(carried, columns, strict=True))
    )
    size, source_size, goal, taken, before, lean = map(F.col, columns)
    (nth, at, slice_) = frames.free(docs, "copy", "position", "slice")
    copies = F.when(size > 0, F.floor(F.try_divide(taken, size))).otherwise(0).cast("int")
    slices = frames.tasks(docs)
    demand = F.try_divide(before + (F.col(nth) - 1) * source_size, goal)
    return (
        frames.attach(docs, renamed, "row_key", columns)
        .withColumn(nth, F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies))))
        .withColumn(at, position(F.least(demand, F.lit(1.0)), lean))
        .withColumn(slice_, F.least(F.floor(F.col(at) * slices), F.lit(slices - 1)).cast("int"))
        .repartitionById(slices, slice_)
        .sortWithinPartitions(at, "doc_id")
        .select(*docs.columns)
    )
