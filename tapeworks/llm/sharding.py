"""Sharding by balanced label propagation.

Documents that share a link (by default: an equal text) attract each other. All begin in
balanced shards; in every round each document looks at where the others of its link are
and asks to move there. Moves are granted under quotas that leave the number of rows of
every shard as it was: what flows into a shard beyond what flows out of it is made up by
documents without a link, which may stand anywhere. So the counts of any two shards
differ by one row at most, from the first round to the last.

A link is a hyperedge: its documents meet through one row per link and shard, never as
pairs. A link of more rows than a shard holds fills one shard after the other.

Everything is DataFrame code. What reaches the driver is one number per pair of shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm import frames

SHARDS = 8
#: Each round moves what it can; it ends when no document wants to move.
ROUNDS = 12
SEED = "shards"


def plan(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, size, text_crc32, shard, slot.

    ``size`` is the text's UTF-8 bytes plus 1. A NULL text counts as empty, so NULL and
    empty texts are one link. A NULL doc_id is a document like any other; repeated rows
    are linked and each gets a place. ``slot`` numbers a shard's rows from 0 without gaps.
    An empty table gives no rows.
    """
    text = frames.whole_text()
    narrow = frames.stored(
        docs.select(
            frames.row_key().alias("row_key"),
            "doc_id",
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("link"),
        ).withColumn("spread", F.xxhash64(F.lit(SEED), "row_key")),
        "shard-rows",
    )
    rows = narrow.count()
    bits = frames.lane_bits(rows)
    one = narrow.withColumn("all", F.lit(0))
    ranked = frames.running(one, ["all"], "spread", ["row_key"], F.lit(1), "rank", bits)
    # Stored, here and below, so that a join with it may split the rows of a large link.
    linked = frames.stored(
        narrow.groupBy("link", "text_crc32")
        .agg(F.count("*").alias("together"))
        .filter("together > 1"),
        "links",
    )
    state = frames.stored(
        ranked.withColumn("shard", (F.col("rank") % shards).cast("int"))
        .drop("all", "rank")
        .join(linked, ["link", "text_crc32"], "left"),
        "shard-start",
    )
    capacity = max(1, rows // shards)
    for _ in range(rounds):
        moved = _round(state, shards, capacity, bits)
        if moved is None:
            break
        state = moved
    numbered = frames.running(
        state, ["shard"], "spread", ["row_key"], F.lit(1), "slot", bits
    )
    return numbered.select("row_key", "doc_id", "size", "text_crc32", "shard", "slot")


def _round(state: DataFrame, shards: int, capacity: int, bits: int) -> DataFrame | None:
    """The state after one round of moves; None when nothing can move."""
    link = ["link", "text_crc32"]
    counts = (
        state.filter("together IS NOT NULL")
        .groupBy(*link, "shard")
        .agg(F.count("*").alias("here"))
    )
    # The largest part first; equal parts in an order that differs from link to link.
    lure = F.struct(-F.col("here"), F.xxhash64("link", "shard"), "shard", "here")
    homes = (
        counts.groupBy(*link)
        .agg(F.sort_array(F.collect_list(lure)).alias("parts"))
        .withColumn("full", F.expr(f"filter(parts, p -> p.here >= {capacity}).shard"))
        .withColumn("home", F.expr(f"get(filter(parts, p -> p.here < {capacity}), 0).shard"))
        .filter("home IS NOT NULL")
        .select(*link, "home", "full")
    )
    homes = frames.stored(homes, "shard-homes")
    asked = state.join(homes, link, "left").withColumn(
        "wish",
        F.when(
            (F.col("shard") != F.col("home")) & ~F.array_contains("full", F.col("shard")),
            F.col("home"),
        ).when(F.col("together").isNull(), F.lit(-1)),
    )
    asked = frames.stored(asked.drop("home", "full"), "shard-wishes")
    flows = {
        (r["shard"], r["wish"]): r["n"]
        for r in asked.filter("wish IS NOT NULL")
        .groupBy("shard", "wish")
        .agg(F.count("*").alias("n"))
        .collect()  # one row per pair of shards
    }
    granted, fillers = quotas(flows, shards)
    if not any(granted.values()):
        return None
    moving = asked.filter("wish IS NOT NULL").withColumn(
        # Links are granted one after the other; a large one is spread over all lanes.
        "turn",
        F.when(F.col("wish") < 0, F.col("spread"))
        .when(F.col("together") > frames.LANE_ROWS, F.col("spread"))
        .otherwise(F.xxhash64(F.lit("turn"), "link")),
    )
    ranked = frames.running(
        moving, ["shard", "wish"], "turn", ["spread", "row_key"], F.lit(1), "rank", bits
    )
    rules = [
        F.when((F.col("shard") == a) & (F.col("wish") == b) & (F.col("rank") < n), F.lit(b))
        for (a, b), n in granted.items()
        if n
    ] + [
        F.when(
            (F.col("shard") == a)
            & (F.col("wish") == -1)
            & (F.col("rank") >= first)
            & (F.col("rank") < last),
            F.lit(b),
        )
        for a, b, first, last in fillers
    ]
    moved = ranked.withColumn("shard", F.coalesce(*rules, F.col("shard"))).drop("rank", "turn")
    still = asked.filter("wish IS NULL")
    return frames.stored(moved.unionByName(still).drop("wish"), "shard-round")


def quotas(
    flows: dict[tuple[int, int], int], shards: int
) -> tuple[dict[tuple[int, int], int], list[tuple[int, int, int, int]]]:
    """How many of each flow may move, and which loose documents make up for it.

    ``flows[a, b]`` documents of shard a want to b; ``flows[a, -1]`` are loose. Returns
    the granted part of each flow and, for loose documents, (from, to, first rank, last
    rank). After both, every shard has as many rows as before.
    """
    loose = [flows.get((a, -1), 0) for a in range(shards)]
    granted = {k: n for k, n in sorted(flows.items()) if k[1] >= 0}

    def gain(shard: int) -> int:
        return sum(n for (_, b), n in granted.items() if b == shard) - sum(
            n for (a, _), n in granted.items() if a == shard
        )

    # A shard takes in no more than its loose documents can make room for. Taking a wish
    # back may overfill the shard it came from, hence the repetition; grants only shrink.
    while over := [s for s in range(shards) if gain(s) > loose[s]]:
        for shard in over:
            excess = gain(shard) - loose[shard]
            for (a, b), n in sorted(granted.items(), key=lambda x: -x[1]):
                if b == shard and excess > 0:
                    back = min(n, excess)
                    granted[a, b] -= back
                    excess -= back
    leave = {s: gain(s) for s in range(shards) if gain(s) > 0}
    lack = {s: -gain(s) for s in range(shards) if gain(s) < 0}
    fillers = []
    for a, n in leave.items():
        first = 0
        for b in list(lack):
            part = min(n - first, lack[b])
            if part > 0:
                fillers.append((a, b, first, first + part))
                first += part
                lack[b] -= part
    return granted, fillers


def sharded(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``; columns of these names are replaced."""
    own = docs.drop("shard", "slot")
    return frames.attach(own, plan(docs, shards, rounds), "row_key", ["shard", "slot"])


def cut(planned: DataFrame) -> DataFrame:
    """Links whose rows lie in more shards than their size needs: one row of totals."""
    per_link = planned.groupBy("text_crc32", "size").agg(
        F.count("*").alias("rows"), F.count_distinct("shard").alias("shards")
    )
    return per_link.filter("rows > 1").agg(
        F.count("*").alias("links"), F.count_if(F.col("shards") > 1).alias("cut_links")
    )
