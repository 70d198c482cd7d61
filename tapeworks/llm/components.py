"""Connected components, in a task and over a cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm import frames

ROUNDS = 50


def union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of a[i] and b[i] in ``label``, where each points to its first."""
    while len(a):
        one, two = label[a], label[b]
        apart = one != two
        a, b, one, two = a[apart], b[apart], one[apart], two[apart]
        np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))
        while not np.array_equal(label, further := label[label]):
            label[:] = further


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (node, other): root is the smallest reachable.

    Large and small stars alternate: first every node hands its larger neighbours to its
    smallest one, then its smaller ones; what remains is one star per component. A node
    with many links is many rows of a join, never a group in one task, and each round is
    stored.
    """
    tied = frames.stored(
        links.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
        .filter("node <> other")
        .distinct(),
        "links",
    )
    before = None
    for _ in range(ROUNDS):
        now = tied.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "other"))).first()
        if now == before or not now[0]:
            return tied.withColumnRenamed("other", "root").unionByName(
                tied.select(F.col("other").alias("node"), F.col("other").alias("root")).distinct()
            )
        before = now
        tied = frames.stored(_small_stars(_large_stars(tied)), "stars")
    raise RuntimeError(f"links did not settle within {ROUNDS} rounds")


def _large_stars(tied: DataFrame) -> DataFrame:
    both = tied.unionByName(tied.select(F.col("other").alias("node"), F.col("node").alias("other")))
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    return (
        both.join(least, "node")
        .filter("other > node")
        .select(F.col("other").alias("node"), F.least("node", "least").alias("other"))
        .distinct()
    )


def _small_stars(tied: DataFrame) -> DataFrame:
    least = tied.groupBy("node").agg(F.min("other").alias("least"))
    moved = tied.join(least, "node").filter("other > least")
    return moved.select(F.col("other").alias("node"), F.col("least").alias("other")).unionByName(
        least.select("node", F.col("least").alias("other"))
    ).distinct()
