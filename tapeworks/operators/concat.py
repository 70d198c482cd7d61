"""Concatenation of frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def concat(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
