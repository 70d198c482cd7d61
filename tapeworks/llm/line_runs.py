"""Line dedup with levelled sorted runs of line hashes.

A run is a table of (line hash, number of documents, largest doc_id, first) sorted by hash.
Each batch of documents is merge-anti-joined with the runs before it: what none of them
holds is ``first`` in the new run, what one does is only counted further there. ``FAN_IN``
runs of a level are merged into one of the next level, so n batches leave about log n runs,
and a key is ``first`` in one run alone. Lines that the rule gives up, judged by the counts
of all runs, are taken out of their documents.

Everything is DataFrame code. A line that stands in a third of all documents is one row
per task before any shuffle of the runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import session
from tapeworks.llm import frames

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
FAN_IN = 2
BATCHES = 4
KEY = ["key_high", "key_low"]
_RUN = "key_high long, key_low long, documents long, last_doc long, first boolean"
_SALT = "second hash"
_BATCH = "batch"
_ADDED = ("n_lines", "n_dropped", "kept_text")


def split_lines(text: Column) -> Column:
    """A NULL or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.btrim(frames.ascii_lower(line), F.lit(frames.SPACES))


def lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(row_key, doc_id, place, key_high, key_low, first) of each line long enough.

    Two hashes of 64 bits stand for a key. ``first`` marks the first line of a key within
    its document, found by sorting the document's own lines.
    """
    keyed = F.transform(
        split_lines(F.col("text")),
        lambda line, place: F.struct(line_key(line).alias("key"), place.alias("place")),
    )
    long_enough = F.filter(keyed, lambda x: F.length(x["key"]) >= least_chars)
    hashed = F.array_sort(
        F.transform(
            long_enough,
            lambda x: F.struct(
                F.xxhash64(x["key"]).alias("key_high"),
                F.xxhash64(F.lit(_SALT), x["key"]).alias("key_low"),
                x["place"].alias("place"),
            ),
        )
    )
    marked = F.expr(
        "transform(sorted, (x, i) -> named_struct('x', x, 'first', i = 0 OR "
        "x.key_high != get(sorted, i - 1).key_high OR x.key_low != get(sorted, i - 1).key_low))"
    )
    return (
        docs.select(frames.row_key().alias("row_key"), "doc_id", hashed.alias("sorted"))
        .select("row_key", "doc_id", F.explode(marked).alias("line"))
        .select("row_key", "doc_id", "line.x.place", *(f"line.x.{k}" for k in KEY), "line.first")
    )


class LineRuns:
    """The runs of one corpus, as Parquet folders below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, fan_in: int = FAN_IN):
        self.spark, self.folder, self.fan_in = spark, folder, fan_in
        self.levels: list[list[str]] = []
        self._written = 0

    def add(self, batch: DataFrame) -> None:
        """Add the run of a batch of ``lines``; merge levels that are full.

        The batch's keys that no run holds are found by an anti-join, the others are told
        by a semi-join, and both are the new run.
        """
        own = (
            batch.filter("first")
            .groupBy(*KEY)
            .agg(F.count("*").alias("documents"), F.max("doc_id").cast("long").alias("last_doc"))
        )
        if not self.levels:
            self._put(0, own.withColumn("first", F.lit(True)))
            return
        # Stored, as both joins read it; Spark would also join a batch's lines before counting.
        counted = frames.stored(own, "batch-run")
        new = self.unseen(counted).withColumn("first", F.lit(True))
        known = counted.join(self._firsts(), KEY, "left_semi").withColumn("first", F.lit(False))
        self._put(0, new.unionByName(known).coalesce(frames.tasks(counted)))
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fan_in:
            merged = self._merge(self.levels[level])
            self.levels[level] = []
            level += 1
            self._put(level, merged)

    def merged(self) -> DataFrame:
        """One row per key over all runs."""
        paths = self._paths()
        if not paths:
            return self._none()
        return self._read(paths[0]) if len(paths) == 1 else self._merge(paths)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` whose key is in none of the runs, by a merge of sorted sides."""
        return batch.join(self._firsts().hint("merge"), KEY, "left_anti")

    def _paths(self) -> list[str]:
        return [path for level in self.levels for path in level]

    def _firsts(self) -> DataFrame:
        """Every key of the runs, once."""
        runs = [self._read(path).filter("first") for path in self._paths()] or [self._none()]
        return reduce(DataFrame.unionByName, [run.select(*KEY) for run in runs])

    def _none(self) -> DataFrame:
        """A run without keys, for which no executor starts Python."""
        return self.spark.range(0).selectExpr(
            *(f"CAST(id AS {kind}) AS {name}" for name, kind in map(str.split, _RUN.split(", ")))
        )

    def given_up(self, batch: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
        """The lines of ``batch`` to drop.

        Those whose key ``least_documents`` or more documents hold, in all documents but
        the one with the largest doc_id. NULL is smaller than every doc_id.
        """
        common = self.merged().filter(F.col("documents") >= least_documents)
        return batch.join(common, KEY).filter(~F.col("doc_id").eqNullSafe(F.col("last_doc")))

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(_RUN).parquet(path)

    def _merge(self, paths: list[str]) -> DataFrame:
        runs = reduce(DataFrame.unionByName, [self._read(path) for path in paths])
        return runs.groupBy(*KEY).agg(
            F.sum("documents").alias("documents"),
            F.max("last_doc").alias("last_doc"),
            F.max("first").alias("first"),
        )

    def _put(self, level: int, run: DataFrame) -> None:
        path = f"{self.folder}/level-{level}-run-{self._written}"
        self._written += 1
        with session.step_settings(self.spark):
            run.sortWithinPartitions(*KEY).write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)


def dedup(
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
    batches: int = BATCHES,
) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text.

    Every row is a document, also if rows repeat; repeated rows that hold the largest
    doc_id all keep their lines. Documents in which nothing is dropped keep their text as
    it is (NULL: the empty text). An empty table gives no rows. Existing columns of the
    three names are replaced, all others kept.
    """
    spark = docs.sparkSession
    # A file per task, in order of batches, so that a run reads the pages of its own batch.
    batch_of = F.pmod(F.col("row_key"), F.lit(batches)).cast("int")
    long_enough = lines(docs, least_chars).withColumn(_BATCH, batch_of)
    found = frames.stored(long_enough.sortWithinPartitions(_BATCH), "lines")
    runs = LineRuns(spark, session.scratch(spark, "line-runs"))
    for batch in range(batches):
        runs.add(found.filter(F.col(_BATCH) == batch).drop(_BATCH))
    added = frames.free(
        docs.drop(*_ADDED), *_ADDED, "row_key", "dropped_places", "split_lines", "staying_places"
    )
    (key, places, split, stay) = added[len(_ADDED):]
    dropped = (
        runs.given_up(found.drop(_BATCH), least_documents)
        .groupBy(F.col("row_key").alias(key))
        .agg(F.collect_set("place").alias(places))
    )
    text = F.col("text")
    count = F.size(split_lines(text))
    staying = F.array_except(F.sequence(F.lit(0), count - 1), F.col(places))
    # The lines are split once, as a column, and taken by place.
    left = F.expr(f"transform({stay}, i -> {split}[i])")
    none = F.col(places).isNull()
    return (
        docs.drop(*_ADDED)
        .withColumn(key, frames.row_key())
        .join(dropped, key, "left")
        .withColumn("n_lines", count.cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size(places), F.lit(0)).cast("long"))
        .withColumn(split, F.when(~none, split_lines(text)))
        .withColumn(stay, staying)
        .withColumn(
            "kept_text", F.when(none, frames.whole_text()).otherwise(F.array_join(left, "\n"))
        )
        .drop(key, places, split, stay)
    )
