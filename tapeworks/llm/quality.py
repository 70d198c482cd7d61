"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is a vector of its byte trigrams, hashed to slots, and of its words that repeat the
word before them; both are weighted by inverse document frequency over all documents. The leading singular vectors of labelled texts
span the latent space. Each document is compared with every labelled vector, in blocks of
exact cosine products; its nearest ``NEIGHBOURS`` vote with the powers of their
similarity as weights.

Only the labelled sample is bounded: ``SAMPLE`` rows of each label, those whose ids hash
lowest. It is the one thing that reaches the driver (``SAMPLE`` rows of each label times
``FEATURES`` numbers) and, reduced to ``RANK`` numbers a row, every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm import frames, shipping, texts

FEATURE_BITS = 11
#: The slots of trigrams, and one for repeated words.
FEATURES = (1 << FEATURE_BITS) + 1
#: How much more a repeated word counts than a trigram.
REPEAT_WEIGHT = 8
SAMPLE = 1_500
RANK = 48
NEIGHBOURS = 25
#: The votes' weights are similarities to this power.
SHARPNESS = 4
THRESHOLD = 0.3
HELD_OUT = 5
SEED = 11
_BLOCK = 256
_SPACES = np.frombuffer(frames.SPACES.encode(), np.uint8)
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0


def counts(column: pa.Array) -> Iterator[np.ndarray]:
    """Counts of each slot, one row per text, some texts at a time."""
    for _, data, offsets in texts.slices(column):
        wide = data.astype(np.uint32)
        rows = len(offsets) - 1
        size = max(0, len(data) - 2)
        code = wide[:size] * _FACTORS[0] + wide[1 : size + 1] * _FACTORS[1] + wide[2:] * _FACTORS[2]
        slot = (code >> np.uint32(32 - FEATURE_BITS)).astype(np.int64)
        text = np.repeat(np.arange(rows), np.diff(offsets))[:size]
        within = np.arange(size) + 3 <= offsets[text + 1]
        flat = np.bincount((text * FEATURES + slot)[within], minlength=rows * FEATURES)
        found = flat.reshape(rows, FEATURES).astype(np.float32)
        found[:, -1] = _repeats(data, offsets)
        yield found


def _repeats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each text that equal the word before them, beyond what prose has."""
    starts, ends, before = texts.word_spans(~np.isin(data, _SPACES), offsets)
    hashes = texts.word_hashes(data, starts, ends)
    same = np.zeros(len(hashes), np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    same[before[:-1][np.diff(before) > 0]] = 0
    repeats = np.diff(np.concatenate([[0], np.cumsum(same)])[before])
    return np.maximum(repeats - np.maximum(2, np.diff(before) // 20), 0)


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each slot occurs, over all documents; and their number."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(FEATURES, np.int64), 0
        for part in parts:
            for found in counts(part["text"]):
                total += (found > 0).sum(axis=0)
                rows += len(found)
        if rows:
            slots = np.append(np.arange(FEATURES), -1)
            yield pa.record_batch([slots, np.append(total, rows)], ["slot", "documents"])

    parts = shipping.map_batches(docs.select("text"), batches, "slot long, documents long")
    summed = (
        parts.groupBy("slot")
        .agg(F.sum("documents").alias("documents"))
        .collect()  # FEATURES + 1 rows
    )
    found = {row["slot"]: row["documents"] for row in summed}
    return np.array([found.get(k, 0) for k in range(FEATURES)]), found.get(-1, 0)


def weighted(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Vectors of length 1; zero for a text of fewer than three bytes."""
    vectors = np.log1p(found) * idf
    vectors[:, -1] *= REPEAT_WEIGHT
    return _unit(vectors)


def _unit(vectors: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, size, out=np.zeros_like(vectors), where=size > 0)


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray  # FEATURES x rank
    examples: np.ndarray  # latent vectors of length 1
    labels: np.ndarray
    weights: np.ndarray  # of each example: the labels' shares in the whole over the sample's
    prior: float

    def latent(self, found: np.ndarray) -> np.ndarray:
        return _unit(weighted(found, self.idf) @ self.basis)

    def scores(self, found: np.ndarray) -> np.ndarray:
        """A score of 0 to 1 for each row of counts; the prior where nothing is similar."""
        result = np.full(len(found), self.prior)
        if not len(self.examples):
            return result
        near = min(NEIGHBOURS, len(self.examples))
        for first in range(0, len(found), _BLOCK):
            products = self.latent(found[first : first + _BLOCK]) @ self.examples.T
            # Equal similarities are told apart by the order of the examples.
            best = np.argpartition(-products, near - 1, axis=1)[:, :near]
            votes = np.maximum(np.take_along_axis(products, best, axis=1), 0).astype(np.float64)
            votes = votes**SHARPNESS * self.weights[best]
            total = votes.sum(axis=1)
            good = (votes * self.labels[best]).sum(axis=1)
            some = total > 0
            result[first : first + _BLOCK][some] = good[some] / total[some]
        return np.clip(result, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rank: int = RANK) -> Model:
    """Learn from ``labels.quality`` (0 or 1) of documents that are not held out.

    A document labelled more than once has the label of most of its rows, 1 if they are
    even. Labels without a document, ids of NULL and labels other than 0 and 1 are
    ignored. Without labels every score is 1: nothing is known against any document.
    """
    known = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    )
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    order = F.xxhash64(F.lit(SEED), "doc_id")
    chosen = [
        known.filter(F.col("quality") == label).orderBy(order, "doc_id").limit(sample)
        for label in (0, 1)
    ]
    # Two times ``sample`` ids: that bounds what is broadcast.
    picked = docs.select("doc_id", "text").join(
        F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id"
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            packed = [row.astype("<f4").tobytes() for found in counts(part["text"]) for row in found]
            yield pa.record_batch(
                [part["doc_id"], part["quality"], pa.array(packed, pa.binary())],
                ["doc_id", "quality", "counts"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = shipping.map_batches(picked, batches, f"doc_id {kind}, quality int, counts binary")
    held = sorted(rows.dropDuplicates(["doc_id"]).collect())
    frequency, documents = frequencies(docs)
    idf = (np.log((1 + documents) / (1 + frequency)) + 1).astype(np.float32)
    everything = sum(shares.values())
    prior = shares.get(1, 0) / everything if everything else 1.0
    label = np.array([r["quality"] for r in held], np.int64)
    if not len(held):
        empty = np.zeros((0, rank), np.float32)
        return Model(idf, np.zeros((FEATURES, rank), np.float32), empty, label, label, prior)
    found = np.stack([np.frombuffer(r["counts"], "<f4") for r in held])
    vectors = weighted(found, idf)
    basis = _basis(vectors, min(rank, *vectors.shape))
    taken = np.bincount(label, minlength=2)
    weight = np.array([shares.get(k, 0) / max(1, taken[k]) for k in (0, 1)])
    model = Model(idf, basis, np.zeros((0, 0)), label, weight[label] / weight.max(), prior)
    model.examples = model.latent(found)
    return model


def _basis(vectors: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular vectors, by power iterations on a random start."""
    start = np.random.default_rng(SEED).standard_normal((vectors.shape[1], rank + 8))
    span = vectors @ start.astype(np.float32)
    for _ in range(5):
        span, _ = np.linalg.qr(span)
        span = vectors @ (vectors.T @ span)
    span, _ = np.linalg.qr(span)
    _, _, right = np.linalg.svd(span.T @ vectors, full_matrices=False)
    return np.ascontiguousarray(right[:rank].T).astype(np.float32)


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on).

    Only the text decides: NULL and empty texts, and any without three bytes, have the
    share of label 1 as their score. Rows stay as they are; existing columns of the two
    names are replaced.
    """
    own = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*own.schema.fields, T.StructField("score", T.DoubleType())])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [shared.value.scores(x) for x in counts(part["text"])]
            score = pa.array(np.concatenate(found) if found else np.zeros(0))
            yield pa.record_batch([*part.columns, score], [*part.schema.names, "score"])

    return shipping.map_batches(own, batches, schema).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good."""
    model = fit(docs, labels)
    renamed = {c: n for c, n in zip(["score", "predicted"], frames.free(docs, "own_score", "own_predicted"), strict=True) if c in docs.columns}
    kept = scored(docs.withColumnsRenamed(renamed), model, threshold).filter("predicted = 1")
    back = {n: c for c, n in renamed.items()}
    return kept.drop("score", "predicted").withColumnsRenamed(back).select(*docs.columns)
