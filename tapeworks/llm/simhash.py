"""Near duplicates by SimHash and a self-join of binary tries.

A fingerprint has a bit for each of the 64 bits of XXH64: it is 1 if the bit is set in
more than half of the hashes of the text's word shingles, repeats included. Fingerprints
that differ in few bits are linked, and documents that links connect are one component.

The join works on distinct fingerprints. Two that differ in at most ``budget`` bits agree
in one of ``budget + 1`` blocks of their bits, whichever bits differ. So there is one trie
per block, with that block's bits first, and Spark deals out the subtries below the
block's values; a task traverses each of its subtries against itself. It follows pairs of
nodes together, adds up the bits in which their paths differ, and leaves a pair as soon
as these exceed the budget, or when all below both nodes is already connected.
Each task returns a spanning tree of what it has linked, so a dense group of n
fingerprints is n rows and no link between different texts is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm import components, frames, shipping, texts

WORDS = 4
BUDGET = 4
SEED = 42
BITS = 64
#: Hashes whose bits are counted at once, within one text.
_AT_ONCE = 1 << 14
#: Node pairs followed at once, and fingerprints whose tries are traversed at once.
_PAIRS_AT_ONCE = 1 << 20
_LEAVES_AT_ONCE = 1 << 18
#: Pairs of nodes with as many pairs of leaves or fewer are compared leaf by leaf.
_SMALL = 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The fingerprint as an unsigned number; 0 without a word."""
    found = text.lower().split()  # bytes: A-Z only, and split at \\x20\\x09-\\x0D
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[words - 1 :] if len(found) >= words else ends[-1:]
    spans = map(slice, starts[: len(last)].tolist(), last.tolist())
    digests = map(xxhash.xxh64_intdigest, map(joined.__getitem__, spans), repeat(SEED))
    hashes = np.fromiter(digests, ">u8", len(last))
    counts = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), _AT_ONCE):
        part = hashes[first : first + _AT_ONCE].view(np.uint8).reshape(-1, BITS // 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(row_key, doc_id, fingerprint) of each row, from its whole text."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [fingerprint(text, words) for text in texts.strings(part["text"])]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.record_batch(
                [part["row_key"], part["doc_id"], pa.array(signed)],
                ["row_key", "doc_id", "fingerprint"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select(frames.row_key().alias("row_key"), "doc_id", "text")
    return shipping.map_batches(own, batches, f"row_key long, doc_id {kind}, fingerprint long")


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def links(distinct: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(node, other) over distinct ``fingerprint``s: spanning trees of the tries' links."""
    blocks = budget + 1
    firsts = [BITS * k // blocks for k in range(blocks)]
    width = min(b - a for a, b in zip(firsts, [*firsts[1:], BITS], strict=True))
    value = F.col("fingerprint")
    turned = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(k).alias("trie"),
                    F.when(F.lit(first) == 0, value)
                    .otherwise(
                        F.shiftleft(value, first).bitwiseOR(
                            F.shiftrightunsigned(value, BITS - first)
                        )
                    )
                    .alias("path"),
                )
                for k, first in enumerate(firsts)
            )
        )
    ).alias("turned")
    subtries = distinct.select("fingerprint", turned).select(
        "fingerprint",
        # The path without its sign, so that subtries come in order of their leaves.
        F.col("turned.path").alias("path"),
        (F.shiftrightunsigned("turned.path", BITS - width) + F.col("turned.trie") * (1 << width))
        .cast("long")
        .alias("subtrie"),
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for subtrie, path, value in _whole_subtries(parts):
            label = traverse(subtrie, path.view(np.uint64), width, budget)
            other = np.flatnonzero(label != np.arange(len(label)))
            yield pa.record_batch(
                [pa.array(value[other]), pa.array(value[label[other]])], ["node", "other"]
            )

    dealt = subtries.repartition("subtrie").sortWithinPartitions("subtrie", "path")
    return shipping.map_batches(dealt, batches, "node long, other long")


def _whole_subtries(
    parts: Iterator[pa.RecordBatch],
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(subtrie, path, fingerprint) of many whole subtries at a time."""
    held: list[tuple[np.ndarray, ...]] = []
    for part in parts:
        held.append(tuple(part[c].to_numpy() for c in ("subtrie", "path", "fingerprint")))
        if sum(len(x[0]) for x in held) >= _LEAVES_AT_ONCE:
            rows = [np.concatenate(x) for x in zip(*held, strict=True)]
            cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last may go on
            if cut:
                yield tuple(x[:cut] for x in rows)
            held = [tuple(x[cut:] for x in rows)]
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def traverse(subtrie: np.ndarray, path: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """The connected leaves of each subtrie: for each leaf, the first one it is linked with.

    A node is a range of the sorted leaves. Leaves one bit apart are connected first;
    what is connected then is not compared again.
    """
    order = np.lexsort((path, subtrie))
    path, subtrie = path[order], subtrie[order]
    label = np.arange(len(path))
    heads = np.flatnonzero(np.diff(subtrie, prepend=subtrie[:1] - 1))
    tails = np.append(heads[1:], len(path))
    ones: dict[int, np.ndarray] = {}
    for allowed in sorted({min(1, budget), budget}):
        _follow(path, label, heads, tails, depth, allowed, ones)
    # In the order in which the leaves were given.
    result = np.empty(len(path), np.int64)
    result[order] = order[label]
    return result


def _follow(path, label, heads, tails, depth, allowed, ones) -> None:
    stack = [(depth, (heads, tails, heads, tails, np.zeros(len(heads), np.int8)))]
    changes = _changes(label)
    while stack:
        at, pairs = stack.pop()
        if len(pairs[0]) > _PAIRS_AT_ONCE:
            half = len(pairs[0]) // 2
            stack += [(at, tuple(x[half:] for x in pairs)), (at, tuple(x[:half] for x in pairs))]
            continue
        first, last, first2, last2, off = pairs
        same = first == first2
        sizes = np.where(same, (last - first) * (last - first - 1) // 2, (last - first) * (last2 - first2))
        connected = (
            (changes[last - 1] == changes[first])
            & (changes[last2 - 1] == changes[first2])
            & (label[first] == label[first2])
        )
        alive = (sizes > 0) & ~connected
        small = alive & ((sizes <= _SMALL) | (at == BITS))
        a, b = _leaf_pairs(*(x[small] for x in (first, last, first2, last2)))
        near = np.bitwise_count(path[a] ^ path[b]) <= allowed
        if near.any():
            components.union(label, a[near], b[near])
            changes = _changes(label)
        large = alive & ~small
        if not large.any():
            continue
        if at not in ones:
            bit = (path >> np.uint64(BITS - 1 - at)) & np.uint64(1)
            ones[at] = np.concatenate([[0], np.cumsum(bit.astype(np.int32))])
        stack.append((at + 1, _children(*(x[large] for x in (*pairs, same)), ones[at], allowed)))


def _children(first, last, first2, last2, off, same, ones, allowed) -> tuple[np.ndarray, ...]:
    middle = last - (ones[last] - ones[first])
    middle2 = last2 - (ones[last2] - ones[first2])
    kinds = (
        (first, middle, first2, middle2, off, np.ones(len(off), bool)),
        (middle, last, middle2, last2, off, np.ones(len(off), bool)),
        (first, middle, middle2, last2, off + 1, np.ones(len(off), bool)),
        (middle, last, first2, middle2, off + 1, ~same),
    )
    kept = []
    for *pair, wanted in kinds:
        holds = wanted & (pair[0] < pair[1]) & (pair[2] < pair[3]) & (pair[4] <= allowed)
        kept.append([x[holds] for x in pair])
    return tuple(np.concatenate(x) for x in zip(*kept, strict=True))


def _leaf_pairs(first, last, first2, last2) -> tuple[np.ndarray, np.ndarray]:
    """Every leaf of the first node with every leaf of the second, each pair once."""
    width = last2 - first2
    sizes = (last - first) * width
    which = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    a, b = first[which] + place // width[which], first2[which] + place % width[which]
    once = a < b  # within a node; leaves of different nodes are in order
    return a[once], b[once]


def _changes(label: np.ndarray) -> np.ndarray:
    """How often the label changes up to each leaf."""
    return np.cumsum(np.diff(label, prepend=label[:1]) != 0)


def plan(docs: DataFrame, words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, fingerprint, root, component_id.

    ``component_id`` is the smallest doc_id that links reach from the document, itself
    included; a NULL doc_id is no smallest one, and a component of such rows only has a
    NULL id. ``root`` is a fingerprint that stands for the component. NULL, empty and
    wordless texts have fingerprint 0, which links like any other; a text of fewer words
    than a shingle is one shingle. An empty table gives no rows.
    """
    marked = frames.stored(fingerprints(docs, words), "fingerprints")
    distinct = frames.stored(
        marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc")), "fingerprint-set"
    )
    roots = components.connected(links(distinct.select("fingerprint"), budget))
    members = distinct.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).withColumn("root", F.coalesce("root", "fingerprint"))
    ids = members.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    # Stored, so that the join with it may split the rows of a frequent fingerprint.
    classes = frames.stored(members.join(ids, "root").drop("first_doc"), "components")
    return marked.join(classes, "fingerprint")


def dedup(docs: DataFrame, words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest doc_id.

    Of rows with equal ids the one with the smallest row key stays; a NULL doc_id only
    where the component has no other.
    """
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    kept = (
        plan(docs, words, budget).groupBy("root").agg(F.min(rank)["row_key"].alias("row_key"))
    )
    (own, nth) = frames.free(docs, "row_key", "nth_row")
    return frames.first_rows(docs, own, nth).join(
        kept.select(F.col("row_key").alias(own)), own, "left_semi"
    ).select(*docs.columns)
