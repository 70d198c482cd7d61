"""Sets of word shingles joined by Jaccard similarity, exactly, skipping by set relations.

A text's set holds its different shingles of ``WORDS`` words as 64-bit hashes; two sets
are linked if ``least`` percent of their union are in both. Shingles have one order, that of
their hashes with frequent ones last. Linked sets share a shingle of their first ones
(their prefixes), so each shingle has an index list of the sets with it in their prefix.

Index-level skipping: a list is in order of set size; a set leaves it at the first partner
that is too large, and pairs whose positions in both sets allow too few common shingles
are skipped. How many prefix shingles a pair shares bounds its overlap from above, so
nearly all pairs that are left are linked.

Answer-level skipping: sets are compared in cells of a set and those like it. There the
overlaps of a set with all others come from those of a similar set, by adding and
subtracting what the shingles in one of the two only bring; and what is already connected
is not compared again. Lists that many sets are in are no source of pairs: their sets meet
one of them, and what then stays apart is judged block by block, by the prefixes.

Whole sets are made again from the texts of candidates only, in each round of links, and
shipped once per cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks import session
from tapeworks.llm import components, frames, shipping, texts

WORDS, LEAST = 5, 80
#: Sets in a list above which its pairs are not made one by one.
HOT = 32
#: Shingles in order behind all others: the most frequent ones, at most so many.
LAST = 1_000_000
#: Sets of a cell, and of a block of a hot list; turns of a drawn set against the others of a
#: list of several blocks.
CELL, BLOCK, TURNS = 256, 2048, 3
#: Rows of a table that goes to all tasks, at most; a larger one is joined by a shuffle.
SENT_ROWS = 1 << 18
_FACTOR = np.uint64(0x100000001B3)
_TOP = np.uint64(1 << 63)
_RUN_ROWS = 1 << 17
_AT_ONCE = 4_000_000

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text, 63 bits; none for texts without words."""
    for _, data, offsets in texts.slices(column):
        low = texts.lowered(data)
        starts, ends, before = texts.word_spans(_IS_WORD[low], offsets)
        hashes = texts.mixed(texts.word_hashes(low, starts, ends) + np.uint64(1))
        # A shingle at every word that has enough words behind it, wherever texts end.
        whole = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for k in range(words):
            whole = whole * _FACTOR + hashes[k : k + len(whole)]
        whole = texts.mixed(whole) & ~_TOP
        for first, last in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            if last - first >= words:
                yield _distinct(whole[first : last - words + 1])
            elif last > first:
                few = np.array([last - first], np.uint64)
                for word in hashes[first:last]:
                    few = few * _FACTOR + word
                yield texts.mixed(few) & ~_TOP
            else:
                yield np.zeros(0, np.uint64)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


def node(own: np.ndarray) -> int:
    """64 bits of a set."""
    total = np.array([texts.mixed(own).sum(dtype=np.uint64) + np.uint64(len(own))])
    return int(texts.mixed(total).view(np.int64)[0])


def prefix_size(n: int, least: int) -> int:
    """So many first shingles of a set of n: a linked set has one of them."""
    return n - (least * n + 99) // 100 + 1


def _prefix_size(n: Column, least: int) -> Column:
    return n - F.floor((n * least + 99) / 100) + 1


def _needed(n: Column, m: Column, least: int) -> Column:
    """Common shingles of linked sets of n and m shingles."""
    return F.ceil((n + m) * least / F.lit(100 + least))


def ordered(own: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A set in the common order: those in ``last`` (sorted) come behind the others."""
    if not len(last) or not len(own):
        return own
    at = np.minimum(np.searchsorted(last, own), len(last) - 1)
    late = last[at] == own
    return np.concatenate([own[~late], own[late]])


def frequent(docs: DataFrame) -> np.ndarray:
    """The most frequent shingles, at most ``LAST``, sorted.

    Every set is read. A batch of texts reports the shingles that several of its different
    sets have, and Spark adds the reports up; so a shingle that is rare everywhere may be missed,
    which costs time and no link, for the order of shingles is free.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _different(parts):
            found = np.concatenate(own)
            own.clear()  # the sets and their sorted copy are not held at once
            found.sort()
            again = found[1:] == found[:-1]
            first = np.flatnonzero(again & np.concatenate([[True], ~again[:-1]])[: len(again)])
            last = np.flatnonzero(again & np.concatenate([~again[1:], [True]])[: len(again)])
            yield pa.record_batch(
                [pa.array(found[first].view(np.int64)), pa.array(last - first + 2)],
                ["shingle", "n_sets"],
            )

    counted = shipping.map_batches(docs.select("text"), batches, "shingle long, n_sets long")
    most = (
        counted.groupBy("shingle")
        .agg(F.sum("n_sets").alias("n_sets"))
        .filter(F.col("n_sets") > HOT)
        .orderBy(F.desc("n_sets"), "shingle")
        .limit(LAST)
        .select("shingle")
    )
    with session.step_settings(docs.sparkSession):
        most = most.toArrow()
    return np.sort(most["shingle"].to_numpy().astype(np.uint64))


def _different(parts: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Different sets of a task's texts, some million shingles at a time."""
    seen: set[int] = set()
    held, total = [], 0
    for part in parts:
        for own in sets(part["text"]):
            name = node(own) if len(own) else None
            if name is None or name in seen:
                continue
            seen.add(name)
            held.append(own)
            total += len(own)
            if total > _AT_ONCE:
                yield held
                held, total = [], 0
    if held:
        yield held


_MARK, _ENTRY, _PAIR, _HOT_ROW = 0, 1, 2, 3
_ENTRIES = "kind int, shingle long, place long, node long, row_key long, doc_id {kind}"
_LISTED = "kind int, shingle long, node long, other long, n long, other_n long, row_key long, doc_id {kind}"


def _entries(docs: DataFrame, last: np.ndarray, least: int) -> DataFrame:
    """A mark for each row and an entry for each shingle of a prefix.

    ``place`` is the set's size, and in its low 32 bits the position in the set. Of equal sets
    a task makes the entries once.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in parts:
            nodes, sizes, made, of, at = [], [], [], [], []
            for own in sets(part["text"]):
                name = node(own) if len(own) else 0
                nodes.append(name)
                sizes.append(len(own))
                if len(own) and name not in seen:
                    seen.add(name)
                    made.append(ordered(own, last)[: prefix_size(len(own), least)])
                    of.append(len(nodes) - 1)
                    at.append(len(made[-1]))
            marks, n = np.array(nodes, np.int64), np.array(sizes, np.int64)
            given = len(nodes)
            yield pa.record_batch(
                [
                    pa.array(np.full(given, _MARK, np.int32)), pa.array(marks), pa.array(n << 32),
                    pa.array(marks), part["row_key"], part["doc_id"],
                ],
                ["kind", "shingle", "place", "node", "row_key", "doc_id"],
            )
            if made:
                rows, lengths = np.repeat(of, at), np.array(at)
                position = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                none = pa.nulls(len(rows), pa.int64())
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(rows), _ENTRY, np.int32)),
                        pa.array(np.concatenate(made).view(np.int64)),
                        pa.array((n[rows] << 32) | position), pa.array(marks[rows]),
                        none, pa.nulls(len(rows), part["doc_id"].type),
                    ],
                    ["kind", "shingle", "place", "node", "row_key", "doc_id"],
                )

    own = docs.select(frames.row_key().alias("row_key"), "doc_id", "text")
    return shipping.map_batches(own, batches, _ENTRIES.format(kind=_kind(docs)))


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _listed(entries: DataFrame, doc_kind: str, least: int) -> DataFrame:
    """Marks as they are; pairs of sets in the same short list; rows of the hot lists, each
    with the first set of the list. Lists stream through a task in order of set size."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of a list that may go on
        hot: tuple[int, int, int] | None = None  # shingle, first set and its size
        schema = None
        for part in parts:
            schema = schema or _listed_schema(part["doc_id"].type)
            is_mark = part["kind"].to_numpy() == _MARK
            if is_mark.any():
                yield _as_listed(part.filter(pa.array(is_mark)), schema)
            rows = [part[c].to_numpy()[~is_mark] for c in ("shingle", "place", "node")]
            held = [np.concatenate(x) for x in zip(held, rows, strict=True)] if held else rows
            if not len(held[0]):
                continue
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if len(held[0]) - cut > _RUN_ROWS:
                cut = len(held[0])  # a hot list, taken in parts
            made, hot = _list_rows([x[:cut] for x in held], hot, least, schema)
            yield from made
            held = [x[cut:] for x in held]
        if held:
            yield from _list_rows(held, hot, least, schema)[0]

    dealt = entries.repartition("shingle").sortWithinPartitions("kind", "shingle", "place", "node")
    return shipping.map_batches(dealt, batches, _LISTED.format(kind=doc_kind))


def _listed_schema(doc_id: pa.DataType) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "{kind}": doc_id}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in _LISTED.split(", "))])


def _as_listed(marks: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    none = pa.nulls(marks.num_rows, pa.int64())
    n = pa.array(marks["place"].to_numpy() >> 32)
    return pa.record_batch(
        [marks["kind"], none, marks["node"], none, n, none, marks["row_key"], marks["doc_id"]], schema=schema
    )


def _list_rows(rows, hot, least: int, schema: pa.Schema):
    """Batches of the rows' lists, and the hot list that the last rows may be of."""
    shingle, place, name = rows
    if not len(shingle):
        return [], hot
    # Equal sets of several tasks are one.
    once = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (name[1:] != name[:-1])])
    shingle, place, name = shingle[once], place[once], name[once]
    n, position = place >> 32, place & 0xFFFFFFFF
    heads = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
    sizes = np.diff(np.concatenate([heads, [len(shingle)]]))
    is_hot = sizes > HOT
    first, first_n = name[heads].copy(), n[heads].copy()
    if hot is not None and hot[0] == shingle[0]:
        is_hot[0], first[0], first_n[0] = True, hot[1], hot[2]
    made = []
    few = np.repeat(~is_hot & (sizes > 1), sizes)
    if few.any():
        made.append(_short_lists(shingle[few], n[few], position[few], name[few], least))
    many = np.repeat(is_hot, sizes)
    if many.any():
        made.append(
            (
                _HOT_ROW, shingle[many], name[many], np.repeat(first, sizes)[many],
                n[many], np.repeat(first_n, sizes)[many],
            )
        )
    hot = (int(shingle[-1]), int(first[-1]), int(first_n[-1])) if is_hot[-1] else None
    batches = []
    for kind, *columns in made:
        none = pa.nulls(len(columns[0]), pa.int64())
        batches.append(
            pa.record_batch(
                [
                    pa.array(np.full(len(columns[0]), kind, np.int32)), *map(pa.array, columns),
                    none, pa.nulls(len(columns[0]), schema.field("doc_id").type),
                ],
                schema=schema,
            )
        )
    return batches, hot


def _short_lists(shingle, n, position, name, least: int):
    """The pairs of each list whose sizes and positions allow a link."""
    found = []
    at = np.arange(len(shingle))
    for step in range(1, HOT):
        at = at[at + step < len(shingle)]
        other = at + step
        # In order of size: behind the first partner that is too large all others are.
        goes_on = (shingle[other] == shingle[at]) & (100 * n[at] >= least * n[other])
        at, other = at[goes_on], other[goes_on]
        if not len(at):
            break
        most = (
            np.minimum(position[at], position[other]) + 1
            + np.minimum(n[at] - position[at], n[other] - position[other]) - 1
        )
        enough = (100 + least) * most >= least * (n[at] + n[other])
        found.append((at[enough], other[enough]))
    a = np.concatenate([x[0] for x in found]) if found else at[:0]
    b = np.concatenate([x[1] for x in found]) if found else at[:0]
    a, b = np.where(name[a] < name[b], a, b), np.where(name[a] < name[b], b, a)
    return _PAIR, shingle[a], name[a], name[b], n[a], n[b]


def _shared(listed: DataFrame) -> DataFrame:
    """(node, other, n, other_n, shared): pairs of the short lists, and in how many."""
    pairs = listed.filter(F.col("kind") == _PAIR)
    return pairs.groupBy("node", "other", "n", "other_n").agg(F.count("*").alias("shared"))


def _narrow(hot: DataFrame, shared: DataFrame) -> DataFrame:
    """(node, n, hot, most) of the sets in hot lists: the hot shingles of the prefix, and the
    most others of it that the set shares with any one set."""
    both = shared.select(F.explode(F.array("node", "other")).alias("node"), "shared")
    most = both.groupBy("node").agg(F.max("shared").alias("most"))
    own = hot.groupBy("node", "n").agg(F.sort_array(F.collect_list("shingle")).alias("hot"))
    return own.join(most, "node", "left").withColumn("most", F.coalesce("most", F.lit(0)))


def _possible(shared: Column, n: Column, m: Column, least: int) -> Column:
    """Can sets of n and m shingles be linked that share so many of their prefixes?

    Behind the prefix that ends first lie at most the other shingles of that set.
    """
    rest = F.greatest(n - _prefix_size(n, least), m - _prefix_size(m, least))
    return (shared + rest >= _needed(n, m, least)) & (100 * F.least(n, m) >= least * F.greatest(n, m))


def _candidates(shared: DataFrame, narrow: DataFrame, least: int) -> DataFrame:
    """(node, other) of short lists that may be linked; hot shingles, which were not counted,
    may all be shared."""
    of_hot = narrow.select("node", F.size("hot").alias("n_hot"))
    other_hot = of_hot.select(F.col("node").alias("other"), F.col("n_hot").alias("other_hot"))
    some = shared.join(of_hot, "node", "left").join(other_hot, "other", "left")
    more = F.least(F.coalesce("n_hot", F.lit(0)), F.coalesce("other_hot", F.lit(0)))
    return some.filter(
        _possible(F.col("shared") + more, F.col("n"), F.col("other_n"), least)
    ).select("node", "other")


def _possible_pairs(pairs: DataFrame, narrow: DataFrame, least: int) -> DataFrame:
    """Those of ``pairs`` (node, other) of hot lists that may be linked."""
    others = narrow.select(
        F.col("node").alias("other"), F.col("n").alias("m"), F.col("hot").alias("other_hot"),
        F.col("most").alias("other_most"),
    )
    both = pairs.join(narrow, "node").join(others, "other")
    shared = F.size(F.array_intersect("hot", "other_hot")) + F.least("most", "other_most")
    return both.filter(_possible(shared, F.col("n"), F.col("m"), least)).select("node", "other")


def _whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the rows whose ``row_key`` is in ``wanted``, and of few others.

    The texts are not shuffled: the filter, of fixed size, goes to all tasks. Not stored, as
    sets are larger than their texts: each round of links makes them again where the texts lie.
    """
    bitmap = frames.key_filter(wanted)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            some = part.filter(pa.array(frames.passing(bitmap, part["row_key"].to_numpy())))
            for first in range(0, some.num_rows, 500):
                own = [x for x in sets(some["text"].slice(first, 500)) if len(x)]
                yield pa.record_batch(
                    [
                        pa.array([node(x) for x in own], pa.int64()),
                        pa.array([x.view(np.int64) for x in own], pa.list_(pa.int64())),
                    ],
                    ["node", "shingles"],
                )

    own = docs.select(frames.row_key().alias("row_key"), "text")
    return shipping.map_batches(own, batches, "node long, shingles array<long>")


def _celled(pairs: DataFrame) -> DataFrame:
    """(cell, node, side): each set of ``node`` with that of ``other`` in some cell.

    A set that many others go with is in many cells.
    """
    many = pairs.groupBy("other").agg(F.ceil(F.count("*") / F.lit(CELL)).alias("cells"))
    dealt = frames.stored(
        pairs.join(many, "other").withColumn(
            "cell", F.xxhash64("other", F.pmod(F.xxhash64("node"), F.col("cells")))
        ),
        "cells",
    )
    both = F.lit(3)
    return dealt.select("cell", "node", both.alias("side")).unionByName(
        dealt.select("cell", F.col("other").alias("node"), both.alias("side")).distinct()
    )


def _links(cells: DataFrame, roots: DataFrame | None, whole: DataFrame, least: int) -> DataFrame:
    """(node, other): spanning links of the sets in each cell, between what ``roots`` leaves
    apart. Sets of side 1 are compared with those of side 2, those of side 3 with all."""
    own = cells.withColumn("root", F.col("node"))
    if roots is not None:
        own = cells.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    own = frames.stored(own.select("cell", "node", "root", "side"), "cell-sets")
    if own.count() <= SENT_ROWS:
        own = F.broadcast(own)  # whole sets are shuffled once, to their cells

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(parts):
            yield _cell_links(rows, least)

    dealt = own.join(whole, "node").select("cell", "node", "root", "side", "shingles")
    dealt = dealt.repartition("cell").sortWithinPartitions("cell")
    made = shipping.map_batches(dealt, batches, "node long, other long")
    return frames.stored(made.filter("node <> other"), "set-links")


def _cell_links(rows: pa.Table, least: int) -> pa.RecordBatch:
    """Links of a cell's sets, those that connect something only."""
    column = rows["shingles"].combine_chunks()
    sizes = column.value_lengths().to_numpy().astype(np.int64)
    order = np.lexsort((rows["node"].to_numpy(), sizes))
    name, root, side = (rows[c].to_numpy()[order] for c in ("node", "root", "side"))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    flat = column.flatten().to_numpy()
    own = [flat[ends[k] : ends[k + 1]] for k in order.tolist()]
    sizes = sizes[order]
    # The index: for each shingle the sets with it, in order of size.
    _, place = np.unique(np.concatenate(own), return_inverse=True)
    sets_of = np.repeat(np.arange(len(own)), sizes)[np.argsort(place, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(place))])
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    shingles = [np.sort(place[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def overlaps(some: np.ndarray) -> np.ndarray:
        lengths = starts[some + 1] - starts[some]
        at = np.repeat(starts[some] - (np.cumsum(lengths) - lengths), lengths)
        return np.bincount(sets_of[at + np.arange(len(at))], minlength=len(own))

    _, first, which = np.unique(root, return_index=True, return_inverse=True)
    label = first[which]
    found: list[tuple[int, int]] = []
    before, answers = None, None  # the last set compared, and its overlaps
    for k in range(len(own)):
        partner = ((side & side[k]) == 0) | (side == 3) | (side[k] == 3)
        open_ = partner & (label != label[k])
        open_ &= (100 * np.minimum(sizes, sizes[k])) >= least * np.maximum(sizes, sizes[k])
        if not open_.any():
            continue
        mine = shingles[k]
        if before is not None:
            new = np.setdiff1d(mine, shingles[before], assume_unique=True)
            gone = np.setdiff1d(shingles[before], mine, assume_unique=True)
        if before is not None and len(new) + len(gone) < len(mine):
            answers = answers + overlaps(new) - overlaps(gone)
        else:
            answers = overlaps(mine)
        before = k
        every = sizes + sizes[k] - answers
        near = np.flatnonzero(open_ & (100 * answers >= least * every))
        near = near[np.unique(label[near], return_index=True)[1]]
        components.union(label, np.full(len(near), k), near)
        found += [(k, other) for other in near.tolist()]
    at = np.array(found, np.int64).reshape(-1, 2)
    return pa.record_batch([pa.array(name[at[:, 0]]), pa.array(name[at[:, 1]])], ["node", "other"])


def _open(hot: DataFrame, roots: DataFrame) -> DataFrame:
    """(shingle, node, root, n_sets) of the hot lists whose sets are not all connected."""
    own = frames.stored(
        hot.join(roots, "node", "left").select(
            "shingle", "node", F.coalesce("root", "node").alias("root")
        ),
        "hot-rows",
    )
    apart = (
        own.groupBy("shingle")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n_sets"))
        .filter("low < high")
        .select("shingle", "n_sets")
    )
    return frames.stored(own.join(frames.stored(apart, "open-lists"), "shingle"), "open-rows")


def _drawn(open_: DataFrame, turn: int) -> DataFrame:
    """(node, other): each set of a list with one drawn from it, if not connected."""
    place = F.struct(F.xxhash64("node", F.lit(turn)).alias("place"), "node", "root")
    centre = frames.stored(open_.groupBy("shingle").agg(F.min(place).alias("centre")), "drawn-sets")
    return (
        open_.join(centre, "shingle")
        .filter("root <> centre.root")
        .select("node", F.col("centre.node").alias("other"))
        .distinct()
    )


def _blocks(open_: DataFrame) -> DataFrame:
    """(cell, node, root, side): all sets of each list together in some cell, block with block."""
    blocks = F.ceil(F.col("n_sets") / F.lit(BLOCK))
    at = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("at")
    side = F.when(F.col("own") < F.col("at"), 1).when(F.col("own") > F.col("at"), 2).otherwise(3)
    return open_.select(
        "shingle", "node", "root", F.pmod(F.xxhash64("node"), blocks).alias("own"), at
    ).select(
        F.xxhash64("shingle", F.least("own", "at"), F.greatest("own", "at")).alias("cell"),
        "node",
        "root",
        side.alias("side"),
    )


def _survivors(cells: DataFrame, narrow: DataFrame, least: int) -> DataFrame:
    """(cell, node, side) of the sets that may be linked with another of their cell.

    Judged by the shared part of the prefixes only, so whole sets are not needed. Sets with
    the same hot shingles have the same answers, which are made once.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(parts):
            keep = pa.array(_may_link(rows, least))
            yield from rows.select(["cell", "node", "side"]).filter(keep).to_batches()

    dealt = cells.join(narrow, "node").repartition("cell").sortWithinPartitions("cell", "node")
    made = shipping.map_batches(
        dealt.select("cell", "node", "side", "root", "n", "hot", "most"),
        batches,
        "cell long, node long, side int",
    )
    return frames.stored(made, "surviving-sets")


def _whole_cells(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for part in parts:
        cell = part["cell"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            if first == last:
                continue
            if held and held[0]["cell"][0].as_py() != cell[first]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)


def _may_link(rows: pa.Table, least: int) -> np.ndarray:
    side, root, n, most = (rows[c].to_numpy() for c in ("side", "root", "n", "most"))
    rest = n - (n - (least * n + 99) // 100 + 1)
    column = rows["hot"].combine_chunks()
    sizes = column.value_lengths().to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    _, place = np.unique(column.flatten().to_numpy(), return_inverse=True)
    sets_of = np.repeat(np.arange(len(n)), sizes)[np.argsort(place, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(place))])
    alike: dict[bytes, list[int]] = {}
    for k in range(len(n)):
        alike.setdefault(place[ends[k] : ends[k + 1]].tobytes(), []).append(k)
    keep = np.zeros(len(n), bool)
    for some in alike.values():
        own = place[ends[some[0]] : ends[some[0] + 1]]
        lists = [sets_of[starts[t] : starts[t + 1]] for t in own.tolist()]
        shared = np.bincount(np.concatenate(lists), minlength=len(n))
        for k in some:
            enough = shared + np.minimum(most, most[k]) + np.maximum(rest, rest[k])
            near = (100 + least) * enough >= least * (n + n[k])
            near &= 100 * np.minimum(n, n[k]) >= least * np.maximum(n, n[k])
            near &= (root != root[k]) & (((side & side[k]) == 0) | (side == 3) | (side[k] == 3))
            if near.any():
                keep |= near
                keep[k] = True
    return keep


def classes(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(row_key, doc_id, node, n, root) of each row of ``docs``; linked sets, also by way of
    others, have the same root. Rows without words have no root."""
    last = frequent(docs)
    listed = frames.stored(_listed(_entries(docs, last, least), _kind(docs), least), "lists")
    marks = listed.filter(F.col("kind") == _MARK).select("row_key", "doc_id", "node", "n")
    hot = listed.filter(F.col("kind") == _HOT_ROW).select("shingle", "node", "other", "n")
    shared = frames.stored(_shared(listed), "shared-shingles")
    narrow = frames.stored(_narrow(hot, shared), "hot-sets")
    pairs = frames.stored(_candidates(shared, narrow, least), "candidates")
    with_first = hot.filter(F.col("node") != F.col("other")).select("node", "other").distinct()
    # Each set with the least of its candidates first: most of what is linked is then
    # connected, and candidates in one component need no comparison.
    least_one = (
        pairs.select(F.col("other").alias("node"), F.col("node").alias("other"))
        .unionByName(_possible_pairs(with_first, narrow, least))
        .groupBy("node")
        .agg(F.min("other").alias("other"))
    )
    named = pairs.select(F.explode(F.array("node", "other")).alias("node")).unionByName(hot.select("node"))
    rows = marks.filter("n > 0").join(named.distinct(), "node", "left_semi")
    wanted = rows.groupBy("node").agg(F.min("row_key").alias("row_key"))
    whole = _whole_sets(docs, wanted)
    links = _links(_celled(least_one), None, whole, least)
    roots = frames.concluded(partial(components.connected, links), "roots")
    other_roots = roots.select(F.col("node").alias("other"), F.col("root").alias("other_root"))
    apart = (
        pairs.join(roots, "node", "left")
        .join(other_roots, "other", "left")
        .filter(F.coalesce("root", "node") != F.coalesce("other_root", "other"))
        .select("node", "other")
    )
    apart = frames.stored(apart, "apart")
    if not apart.isEmpty():
        links = links.unionByName(_links(_celled(apart), roots, whole, least))
        roots = frames.concluded(partial(components.connected, links), "roots")
    open_ = _open(hot, roots)
    for turn in range(TURNS):
        # Lists of several blocks: first each set with one that is drawn.
        large = open_.filter(F.col("n_sets") > BLOCK)
        drawn = frames.stored(_possible_pairs(_drawn(large, turn), narrow, least), "drawn-pairs")
        if drawn.isEmpty():
            break
        links = links.unionByName(_links(_celled(drawn), roots, whole, least))
        roots = frames.concluded(partial(components.connected, links), "roots")
        open_ = _open(hot, roots)
    cells = _survivors(_blocks(open_), narrow, least)
    if not cells.isEmpty():
        links = links.unionByName(_links(cells, roots, whole, least))
        roots = frames.concluded(partial(components.connected, links), "roots")
    return marks.join(roots, "node", "left").withColumn(
        "root", F.when(F.col("n") > 0, F.coalesce("root", "node"))
    )


def plan(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, n_shingles, root, component_id.

    ``component_id`` is the smallest doc_id that links reach from the document, itself
    included; a NULL doc_id is no smallest one, and a component of such rows only has a
    NULL id. Equal sets are linked. NULL, empty and wordless texts have no shingles, no
    root and their own doc_id for a component. A text of fewer words than a shingle is one
    shingle. An empty table gives no rows. Sets and shingles are told apart by 64 bits.
    """
    placed = frames.concluded(lambda: classes(docs, least), "set-classes")
    ids = placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    # Stored, so that the join with it may split the rows of a frequent set.
    joined = placed.join(frames.stored(ids, "component-ids"), "root", "left")
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "row_key", "doc_id", F.col("n").alias("n_shingles"), "root", own.alias("component_id")
    )
