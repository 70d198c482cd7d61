"""Benchmark decontamination by Wu-Manber search for windows of words.

The pattern set are all windows of ``WINDOW`` consecutive words of the benchmark items; an
item of fewer words is one window. The alphabet of the search is the word: a block is two
words, a shift table says how far a block lets the search jump, and a bucket of windows
by their last and first block is only looked at where the shift is 0. What a bucket
offers is compared word by word and byte by byte.

All documents of a batch are searched at once, each cut into lanes that overlap by a
window; a step of numpy moves every lane by its own shift.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm import frames, shipping, texts

WINDOW = 10
#: Bytes of item texts that one search holds. A larger benchmark is searched for in
#: blocks of items, one pass over the documents each.
BLOCK_BYTES = 16 << 20
#: Entries of the shift table, as a power of two.
_TABLE_BITS = 20
#: Words that a lane covers, beside the window it shares with the next.
_LANE = 256

# ASCII word characters after lower-casing; all bytes from 0x80 on belong to words.
_WORD = np.zeros(256, bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


@dataclass
class Words:
    """Words of some texts: where they are in ``data``, and their hashes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    before: np.ndarray  # words before each text; one more for the end
    hashes: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    low = texts.lowered(data)
    starts, ends, before = texts.word_spans(_WORD[low], offsets)
    return Words(low, starts, ends, before, texts.word_hashes(low, starts, ends))


@dataclass
class Table:
    """The windows of one length and what the search needs to find them."""

    length: int
    block: int
    first_word: np.ndarray  # of each different window, in the items' words
    items: list[np.ndarray]  # the numbers of the items that have it
    buckets: np.ndarray  # sorted hash of last and first block, of each window
    shifts: np.ndarray


def tables(items: Words, window: int = WINDOW) -> list[Table]:
    """A table for each length of windows; only items shorter than a window have others."""
    counts = np.diff(items.before)
    found = []
    for length in sorted({min(int(n), window) for n in counts if n}):
        own = np.flatnonzero(counts >= window if length == window else counts == length)
        each = counts[own] - length + 1
        item = np.repeat(own, each)
        first = np.repeat(items.before[own], each) + (
            np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        )
        rows = items.hashes[first[:, None] + np.arange(length)]
        _, where, same = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        order = np.argsort(same, kind="stable")
        cuts = np.searchsorted(same[order], np.arange(1, len(where)))
        holders = [np.unique(x) for x in np.split(item[order], cuts)]
        block = min(2, length)
        rows = rows[where]
        shifts = np.full(1 << _TABLE_BITS, length - block + 1, np.int64)
        for last in range(block, length + 1):
            at = _slot(_block(rows[:, last - block : last].T))
            np.minimum.at(shifts, at, length - last)
        buckets = _bucket(_block(rows[:, length - block :].T), _block(rows[:, :block].T))
        by = np.argsort(buckets, kind="stable")
        found.append(
            Table(length, block, first[where][by], [holders[k] for k in by], buckets[by], shifts)
        )
    return found


def _block(words: np.ndarray) -> np.ndarray:
    return words[0] if len(words) == 1 else texts.mixed(words[0] ^ (words[1] << np.uint64(1)))


def _slot(block: np.ndarray) -> np.ndarray:
    return (block >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def _bucket(last: np.ndarray, first: np.ndarray) -> np.ndarray:
    return texts.mixed(last ^ (first >> np.uint64(1)))


def search(docs: Words, items: Words, table: Table) -> tuple[np.ndarray, np.ndarray]:
    """(word of the documents, window of the table) of every occurrence."""
    at, stop = _lanes(docs.before, table.length)
    candidates = []
    while len(at):
        ends = at + table.length
        shift = table.shifts[_slot(_block(docs.hashes[ends - table.block + np.arange(table.block)[:, None]]))]
        candidates.append(at[shift == 0])
        at = at + np.maximum(shift, 1)
        going = at < stop
        at, stop = at[going], stop[going]
    where = np.concatenate(candidates) if candidates else np.zeros(0, np.int64)
    tail = where + table.length - table.block
    of = _bucket(
        _block(docs.hashes[tail + np.arange(table.block)[:, None]]),
        _block(docs.hashes[where + np.arange(table.block)[:, None]]),
    )
    low, high = np.searchsorted(table.buckets, of), np.searchsorted(table.buckets, of, "right")
    offered = high - low
    where, window = np.repeat(where, offered), np.repeat(low - (np.cumsum(offered) - offered), offered)
    window = window + np.arange(len(window))
    for k in range(table.length):
        equal = _same_words(docs, where + k, items, table.first_word[window] + k)
        where, window = where[equal], window[equal]
    return where, window


def _lanes(before: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of a window, of pieces of the texts."""
    starts = np.maximum(np.diff(before) - length + 1, 0)
    each = -(-starts // _LANE)
    text = np.repeat(np.arange(len(starts)), each)
    first = before[text] + _LANE * (np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each))
    return first, np.minimum(first + _LANE, before[text] + starts[text])


def _same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    size = a.ends[i] - a.starts[i]
    equal = (a.hashes[i] == b.hashes[j]) & (size == b.ends[j] - b.starts[j])
    kept = np.flatnonzero(equal)
    size = size[kept]
    which = np.repeat(np.arange(len(kept)), size)
    place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    differs = a.data[a.starts[i[kept]][which] + place] != b.data[b.starts[j[kept]][which] + place]
    equal[kept[which[differs]]] = False
    return equal


def hits(docs: Words, items: Words, found: list[Table]) -> tuple[list, list[tuple[int, int]]]:
    """Each text's spans of hit words, merged; (text, item) for each item it has windows of."""
    spans: list[list[tuple[int, int]]] = []
    begins, closes, holders, texts_ = [], [], [], []
    for table in found:
        where, window = search(docs, items, table)
        begins.append(where)
        closes.append(where + table.length)
        sizes = np.array([len(table.items[w]) for w in window], np.int64)
        text = np.searchsorted(docs.before, where, "right") - 1
        texts_.append(np.repeat(text, sizes))
        holders.append(
            np.concatenate([table.items[w] for w in window]) if len(window) else np.zeros(0, np.int64)
        )
    begin, close = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (begins, closes))
    change = np.zeros(len(docs.starts) + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, close, -1)
    hit = np.cumsum(change)[:-1] > 0
    first, last, before = texts.word_spans(hit, docs.before)
    own = docs.before[np.searchsorted(docs.before, first, "right") - 1] if len(first) else first
    for k in range(len(docs.before) - 1):
        part = slice(before[k], before[k + 1])
        spans.append(list(zip((first[part] - own[part]).tolist(), (last[part] - own[part]).tolist(), strict=True)))
    pairs = {*zip(*(np.concatenate(x).tolist() if x else [] for x in (texts_, holders)), strict=True)}
    return spans, sorted(pairs)


def marked(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with n_words, hit_spans, hit_items and contaminated.

    ``hit_spans`` are ranges of words (from, to) inside any occurrence of a window, merged
    and in order; ``hit_items`` the item_ids with an occurring window, each once, in order.
    A word is a run of digits, letters a-z (A-Z count as such) and characters beyond
    ASCII. NULL and empty texts have no words; an item without words is never found; an
    item without an id is not told from others of that kind. Rows are kept as they are,
    repeated ones too. Existing columns of the four names are replaced.

    Items are gathered in blocks of ``block_bytes`` at most (or one item), so what a task
    holds of the benchmark has that bound; each block is a pass over the documents, which
    is written down before the next.
    """
    added = ["n_words", "hit_spans", "hit_items", "contaminated"]
    result = docs.drop(*added)
    (spans, items, count) = added[1], added[2], added[0]
    blocks = list(_blocks(benchmark, block_bytes)) or [([], [])]
    kind = benchmark.schema["item_id"].dataType
    for number, (ids, block) in enumerate(blocks):
        result = _pass(result, ids, block, kind, window)
        if number < len(blocks) - 1:
            result = frames.stored(result, "hits")
    merged = result.withColumn(spans, _merged(F.col(spans))) if len(blocks) > 1 else result
    return (
        merged.withColumn(items, F.array_sort(F.array_distinct(items)))
        .withColumn("contaminated", F.size(spans) > 0)
        .select(*docs.drop(*added).columns, count, spans, items, "contaminated")
    )


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of runs of items whose texts have ``limit`` bytes or fewer."""
    ids, block, held = [], [], 0
    for row in benchmark.select("item_id", frames.whole_text().alias("text")).toLocalIterator():
        size = len(row["text"].encode())
        if ids and held + size > limit:
            yield ids, block
            ids, block, held = [], [], 0
        ids.append(row["item_id"])
        block.append(row["text"])
        held += size
    if ids:
        yield ids, block


def _pass(docs: DataFrame, ids: list, block: list[str], kind: T.DataType, window: int) -> DataFrame:
    goes_on = "hit_spans" in docs.columns
    span = T.ArrayType(T.StructType([T.StructField("from", T.IntegerType()), T.StructField("to", T.IntegerType())]))
    own = [f for f in docs.schema.fields if f.name not in ("n_words", "hit_spans", "hit_items")]
    schema = T.StructType(
        [
            *own,
            T.StructField("n_words", T.LongType()),
            T.StructField("hit_spans", span),
            T.StructField("hit_items", T.ArrayType(kind)),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(shared.value, window)
        for part in parts:
            counts, spans, items = find(part["text"])
            items = [[ids[k] for k in found] for found in items]
            if goes_on:
                spans = [[(s["from"], s["to"]) for s in a] + b for a, b in zip(part["hit_spans"].to_pylist(), spans, strict=True)]
                items = [a + b for a, b in zip(part["hit_items"].to_pylist(), items, strict=True)]
            arrow = {f.name: part[f.name] for f in own}
            arrow["n_words"] = pa.array(counts, pa.int64())
            arrow["hit_spans"] = pa.array(
                [[{"from": a, "to": b} for a, b in row] for row in spans],
                pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])),
            )
            arrow["hit_items"] = pa.array(items, pa.list_(_arrow(kind)))
            yield pa.record_batch(list(arrow.values()), list(arrow))

    return shipping.map_batches(docs, batches, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    return pa.string() if isinstance(kind, T.StringType) else pa.int32() if isinstance(kind, T.IntegerType) else pa.int64()


def _finder(block: list[str], window: int) -> Callable[[pa.Array], tuple[list, list, list]]:
    """A function that gives (number of words, spans, items) of each text of a column."""
    encoded = [text.encode() for text in block]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in encoded], dtype=np.int64)])
    items = words_of(np.frombuffer(b"".join(encoded), np.uint8), offsets.astype(np.int64))
    found = tables(items, window)

    def find(column: pa.Array) -> tuple[list, list, list]:
        counts, spans, holders = [], [], [[] for _ in range(len(column))]
        for first, data, offsets in texts.slices(column):
            docs = words_of(data, offsets)
            counts += np.diff(docs.before).tolist()
            own, held = hits(docs, items, found)
            spans += own
            for text, item in held:
                holders[first + text].append(item)
        return counts, spans, holders

    return find


def _merged(spans: Column) -> Column:
    """Spans of several passes as ranges that do not touch."""
    empty = F.array().cast("array<struct<from:int,to:int>>")
    return F.aggregate(
        F.array_sort(spans),
        empty,
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["to"] >= x["from"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["from"].alias("from"),
                        F.greatest(F.element_at(done, -1)["to"], x["to"]).alias("to"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["to"] - x["from"])


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark."""
    renamed = dict(zip(["n_words", "hit_spans", "hit_items", "contaminated"], frames.free(docs, *["own"] * 4), strict=True))
    clashing = [c for c in renamed if c in docs.columns]
    kept = docs.withColumnsRenamed({c: renamed[c] for c in clashing})
    return (
        marked(kept, benchmark, window)
        .filter(~F.col("contaminated"))
        .drop(*renamed)
        .withColumnsRenamed({renamed[c]: c for c in clashing})
        .select(*docs.columns)
    )
