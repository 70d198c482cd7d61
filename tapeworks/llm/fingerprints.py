"""Document fingerprints: MinHash signatures.

A text's words (anything between white space, A-Z lower-cased) give shingles of
``SHINGLE`` words, as a set; a text of fewer words is one shingle. Each of ``SIZE``
universal hash functions a * x + b modulo 2**64, of which the upper half counts, orders
all shingles, and the signature holds the least value of each. Two texts agree in a share
of their signatures that estimates the Jaccard similarity of their shingle sets.

``compared`` gives fingerprints; ``near_duplicates`` and ``dedup`` join bands and verify.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm import components, frames, shipping, texts

SHINGLE = 5
SIZE = 128
SEED = 7
#: Bands of rows: texts of similarity 0.8 share one with a probability above 0.9999.
BANDS, ROWS = 25, 5
LEAST_SIMILARITY = 0.8
#: Bands of more texts are compared by blocks of so many, after so many turns of one
#: drawn text against all others.
SMALL_BAND, BLOCK_TEXTS, TURNS = 16, 512, 4
#: Bytes of texts whose shingles are permuted at once, so that they stay in the cache.
_AT_ONCE = 1 << 18
_NONE = np.uint64(0xFFFFFFFF)

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def functions(size: int = SIZE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of the hash functions."""
    drawn = np.random.default_rng(seed).integers(0, 2**64, (2, size), np.uint64)
    return drawn[0] | np.uint64(1), drawn[1]


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """32 bits of every shingle (as 64), and the number of shingles before each text."""
    low = texts.lowered(data)
    starts, ends, before = texts.word_spans(_IS_WORD[low], offsets)
    hashes = texts.word_hashes(low, starts, ends)
    counts = np.diff(before)
    each = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(each)])
    own = np.repeat(np.arange(len(counts)), each)
    at = before[own] + np.arange(len(own)) - first[own]
    folded = np.zeros(len(at), np.uint64)
    left = before[own + 1]
    for k in range(words):
        # Beyond the end of a short text nothing is added.
        inside = at + k < left
        word = hashes[np.minimum(at + k, len(hashes) - 1)] if len(hashes) else folded
        folded = np.where(inside, folded * np.uint64(0x100000001B3) + texts.mixed(word), folded)
    return texts.mixed(folded) >> np.uint64(32), first


def signatures(column: pa.Array, factors: np.ndarray, summands: np.ndarray) -> np.ndarray:
    """A row of 32-bit values for each text; all ones where there is no shingle."""
    result = np.full((len(column), len(factors)), _NONE, np.uint64)
    for row, data, offsets in texts.slices(column, _AT_ONCE):
        hashes, first = shingles(data, offsets)
        some = np.flatnonzero(np.diff(first))
        if not len(some):
            continue
        for k, (factor, summand) in enumerate(zip(factors, summands, strict=True)):
            least = np.minimum.reduceat(hashes * factor + summand, first[some])
            result[row + some, k] = least >> np.uint64(32)
    return result.astype(np.uint32)


def hexadecimal(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def compared(docs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Each row's fingerprint, its next row's, and that of a text made of both.

    Rows are in descending order of doc_id, then of a hash of the text; rows without a
    doc_id come last; after the last row comes the first. The edited text is the row's
    text with the last half of its code points (rounded down) replaced by as many of the
    next text's first ones, or all it has. Columns: row_key, doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next. NULL counts as empty; texts
    without words have equal fingerprints. A single row is next to itself; an empty table
    gives no rows.

    Texts are shuffled once, compressed, by ranges of doc_id. The first rows of a range go
    to the range before it as well, so that every task finds the next text of its own last
    row. With ``classes``, the rows of ``near_duplicates(docs)``, there are also class_id and
    class_rows: these narrow rows go to the ranges with the texts, so that fingerprints,
    which are as large as the texts, are not shuffled.
    """
    ranges = frames.tasks(docs)
    kind = _kind(docs)
    result = f"row_key long, doc_id {kind}, {_RESULT}"
    if classes is not None:
        result += f", class_id {kind}, class_rows long"
    (bucket_of, heads) = _ranges(docs.select("doc_id", "text"), ranges)
    if not heads:
        return docs.sparkSession.createDataFrame([], result)
    order = sorted(heads)
    before = {b: order[k - 1] for k, b in enumerate(order)}  # the first is next to the last
    is_head = [
        F.when(
            (F.col("bucket") == b)
            & (F.xxhash64("text").eqNullSafe(F.lit(head)) if b == ranges else F.col("doc_id") == head),
            F.lit(before[b]),
        )
        for b, head in heads.items()
    ]
    copies = F.array_compact(
        F.array(
            F.struct(F.col("bucket").alias("range"), F.lit(False).alias("only_next")),
            F.when(
                F.col("target").isNotNull(),
                F.struct(F.col("target").alias("range"), F.lit(True).alias("only_next")),
            ),
        )
    )
    marked = (
        docs.select("doc_id", "text")
        .withColumn("bucket", bucket_of)
        .withColumn("target", F.coalesce(*is_head))
        .select(
            "bucket", "target", "doc_id", frames.row_key().alias("row_key"),
            F.xxhash64(frames.whole_text()).alias("node"),
            frames.whole_text().cast("binary").alias("text"),
        )
    )
    dealt = _packed(marked).withColumn("copy", F.explode(copies)).select(*_DEALT, "copy.*")
    if classes is not None:
        # Equal rows are of one class.
        of_row = classes.select(
            "doc_id", "node", bucket_of.alias("range"), F.lit(False).alias("only_next"), "class_id", "class_rows"
        ).distinct()
        dealt = dealt.unionByName(of_row, allowMissingColumns=True)
    dealt = dealt.repartitionById(ranges + 1, "range").sortWithinPartitions(
        "range", "only_next", F.col("doc_id").desc_nulls_last(), "node", F.col("row_key").asc_nulls_first()
    )
    factors, summands = functions()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in _unpacked(parts):
            if not part.num_rows:
                continue
            rows = pa.Table.from_batches([part])
            signature = signatures(part["text"], factors, summands)
            if held is not None:
                rows = pa.concat_tables([held[0], rows])
                signature = np.concatenate([held[1], signature])
            rows = rows.combine_chunks()
            yield from _pairs(rows, signature, factors, summands)
            # A copy, so that the last row does not keep the whole batch.
            held = (pa.Table.from_pylist(rows.slice(rows.num_rows - 1).to_pylist(), rows.schema), signature[-1:].copy())

    return shipping.map_batches(dealt, batches, result)


_DEALT = ["doc_id", "row_key", "node", "packed", "n_bytes"]


def _packed(marked: DataFrame) -> DataFrame:
    """``marked`` with ``packed`` and ``n_bytes`` in place of the bytes ``text``."""
    kind = _kind(marked)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 3)
        for part in parts:
            for first in range(0, part.num_rows, 1000):
                some = part.slice(first, 1000)
                whole = some["text"].to_pylist()
                packed = pa.array([codec.compress(x, asbytes=True) for x in whole], pa.binary())
                sizes = pa.array([len(x) for x in whole], pa.int64())
                kept = [some[c] for c in names]
                yield pa.record_batch([*kept, packed, sizes], [*names, "packed", "n_bytes"])

    names = ["bucket", "target", "doc_id", "row_key", "node"]
    schema = f"bucket int, target int, doc_id {kind}, row_key long, node long, packed binary, n_bytes long"
    return shipping.map_batches(marked, batches, schema)


def _unpacked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of texts, each with its text and the class of the row of classes before it."""
    codec = pa.Codec("zstd", 3)
    said = None  # the last row of classes
    for part in (x.slice(k, 1000) for x in parts for k in range(0, x.num_rows, 1000)):
        names = [c for c in ("class_id", "class_rows") if c in part.schema.names]
        is_text = part["row_key"].is_valid().to_numpy(zero_copy_only=False)
        rows = part.filter(pa.array(is_text))
        whole = [
            codec.decompress(x, n, asbytes=True)
            for x, n in zip(rows["packed"].to_pylist(), rows["n_bytes"].to_pylist(), strict=True)
        ]
        columns = [rows[c] for c in ("row_key", "doc_id", "only_next")]
        columns.append(pa.array(whole, pa.large_binary()).cast(pa.large_string()))
        if names:
            told = pa.Table.from_batches([part.select(names).filter(pa.array(~is_text))])
            told = told if said is None else pa.concat_tables([said, told])
            at = (np.cumsum(~is_text) - (said is None))[is_text]
            # A range may begin with texts of the next one, which need no class.
            found = told.take(pa.array(at, mask=at < 0)).combine_chunks()
            columns += [pa.concat_arrays(found[c].chunks) if found[c].num_chunks else pa.nulls(0, found[c].type) for c in names]
            said = pa.Table.from_pylist(told.slice(max(0, told.num_rows - 1)).to_pylist(), told.schema)
            said = said if said.num_rows else None
        yield pa.record_batch(columns, ["row_key", "doc_id", "only_next", "text", *names])


_RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _pairs(rows: pa.Table, signature: np.ndarray, factors, summands) -> Iterator[pa.RecordBatch]:
    """The results of all rows but the last, some at a time."""
    own = np.flatnonzero(~rows["only_next"].to_numpy()[:-1])
    keys, ids = rows["row_key"].combine_chunks(), rows["doc_id"].combine_chunks()
    column = rows["text"].combine_chunks()
    given = [c for c in ("class_id", "class_rows") if c in rows.column_names]
    for first in range(0, len(own), 500):
        some = own[first : first + 500]
        low, high = int(some[0]), int(some[-1])
        held = column.slice(low, high - low + 2).to_pylist()
        pairs = [(held[i - low], held[i - low + 1]) for i in some]
        edited = [text[: len(text) - len(text) // 2] + other[: len(text) // 2] for text, other in pairs]
        changed = signatures(pa.array(edited, pa.large_string()), factors, summands)
        yield pa.record_batch(
            [
                keys.take(pa.array(some)),
                ids.take(pa.array(some)),
                pa.array([len(text) for text, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
                pa.array([hexadecimal(x) for x in signature[some]]),
                pa.array([hexadecimal(x) for x in changed]),
                pa.array(likeness(signature[some], changed)),
                pa.array(likeness(signature[some], signature[some + 1])),
                *(rows[c].combine_chunks().take(pa.array(some)) for c in given),
            ],
            ["row_key", "doc_id", *(c.split()[0] for c in _RESULT.split(", ")), *given],
        )


def _ranges(docs: DataFrame, ranges: int) -> tuple[Column, dict[int, int]]:
    """The range of each row, 0 for the largest ids, and each range's first doc_id.

    The driver sees a number per range. Rows without a doc_id are range ``ranges``, of
    which the least hash of a text is returned.
    """
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL")
    shares = [k / ranges for k in range(1, ranges)]
    cuts = sorted(set(ids.approxQuantile("doc_id", shares, 0.25 / ranges))) if shares else []
    above = F.array(*(F.lit(cut) for cut in cuts)) if cuts else F.array().cast("array<double>")
    bucket = F.when(F.col("doc_id").isNull(), F.lit(ranges)).otherwise(
        F.size(F.filter(above, lambda cut: cut > F.col("doc_id")))
    ).cast("int")
    heads = {
        row["range"]: row["head"]
        for row in ids.groupBy(bucket.alias("range")).agg(F.max("doc_id").alias("head")).collect()
    }
    nameless = docs.filter("doc_id IS NULL").agg(F.min(F.xxhash64("text")).alias("head")).first()
    if nameless["head"] is not None:
        heads[ranges] = nameless["head"]
    return bucket, heads


def banded(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, node, bands) of each row; ``node`` is a hash of its text."""
    factors, summands = functions()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = signatures(part["text"], factors, summands).astype(np.uint64)
            bands = np.tile(np.arange(BANDS, dtype=np.uint64), (len(found), 1))
            for k in range(ROWS):
                bands = texts.mixed(bands * np.uint64(0x100000001B3) + found[:, k : BANDS * ROWS : ROWS] + np.uint64(1))
            flat = pa.array(bands.view(np.int64).reshape(-1))
            ends = pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32))
            kept = [part[c] for c in ("row_key", "doc_id", "node")]
            yield pa.record_batch(
                [*kept, pa.ListArray.from_arrays(ends, flat)], ["row_key", "doc_id", "node", "bands"]
            )

    own = docs.select(
        frames.row_key().alias("row_key"), "doc_id", F.xxhash64(frames.whole_text()).alias("node"), "text"
    )
    schema = f"row_key long, doc_id {_kind(docs)}, node long, bands array<long>"
    return shipping.map_batches(own, batches, schema)


def _passing(marked: DataFrame, shared: DataFrame) -> DataFrame:
    """(node, band) of the rows of ``marked`` whose band is in ``shared``, and of few others.

    A filter of fixed size goes to all tasks, so that most bands, which one text has, are
    not shuffled again.
    """
    bitmap = frames.key_filter(shared.select(F.col("band").alias("row_key")))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            bands = part["bands"].flatten().to_numpy()
            at = np.flatnonzero(frames.passing(bitmap, bands))
            nodes = part["node"].to_numpy()[at // BANDS]
            yield pa.record_batch([pa.array(nodes), pa.array(bands[at])], ["node", "band"])

    return shipping.map_batches(marked.select("node", "bands"), batches, "node long, band long")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles): the set of shingle hashes of the texts in ``wanted`` (node, row_key).

    The texts are not shuffled: a filter of fixed size, which few others pass, goes to all
    tasks.
    """
    bitmap = frames.key_filter(wanted.select("row_key"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            some = part.filter(pa.array(frames.passing(bitmap, part["row_key"].to_numpy())))
            found: list[np.ndarray] = []
            for _, data, offsets in texts.slices(some["text"]):
                hashes, first = shingles(data, offsets)
                whole = hashes.astype(np.uint32).view(np.int32)
                found += [np.unique(whole[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.record_batch(
                [some["node"], pa.array(found, pa.list_(pa.int32()))], ["node", "shingles"]
            )

    own = docs.select(
        F.xxhash64(frames.whole_text()).alias("node"), frames.row_key().alias("row_key"), "text"
    )
    made = shipping.map_batches(own, batches, "node long, shingles array<int>")
    return made.join(wanted, "node", "left_semi").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (node, other) whose shingle sets are as similar as ``least``."""
    pairs = frames.stored(pairs.distinct(), "candidates")
    # Only the sets that are asked for are shuffled.
    own = sets.join(pairs.select("node").distinct(), "node", "left_semi")
    others = sets.withColumnRenamed("node", "other").join(
        pairs.select("other").distinct(), "other", "left_semi"
    ).withColumnRenamed("shingles", "other_shingles")
    both = pairs.join(own, "node").join(others, "other")
    shared = F.size(F.array_intersect("shingles", "other_shingles"))
    every = F.size("shingles") + F.size("other_shingles") - shared
    # Without shingles on both sides the texts count as alike.
    alike = F.when(every == 0, F.lit(1.0)).otherwise(shared / every)
    return frames.stored(both.filter(alike >= least).select("node", "other"), "verified")


def _centred(open_: DataFrame, turn: int) -> DataFrame:
    """(node, other): every text of a band with one of its texts, if not yet connected."""
    drawn = F.struct(F.xxhash64("node", F.lit(turn)).alias("place"), "node", "root")
    centre = frames.stored(open_.groupBy("band").agg(F.min(drawn).alias("centre")), "centres")
    return (
        open_.join(centre, "band")
        .filter("root <> centre.root")
        .select("node", F.col("centre.node").alias("other"))
    )


def _open(bands: DataFrame, links: DataFrame) -> DataFrame:
    """(band, node, root, texts) of the bands whose texts are not all connected."""
    roots = frames.concluded(partial(components.connected, links), "roots")
    member = frames.stored(
        bands.join(roots, "node", "left").select(
            "band", "node", F.coalesce("root", "node").alias("root")
        ),
        "members",
    )
    mixed = (
        member.groupBy("band")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("texts"))
        .filter("low < high")
        .select("band", "texts")
    )
    # Stored, so that the join with it may split the texts of a frequent band.
    return frames.stored(member.join(frames.stored(mixed, "mixed-bands"), "band"), "open-bands")


def _blocked(open_: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(node, other): links that connect all similar texts of the same band.

    The texts of a band are dealt into blocks, and a task compares two blocks at a time.
    It returns only links between texts that it finds unconnected, one per text at most.
    """
    blocks = F.ceil(F.col("texts") / BLOCK_TEXTS)
    at = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("at")
    rows = open_.select(
        "band", "node", "root", F.pmod(F.xxhash64("node"), blocks).alias("own"), at
    ).select(
        F.xxhash64("band", F.least("own", "at"), F.greatest("own", "at")).alias("cell"),
        "node",
        "root",
        (F.col("own") <= F.col("at")).alias("is_low"),
        (F.col("own") >= F.col("at")).alias("is_high"),
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for part in parts:
            cell = part["cell"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                if first == last:
                    continue
                if held and held[0]["cell"][0].as_py() != cell[first]:
                    yield _linked(pa.Table.from_batches(held), least)
                    held = []
                held.append(part.slice(first, last - first))
        if held:
            yield _linked(pa.Table.from_batches(held), least)

    dealt = rows.join(sets, "node").select("cell", "node", "root", "is_low", "is_high", "shingles")
    dealt = dealt.repartition("cell").sortWithinPartitions("cell")
    return frames.stored(shipping.map_batches(dealt, batches, "node long, other long"), "block-links")


def _linked(rows: pa.Table, least: float) -> pa.RecordBatch:
    """Links of low texts with high ones, without those between connected texts."""
    node, root = rows["node"].to_numpy(), rows["root"].to_numpy()
    low, high = rows["is_low"].to_numpy(), rows["is_high"].to_numpy()
    column = rows["shingles"].combine_chunks()
    sizes = column.value_lengths().to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    kinds, place = np.unique(column.flatten().to_numpy(), return_inverse=True)
    _, first, which = np.unique(root, return_index=True, return_inverse=True)
    label = first[which]
    is_own = np.zeros(len(kinds), bool)
    found: list[tuple[int, int]] = []
    for k in np.flatnonzero(low):
        if not (high & (label != label[k])).any():
            continue
        own = place[ends[k] : ends[k + 1]]
        is_own[own] = True
        shared = np.diff(np.concatenate([[0], np.cumsum(is_own[place])])[ends])
        is_own[own] = False
        every = sizes[k] + sizes - shared
        alike = np.where(every == 0, 1.0, shared / np.maximum(every, 1))
        near = np.flatnonzero(high & (label != label[k]) & (alike >= least))
        near = near[np.unique(label[near], return_index=True)[1]]
        components.union(label, np.full(len(near), k), near)
        found += [(k, other) for other in near]
    at = np.array(found, np.int64).reshape(-1, 2)
    return pa.record_batch([pa.array(node[at[:, 0]]), pa.array(node[at[:, 1]])], ["node", "other"])


def classes(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """(row_key, doc_id, node, root) of each row: classes that similar texts connect.

    Signatures are cut into bands; texts with an equal band are candidates, and the
    Jaccard similarity of their shingle sets decides. First every text of a band is
    compared with one drawn from it, in large bands several times, so that a group of
    near copies makes as many pairs as it has texts. Of texts that are not connected then,
    all pairs of a band are compared: as rows in small bands, by blocks within tasks in
    large ones. So no link between different texts of a band is lost.
    """
    marked = frames.stored(banded(docs), "bands")
    member = marked.groupBy("node").agg(F.first("bands").alias("bands")).select(
        "node", F.explode("bands").alias("band")
    )
    shared = member.groupBy("band").agg(F.count("*").alias("texts")).filter("texts > 1")
    shared = frames.stored(shared.select("band"), "shared-bands")
    bands = frames.stored(_passing(marked, shared).distinct().join(shared, "band"), "banded-texts")
    wanted = marked.join(bands.select("node").distinct(), "node", "left_semi")
    wanted = frames.stored(wanted.groupBy("node").agg(F.min("row_key").alias("row_key")), "banded-rows")
    sets = frames.stored(_sets(docs, wanted), "shingle-sets")
    links = _verified(_centred(bands.withColumn("root", F.col("node")), 0), sets, least)
    open_ = _open(bands, links)
    for turn in range(1, TURNS):
        large = open_.filter(F.col("texts") > SMALL_BAND)
        if large.isEmpty():
            break
        more = _verified(_centred(large, turn), sets, least)
        if more.isEmpty():
            break
        links = links.unionByName(more)
        open_ = _open(bands, links)
    small = open_.filter(F.col("texts") <= SMALL_BAND)
    right = small.select("band", F.col("node").alias("other"), F.col("root").alias("other_root"))
    pairs = small.join(right, "band").filter("root < other_root").select("node", "other")
    links = links.unionByName(_verified(pairs, sets, least)).unionByName(
        _blocked(open_.filter(F.col("texts") > SMALL_BAND), sets, least)
    )
    roots = frames.concluded(partial(components.connected, links), "classes")
    return marked.join(roots, "node", "left").select(
        "row_key", "doc_id", "node", F.coalesce("root", "node").alias("root")
    )


def near_duplicates(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """(row_key, doc_id, node, class_id, class_rows) of each row, with ``classes`` named.

    ``node`` is a hash of the text, ``class_id`` is the smallest doc_id of the class, NULL if all of its ids are;
    ``class_rows`` counts its rows. NULL, empty and wordless texts are one class. An empty
    table gives no rows.
    """
    placed = classes(docs, least)
    ids = placed.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows")
    )
    return placed.join(frames.stored(ids, "class-ids"), "root").select(
        "row_key", "doc_id", "node", "class_id", "class_rows"
    )


def dedup(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each class: that with the smallest doc_id.

    Of rows with equal ids the one with the smallest row key stays; a NULL doc_id only
    where the class has no other.
    """
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    kept = classes(docs, least).groupBy("root").agg(F.min(rank)["row_key"].alias("row_key"))
    (own, nth) = frames.free(docs, "row_key", "nth_row")
    return frames.first_rows(docs, own, nth).join(
        kept.select(F.col("row_key").alias(own)), own, "left_semi"
    ).select(*docs.columns)
