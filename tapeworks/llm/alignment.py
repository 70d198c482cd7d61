"""Tokens of two tokenizers over the same bytes, aligned, with an identity-map fast path.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a SentencePiece model
that puts a space before a text. Of a text both encode a space and the text. Where a token
of A and one of B end at the same byte, a group ends; an A and a B token whose bytes overlap
are linked.

Most groups are one token on each side. For these an array gives the B id with the same
bytes for every A id: such links are counted in a vector as long as A's vocabulary, and only
the others, from irregular groups, go through the shuffle of pairs. Texts are cut before
spaces, where tokens of both sides always end, and each different piece is aligned once.
Documents are gathered into blocks; a block has a table of its pieces and one of its pairs,
so a pair is shuffled once per block and not once per document.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapeworks.llm import frames, shipping, token_files

#: Pieces of documents that a block holds, and different ones that a task remembers from one
#: block to the next: some 250 bytes each, in every Python worker of an executor.
BLOCK_PIECES, REMEMBERED = 400_000, 150_000
_TEXTS_AT_ONCE = 200
_B_SPACE = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_LOW = np.int64(0xFFFFFFFF)

_DOC = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_BLOCKS = (
    f"block long, doc_id {{kind}}, {_DOC}, pieces array<int>, "
    "link_ends array<int>, links array<int>, id_ends array<int>, ids array<int>, "
    "pairs array<long>, pair_links array<long>, own_ids array<int>, own_links array<long>"
)


class Side:
    """Ids of a string and the bytes behind every id."""

    def __init__(self, token_bytes: list[bytes]):
        self.bytes = token_bytes
        self.sizes = np.array([len(x) for x in token_bytes], np.int64)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class ByteLevel(Side):
    """A byte-level BPE file. Special tokens' strings in a text are plain text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        to_byte = {ord(c): b for b, c in token_files._alphabet().items()}
        known = {i: bytes(map(to_byte.__getitem__, map(ord, t))) for t, i in model["vocab"].items()
                 if all(ord(c) in to_byte for c in t)}
        super().__init__([known.get(k, b"") for k in range(max(known) + 1)])
        self._library: Tokenizer | None = None
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        places = [model["vocab"][a + b] for a, b in merges]
        before = parts.get("pre_tokenizer") or {}
        #: Merges in order of ids are what tiktoken does by ranks, without the wrappers.
        ranked = (
            places == sorted(places)
            and parts.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not model.get("ignore_merges")
        )
        specials = {x["id"] for x in parts["added_tokens"]}
        self._ranked = tiktoken.Encoding(
            "own",
            pat_str=token_files._WORDS.pattern,
            mergeable_ranks={known[i]: i for i in known if i not in specials},
            special_tokens={},
        ) if ranked else None
        if not ranked:
            self._library = Tokenizer.from_file(path)
            self._library.encode_special_tokens = True

    def encode(self, text: str) -> list[int]:
        if self._ranked:
            return self._ranked.encode_ordinary(text)
        return self._library.encode(text, add_special_tokens=False).ids


class Pieces(Side):
    """A SentencePiece model; the space that it adds stands for the text's first one."""

    def __init__(self, path: str):
        self._model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(k) for k in range(model.get_piece_size())]
        found = [_BYTE.fullmatch(name) for name in names]
        super().__init__(
            [
                bytes([int(byte[1], 16)]) if byte and model.is_byte(k) else name.replace(_B_SPACE, " ").encode()
                for k, (name, byte) in enumerate(zip(names, found, strict=True))
            ]
        )
        #: No piece goes on behind a space's mark, so a space after another character is
        #: where tokens end, and cut texts have the tokens of the whole one.
        self.cuts_at_spaces = not any(_B_SPACE in name.lstrip(_B_SPACE) for name in names)

    def encode(self, text: str) -> list[int]:
        return self._model.encode(text[1:])


def cut(text: str) -> list[str]:
    """A text in pieces that begin with a space; the first stands for text's beginning.

    Cut is before a space between a character other than a space and no white space.
    """
    parts = text.split(" ")
    pieces = [" " + parts[0]]
    for before, part in zip(parts, parts[1:], strict=False):
        if part and before and not part[0].isspace():
            pieces.append(" " + part)
        else:
            pieces[-1] += " " + part
    return pieces


class Aligner:
    """Aligned pieces, each done once as long as it is remembered."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        ids = {x: k for k, x in reversed(list(enumerate(self.b.bytes))) if x}
        #: For each A id the B id with the same bytes, or -1.
        self.same = np.array([ids.get(x, -1) for x in self.a.bytes], np.int64)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.told: list[bytes] = []
        self._parts: list[list[np.ndarray]] = [[] for _ in range(7)]

    def learn(self, texts: list[str]) -> list[np.ndarray]:
        """The pieces' numbers of each text; empty texts have none."""
        split = [(cut(x) if self.b.cuts_at_spaces else [" " + x]) if x else [] for x in texts]
        new = list(set(chain.from_iterable(split)).difference(self.number))
        plain = [x for x in new if x[-1] != " " and not x[1:2].isspace() and _B_SPACE not in x]
        # A run of pieces has the tokens of the pieces, for cuts are ends of tokens.
        if plain and self.b.cuts_at_spaces and not self._add(plain):
            plain = []
        for x in new if not self.b.cuts_at_spaces else set(new).difference(plain):
            if not self._add([x]):
                self._refuse(x)
        number = self.number.__getitem__
        return [np.fromiter(map(number, own), np.int32, len(own)) for own in split]

    def _refuse(self, piece: str) -> None:
        """A piece whose bytes are not what both sides say."""
        self.number[piece] = len(self.told)
        self.told.append(b"")
        none = np.zeros(0, np.int64)
        for part, value in zip(self._parts, ([-1], [-1], [0], [0], [0], none, none), strict=True):
            part.append(np.array(value, np.int64))

    def _add(self, pieces: list[str]) -> bool:
        text = "".join(pieces)
        given, a, b = text.encode("utf-8", "surrogatepass"), self.a.encode(text), self.b.encode(text)
        if self.a.joined(a) != given or self.b.joined(b) != given:
            return False
        sizes = np.fromiter((len(x.encode("utf-8", "surrogatepass")) for x in pieces), np.int64, len(pieces))
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        groups = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(groups, ends_a), np.searchsorted(groups, ends_b)
        in_a, in_b = np.bincount(of_a, minlength=len(groups)), np.bincount(of_b, minlength=len(groups))
        # Between two ends of either side lies exactly one pair of overlapping tokens.
        at = np.union1d(ends_a, ends_b)
        link_a, link_b = ids_a[np.searchsorted(ends_a, at)], ids_b[np.searchsorted(ends_b, at)]
        alone = ((in_a == 1) & (in_b == 1))[np.searchsorted(groups, at)]
        regular = alone & (self.same[link_a] == link_b)
        ends = np.cumsum(sizes)
        piece_of = np.searchsorted(ends, at)
        counts = lambda x: np.bincount(x, minlength=len(pieces))
        found = (
            counts(np.searchsorted(ends, ends_a)),
            counts(np.searchsorted(ends, ends_b)),
            counts(np.searchsorted(ends, groups)),
            counts(piece_of[regular]),
            counts(piece_of[~regular]),
            link_a[regular],
            (link_a[~regular] << 32) | link_b[~regular],
        )
        for part, value in zip(self._parts, found, strict=True):
            part.append(value)
        told = iter(self._groups(a, b, in_a.tolist(), in_b.tolist()))
        for piece, n in zip(pieces, found[2].tolist(), strict=True):
            self.number[piece] = len(self.told)
            self.told.append(";".join([next(told) for _ in range(n)]).encode())
        return True

    @staticmethod
    def _groups(a: list[int], b: list[int], in_a: list[int], in_b: list[int]) -> Iterator[str]:
        named_a, named_b = list(map(str, a)), list(map(str, b))
        i = j = 0
        for n, m in zip(in_a, in_b, strict=True):
            if n == m == 1:
                yield f"{named_a[i]}|{named_b[j]}"
            else:
                yield f"{','.join(named_a[i : i + n])}|{','.join(named_b[j : j + m])}"
            i, j = i + n, j + m

    def tables(self) -> list[np.ndarray]:
        """Per piece: tokens of A (-1: refused) and of B, groups, regular and other links;
        then the A ids of all regular links, and the pairs of the others."""
        self._parts = [[np.concatenate(x)] if x else [np.zeros(0, np.int64)] for x in self._parts]
        return [x[0] for x in self._parts]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per pair of files and Python worker."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _ranges(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(firsts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _lists(ends: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _first_only(values: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
    """``values`` in the first row, nothing in the others."""
    return _lists(np.array([0, *[len(values)] * rows]), values, kind)


def _block(number: int, doc_ids: pa.Array, own: list[np.ndarray], known: Aligner, schema: pa.Schema):
    """The rows of a block; the first one also carries its tables."""
    n_a, n_b, n_groups, n_ids, n_pairs, all_ids, all_pairs = known.tables()
    sizes = np.array([len(x) for x in own])
    flat = np.concatenate(own) if own else np.zeros(0, np.int32)
    doc = np.repeat(np.arange(len(own)), sizes)
    refused = np.bincount(doc[n_a[flat] < 0], minlength=len(own)) > 0
    told = known.told.__getitem__
    shas = [
        "" if bad or not len(x) else hashlib.sha256(b";".join(map(told, x.tolist()))).hexdigest()
        for x, bad in zip(own, refused.tolist(), strict=True)
    ]
    flat, doc = flat[~refused[doc]], doc[~refused[doc]]
    ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(own)))])
    sums = [
        np.diff(np.concatenate([[0], np.cumsum(x[flat])])[ends]) for x in (n_a, n_b, n_groups, n_ids + n_pairs)
    ]
    kinds, place = np.unique(flat, return_inverse=True)
    times = np.bincount(place, minlength=len(kinds))
    first_id, first_pair = np.cumsum(n_ids) - n_ids, np.cumsum(n_pairs) - n_pairs
    ids = all_ids[_ranges(first_id[kinds], n_ids[kinds])]
    pairs = all_pairs[_ranges(first_pair[kinds], n_pairs[kinds])]
    vector = np.bincount(ids, np.repeat(times, n_ids[kinds]), len(known.same)).astype(np.int64)
    seen = np.flatnonzero(vector)
    codes, which = np.unique(pairs, return_inverse=True)
    links = np.bincount(which, np.repeat(times, n_pairs[kinds]), len(codes)).astype(np.int64)
    rows = len(own)
    return pa.record_batch(
        [
            pa.array(np.full(rows, number), pa.int64()),
            doc_ids,
            *(pa.array(x, pa.int64()) for x in sums),
            pa.array(shas, pa.string()),
            _lists(ends, place, pa.int32()),
            _first_only(np.cumsum(n_pairs[kinds]), rows, pa.int32()),
            _first_only(which, rows, pa.int32()),
            _first_only(np.cumsum(n_ids[kinds]), rows, pa.int32()),
            _first_only(ids, rows, pa.int32()),
            _first_only(codes, rows, pa.int64()),
            _first_only(links, rows, pa.int64()),
            _first_only(seen, rows, pa.int32()),
            _first_only(vector[seen], rows, pa.int64()),
        ],
        schema=schema,
    )


def blocks(
    docs: DataFrame, path_a: str, path_b: str, block_pieces: int = BLOCK_PIECES, remembered: int = REMEMBERED
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), in blocks; the first row of a block
    carries the block's tables. To be stored, as the numbers of blocks are the tasks'."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        return _dealt(parts, aligner(path_a, path_b), number, block_pieces, remembered)

    return shipping.map_batches(docs.select("doc_id", "text"), batches, _BLOCKS.format(kind=kind))


def _dealt(
    parts: Iterator[pa.RecordBatch], known: Aligner, number: int, block_pieces: int, remembered: int
) -> Iterator[pa.RecordBatch]:
    """The blocks of a task, from ``number`` on. Workers outlive their tasks, so in the end
    nothing stays remembered."""
    ids, own, pieces, schema = [], [], 0, None
    known.forget()
    for part in parts:
        schema = schema or _arrow_schema(part["doc_id"].type)
        for first in range(0, part.num_rows, _TEXTS_AT_ONCE):
            some = part.slice(first, _TEXTS_AT_ONCE)
            found = known.learn([x or "" for x in some["text"].to_pylist()])
            # A copy, so that the ids do not keep their whole batch.
            ids.append(pa.array(some["doc_id"].to_pylist(), some["doc_id"].type))
            own += found
            pieces += sum(map(len, found))
            if pieces >= block_pieces:
                yield _block(number, pa.concat_arrays(ids), own, known, schema)
                number, ids, own, pieces = number + 1, [], [], 0
                if len(known.told) > remembered:
                    known.forget()
    if own:
        yield _block(number, pa.concat_arrays(ids), own, known, schema)
    known.forget()
    pa.default_memory_pool().release_unused()


def _arrow_schema(doc_id: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()),
             "array<long>": pa.list_(pa.int64()), "{kind}": doc_id}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in _BLOCKS.split(", "))])


def pair_counts(made: DataFrame, same: np.ndarray) -> DataFrame:
    """(pair, links, is_best) of the stored ``blocks``: a pair is A id * 2**32 + B id.

    ``is_best``: no other pair of its B id has more links. The counts of identity links are
    one number per A id.
    """
    spark = made.sparkSession
    zipped = F.explode(F.arrays_zip("pairs", "pair_links")).alias("x")
    irregular = made.select(zipped).select(F.col("x.pairs").alias("pair"), F.col("x.pair_links").alias("links"))
    own = F.explode(F.arrays_zip("own_ids", "own_links")).alias("x")
    # At most a row per id of A's vocabulary; as Arrow, for which no executor starts Python.
    vector = made.select(own).groupBy("x.own_ids").agg(F.sum("x.own_links").alias("links")).toArrow()
    ids = vector["own_ids"].to_numpy().astype(np.int64)
    regular = spark.createDataFrame(
        pa.table({"pair": pa.array((ids << 32) | same[ids], pa.int64()), "links": vector["links"]})
    )
    # Both sides of the join below read the same shuffle of sums.
    counted = irregular.unionByName(regular).groupBy("pair").agg(F.sum("links").alias("links"))
    b_id = F.col("pair").bitwiseAND(int(_LOW))
    best = counted.groupBy(b_id.alias("b_id")).agg(F.max("links").alias("best"))
    return counted.withColumn("b_id", b_id).join(best, "b_id").select(
        "pair", "links", (F.col("links") == F.col("best")).alias("is_best")
    )


def aligned(docs: DataFrame, path_a: str, path_b: str, **limits: int) -> DataFrame:
    """One row per row of ``docs`` with what its alignment holds.

    Columns: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is linked most
    often of all with its B id, in all documents, ties included), count_sum (over the links, how
    often their pair is linked in all documents) and groups_sha256, of the groups' ids as
    ``a1,a2|b1;a3|b2``. NULL and empty texts, and those whose bytes either side does not
    give back (a text with U+2581, say), have no tokens: zeros and an empty string. Equal rows
    are rows of their own; an empty table gives no rows. ``limits`` are those of ``blocks``.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    same = aligner(path_a, path_b).same
    made = frames.stored(blocks(docs, path_a, path_b, **limits), "aligned-blocks")
    counted = frames.stored(pair_counts(made, same), "pairs")
    links, best = np.zeros(len(same), np.int64), np.zeros(len(same), np.int64)
    own_ids = np.flatnonzero(same >= 0)
    regular = spark.createDataFrame(
        pa.table({"pair": (own_ids << 32) | same[own_ids], "a_id": own_ids.astype(np.int32)})
    )
    found = counted.join(regular, "pair").select("a_id", "links", "is_best").toArrow()  # at most a row per A id
    links[found["a_id"].to_numpy()] = found["links"].to_numpy()
    best[found["a_id"].to_numpy()] = found["is_best"].to_numpy()

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        return _summed(left, right, links, best)

    used = made.select(F.col("block").alias("own_block"), F.posexplode("pairs").alias("place", "pair"))
    back = used.join(counted, "pair").select("own_block", "place", "links", "is_best")
    narrow = made.select(
        "block", "doc_id", *(x.split()[0] for x in _DOC.split(", ")),
        "pieces", "link_ends", F.col("links").alias("link_places"), "id_ends", "ids",
    )
    shipping.ship(spark)
    return (
        narrow.groupBy("block")
        .cogroup(back.groupBy("own_block"))
        .applyInArrow(summed, f"doc_id {kind}, {_DOC}, n_best long, count_sum long")
    )


def _summed(docs: pa.Table, pairs: pa.Table, id_links: np.ndarray, id_best: np.ndarray) -> pa.Table:
    """The rows of one block, from the counts of its pairs and of all identity links."""
    docs, pairs = docs.combine_chunks(), pairs.combine_chunks()
    flat = lambda name: docs[name].combine_chunks().flatten().to_numpy().astype(np.int64)
    place = pairs["place"].to_numpy()
    result = []
    for ids, counts in (
        (id_best, pairs["is_best"].to_numpy(zero_copy_only=False)),
        (id_links, pairs["links"].to_numpy()),
    ):
        of_pair = np.zeros(len(place), np.int64)
        of_pair[place] = counts
        of_piece = _run_sums(of_pair[flat("link_places")], flat("link_ends"))
        of_piece = of_piece + _run_sums(ids[flat("ids")], flat("id_ends"))
        sizes = docs["pieces"].combine_chunks().value_lengths().to_numpy().astype(np.int64)
        result.append(pa.array(_run_sums(of_piece[flat("pieces")], np.cumsum(sizes))))
    kept = ["doc_id", *(x.split()[0] for x in _DOC.split(", "))]
    return pa.table([*(docs[c] for c in kept), *result], [*kept, "n_best", "count_sum"])


def _run_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the runs of ``values`` that end before ``ends``."""
    upto = np.concatenate([[0], np.cumsum(values)])
    return np.diff(upto[np.concatenate([[0], ends]).astype(np.int64)])
