"""Token ids of documents in files of grammars, by Re-Pair.

Documents are tokenised in ascending order of doc_id and gathered into shards of about
``SHARD_IDS`` ids. In each shard frequent pairs of neighbouring ids are replaced by new
symbols, again and again, never across the end of a document. A file holds, for each
shard, the rules, the number of ids every rule expands to, the remaining symbols and
where each document begins among them; so one document, or a range of its ids, is decoded
without the others.

The container is Parquet, one row per shard, written by the tasks that made the shards.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapeworks.llm import frames, shipping, texts

#: Ids of a shard; the document at the end is whole, so a shard may have more.
SHARD_IDS = 1 << 20
#: A pair is replaced if it occurs as often at least; rules and rounds are bounded so
#: that symbols fit in 16 bits and the work is in proportion to the ids.
LEAST_COUNT = 16
RULES = 15_000
ROUNDS = 6
RULES_A_ROUND = 4_000
END_ID = 2
#: Bytes of texts whose pieces are told apart at a time, and rows handed over for that.
_BYTES_AT_ONCE = 8 << 20
_TEXTS_AT_ONCE = 2_500
_COUNT_BITS = 18
_SPREAD = np.uint64(0x9E3779B97F4A7C15)

_FILE = (
    "part long, number long, doc_ids array<{kind}>, begins binary, n_ids long, vocabulary long, "
    "rules binary, expansions binary, symbol_bytes int, symbols binary"
)


# How byte-level tokenizers cut a text into words, and the bytes that stand
# for themselves in their alphabet; the others are numbered from 256 on.
_WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_THEMSELVES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
# White space: bytes of ASCII, and the others as numbers of their two or three bytes.
_NO_SPACE = np.array([not chr(b).isspace() or b > 127 for b in range(256)])
_ODD = [chr(c).encode() for c in range(128, 1 << 16) if chr(c).isspace()]
_ODD_SPACES = np.array([int.from_bytes(x) for x in _ODD])
_ODD_LEAD = np.isin(np.arange(256), [x[0] for x in _ODD])


def _alphabet() -> dict[int, str]:
    others = [b for b in range(256) if b not in _THEMSELVES]
    return {b: chr(b) for b in _THEMSELVES} | {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    """Ids of texts from a tokenizer file.

    Byte-level tokenizers begin a word at every space before a character that is no white
    space. Texts are cut there. The different pieces of some texts, told apart by Arrow, are
    cut into the tokenizer's words, and the tokenizer's model encodes the different words in
    one call. Nothing is remembered from these texts to the next. Other tokenizers encode
    whole texts.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # The model alone, for what is cut into words already.
        self.words_only = Tokenizer(self.tokenizer.model)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.letters = np.array([ord(letter) for _, letter in sorted(_alphabet().items())], "<u2")
        parts = json.loads(self.tokenizer.to_str())
        before, model = parts.get("pre_tokenizer") or {}, parts["model"]
        own = self.tokenizer.get_vocab(with_added_tokens=False)
        self.special = [x["content"] for x in parts["added_tokens"]]
        self.by_pieces = (
            parts.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(
                " " in x["content"] or x["lstrip"] or x["rstrip"] or x["single_word"]
                for x in parts["added_tokens"]
            )
            # The bytes of a word's ids are those of the word, so they tell where it ends.
            and model.get("type") == "BPE"
            and not model.get("continuing_subword_prefix")
            and not model.get("end_of_word_suffix")
            and own.keys() >= set(_alphabet().values())
        )
        self.bytes_of = np.zeros(max(own.values(), default=0) + 1, np.int64)
        self.bytes_of[list(own.values())] = [len(token) for token in own]

    def encode(self, column: pa.Array | list[str]) -> list[np.ndarray]:
        if not isinstance(column, pa.Array):
            column = pa.array(column, pa.string())
        if not self.by_pieces:
            return self._whole(column)
        special = np.zeros(len(column), bool)
        for content in self.special:
            special |= pc.match_substring(column, content).to_numpy(zero_copy_only=False)
        if not special.any():
            return self._cut(column)
        whole = iter(self._whole(column.filter(pa.array(special))))
        others = iter(self._cut(column.filter(pa.array(~special))))
        return [next(whole if one else others) for one in special]

    def _whole(self, column: pa.Array) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch(column.to_pylist(), add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _cut(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of texts without special tokens, some texts at a time."""
        result: list[np.ndarray] = []
        for _, data, offsets in texts.slices(column, _BYTES_AT_ONCE):
            begins, before = pieces(data, offsets)
            if not len(begins):
                result += [np.zeros(0, np.uint32)] * (len(offsets) - 1)
                continue
            told = _strings(data, np.append(begins, len(data))).dictionary_encode()
            codes = told.indices.to_numpy()
            at_start = np.zeros(len(told.dictionary), bool)
            at_start[codes[before[:-1][np.diff(before) > 0]]] = True
            ids, ends = _gathered(*self._pieces(told.dictionary, at_start), codes)
            result += [ids[a:b] for a, b in pairwise(ends[before].tolist())]
        return result

    def _pieces(self, different: pa.Array, at_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and where those of each piece begin, and the end.

        Pieces that are found behind others are cut into words in one string, where a space
        before no white space is behind each of them, as in the texts. Those that are found
        at the start of a text are cut one by one.
        """
        starting, inner = (different.filter(pa.array(some)) for some in (at_start, ~at_start))
        ordered = pa.concat_arrays([starting, inner])
        piece_ends = np.cumsum(pc.binary_length(ordered).to_numpy())
        data = np.frombuffer(ordered.buffers()[2], np.uint8, piece_ends[-1])
        words = [word for piece in starting.to_pylist() for word in _WORDS.findall(piece)]
        words += _WORDS.findall(data[piece_ends[len(starting) - 1] :].tobytes().decode())
        # The first bytes of characters, and the end, lead from characters to bytes.
        byte_of = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        word_ends = byte_of[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
        told = _strings(data, np.append(0, word_ends)).dictionary_encode()
        ids, ends = _gathered(*self._words(told.dictionary), told.indices.to_numpy())
        cuts = ends[np.append(0, np.searchsorted(word_ends, piece_ends) + 1)]
        place = np.argsort(np.argsort(~at_start, kind="stable"))
        return _gathered(ids, cuts, place)

    def _words(self, different: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and where those of each word begin, and the end."""
        cuts = np.append(0, np.cumsum(pc.binary_length(different).to_numpy()))
        data = np.frombuffer(different.buffers()[2], np.uint8, cuts[-1])
        spelled = self.letters[data].tobytes().decode("utf-16-le")
        words = [spelled[a:b] for a, b in pairwise(cuts.tolist())]
        found = self.words_only.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found[0].ids, np.uint32)
        ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), cuts[1:]) + 1
        return ids, np.append(0, ends)


def _strings(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The strings between ``cuts`` of ``data``, without a copy."""
    buffers = [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.string(), len(cuts) - 1, buffers)


def _gathered(ids: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids between ``ends[code]`` and ``ends[code + 1]`` of all codes, and their own ends."""
    own = np.diff(ends)[codes]
    made = np.concatenate([[0], np.cumsum(own)])
    kind = np.int32 if max(made[-1], len(ids)) < 1 << 31 else np.int64
    shift = (ends[codes] - made[:-1]).astype(kind)
    return ids[np.repeat(shift, own) + np.arange(made[-1], dtype=kind)], made


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces of texts begin, and how many of them are before each text and the end.

    A piece begins with a text and at each space in it that no white space follows.
    """
    spaces = np.flatnonzero(data[:-1] == 0x20)
    cut = _NO_SPACE[data[spaces + 1]]
    odd = np.flatnonzero(_ODD_LEAD[data[spaces + 1]])
    three = [data.take(spaces[odd] + k, mode="clip").astype(np.int32) for k in (1, 2, 3)]
    two = three[0] << 8 | three[1]
    cut[odd] = ~(np.isin(two, _ODD_SPACES) | np.isin(two << 8 | three[2], _ODD_SPACES))
    starts = np.zeros(len(data) + 1, bool)
    starts[spaces[cut]] = True
    starts[offsets[1:] - 1] = False  # another text follows
    starts[offsets[:-1]] = True
    starts[-1] = False
    begins = np.flatnonzero(starts)
    return begins, np.searchsorted(begins, offsets)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per file and Python worker, so that the file is read once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


@dataclass
class Grammar:
    """Rule k stands for the symbols rules[k] and is itself the symbol vocabulary + k."""

    vocabulary: int
    rules: np.ndarray  # two columns
    expansions: np.ndarray  # ids that each rule expands to
    symbols: np.ndarray
    begins: np.ndarray  # first symbol of each document, and the end
    _ids: np.ndarray | None = None
    _starts: np.ndarray | None = None
    _sizes: np.ndarray | None = None
    _firsts: np.ndarray | None = None

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that each of ``symbols`` expands to."""
        sizes = np.ones(len(symbols), np.int64)
        rule = symbols >= self.vocabulary
        sizes[rule] = self.expansions[symbols[rule] - self.vocabulary]
        return sizes

    def expanded(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of ``symbols``; those of every rule are laid out once, in order of rules."""
        if self._ids is None:
            self._lay_out()
        sizes, first = self._sizes[symbols], self._firsts[symbols]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if total < 1 << 31 else np.int64
        shift = (first - (ends - sizes)).astype(kind)
        return self._ids[np.repeat(shift, sizes) + np.arange(total, dtype=kind)]

    def _lay_out(self) -> None:
        # One-id symbols first, so that ids and rules are read from the same array.
        self._starts = np.cumsum(self.expansions) - self.expansions
        own = np.arange(self.vocabulary)
        self._sizes = np.concatenate([np.ones_like(own), self.expansions])
        self._firsts = np.concatenate([own, self.vocabulary + self._starts])
        ids = np.empty(self.vocabulary + int(self.expansions.sum()), np.int64)
        ids[: self.vocabulary] = np.arange(self.vocabulary)
        for k, (left, right) in enumerate(self.rules.tolist()):
            at = self.vocabulary + self._starts[k]
            for part in (left, right):
                if part < self.vocabulary:
                    ids[at] = part
                    at += 1
                else:
                    from_ = self.vocabulary + self._starts[part - self.vocabulary]
                    size = self.expansions[part - self.vocabulary]
                    ids[at : at + size] = ids[from_ : from_ + size]
                    at += size
        self._ids = ids

    def document(self, number: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of a document: only symbols that reach there expand."""
        own = self.symbols[self.begins[number] : self.begins[number + 1]].astype(np.int64)
        ends = np.cumsum(self.lengths(own))
        total = int(ends[-1]) if len(ends) else 0
        stop = total if stop is None else min(stop, total)
        if start >= stop:
            return np.zeros(0, np.int64)
        first, last = np.searchsorted(ends, [start, stop - 1], "right")
        skipped = int(ends[first - 1]) if first else 0
        return self.expanded(own[first : last + 1])[start - skipped : stop - skipped]


def compress(ids: np.ndarray, begins: np.ndarray, vocabulary: int) -> Grammar:
    """Re-Pair: each round replaces the most frequent pairs by rules."""
    symbols = ids.astype(np.uint32)
    begins = begins.astype(np.int64)
    rules: list[np.ndarray] = []
    expansions = np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        made = len(expansions)
        pairs, symbols, begins = _round(
            symbols, begins, min(RULES_A_ROUND, RULES - made), vocabulary + made
        )
        if not len(pairs):
            break
        rules.append(pairs)
        sizes = np.concatenate([np.ones(vocabulary, np.int64), expansions])
        expansions = np.concatenate([expansions, sizes[pairs].sum(axis=1)])
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return Grammar(vocabulary, table, expansions, symbols, begins)


def _round(
    symbols: np.ndarray, begins: np.ndarray, most: int, first: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs, and what is left when symbols from ``first`` on stand for them.

    Pairs are told apart by the slots of a hash, without sorting them. A slot stands for one
    of its pairs; another that falls into it may be replaced in a later round.
    """
    none = np.zeros((0, 2), np.int64), symbols, begins
    if most <= 0 or len(symbols) < 2:
        return none
    # Both symbols in one number, as narrow as they allow.
    wide = first + most > 1 << 16
    half = np.uint64(32) if wide else np.uint32(16)
    codes = symbols[:-1].astype(half.dtype) << half | symbols[1:]
    spread, bits = (_SPREAD, 64) if wide else (np.uint32(_SPREAD >> np.uint64(32)), 32)
    slots = ((codes * spread) >> half.dtype.type(bits - _COUNT_BITS)).astype(np.int32)
    cuts = begins[(begins > 0) & (begins < len(symbols))] - 1
    slots[cuts] = 1 << _COUNT_BITS  # a pair across the end of a document counts nowhere
    # Any one pair of each slot, and how often that pair occurs.
    held = np.zeros(1 + (1 << _COUNT_BITS), codes.dtype)
    held[slots] = codes
    own = held[slots] == codes
    own[cuts] = False
    counts = np.bincount(slots[own], minlength=len(held))
    best = np.flatnonzero(counts >= LEAST_COUNT)
    best = best[np.argsort(-counts[best], kind="stable")[:most]]
    if not len(best):
        return none
    chosen = held[best]
    rule_of = np.full(len(held), -1, np.int32)
    rule_of[best] = np.arange(len(best))
    rule = rule_of[slots]
    at = np.flatnonzero((rule >= 0) & own)
    # Of overlapping occurrences every second one, from the first of the run.
    run = np.flatnonzero(np.diff(at, prepend=-2) != 1).astype(np.int32)
    place = np.arange(len(at), dtype=np.int32) - np.repeat(run, np.diff(run, append=len(at)))
    at = at[(place & 1) == 0]
    left = symbols.copy()
    left[at] = rule[at] + np.uint32(first)
    kept = np.ones(len(symbols), bool)
    kept[at + 1] = False
    left_of, right_of = chosen >> half, chosen & ((half.dtype.type(1) << half) - half.dtype.type(1))
    pairs = np.stack([left_of, right_of], axis=1).astype(np.int64)
    return pairs, left[kept], begins - np.searchsorted(at + 1, begins)


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Write the ids of ``docs``, each with ``end_id`` behind it, to files below ``path``.

    NULL and empty texts are the end id alone. Rows without a doc_id come first; rows with
    the same one in order of a hash of the text. An empty table gives no shards.
    """
    ranges = frames.tasks(docs)
    text = frames.whole_text()
    ordered = (
        docs.select("doc_id", text.alias("text"))
        .repartitionByRange(ranges, "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part_id, number = TaskContext.get().partitionId(), 0
        names: list = []
        ids: list[np.ndarray] = []
        held = 0
        for part in parts:
            for first in range(0, part.num_rows, _TEXTS_AT_ONCE):
                some = part.slice(first, _TEXTS_AT_ONCE)
                found = encode.encode(some["text"])
                for name, own in zip(some["doc_id"].to_pylist(), found, strict=True):
                    names.append(name)
                    ids.append(own)
                    held += len(own) + 1
                    if held >= SHARD_IDS:
                        yield _shard(part_id, number, names, ids, end_id, encode.vocabulary, some.schema)
                        names, ids, held, number = [], [], 0, number + 1
        if names:
            yield _shard(part_id, number, names, ids, end_id, encode.vocabulary, some.schema)

    shipping.map_batches(ordered, batches, _FILE.format(kind=kind)).write.parquet(path)


def _shard(part_id, number, names, ids, end_id, vocabulary, schema) -> pa.RecordBatch:
    ends = np.cumsum([len(x) + 1 for x in ids], dtype=np.int64)
    all_ids = np.empty(int(ends[-1]), np.int64)
    all_ids[ends - 1] = end_id
    inner = np.ones(len(all_ids), bool)
    inner[ends - 1] = False
    all_ids[inner] = np.concatenate(ids)
    grammar = compress(all_ids, np.concatenate([[0], ends]), vocabulary)
    wide = len(grammar.symbols) and int(grammar.symbols.max()) >= 1 << 16
    symbols = grammar.symbols.astype("<u4" if wide else "<u2")
    columns = {
        "part": [part_id],
        "number": [number],
        "doc_ids": pa.array([names], pa.list_(schema.field("doc_id").type)),
        "begins": [grammar.begins.astype("<i8").tobytes()],
        "n_ids": [len(all_ids)],
        "vocabulary": [vocabulary],
        "rules": [grammar.rules.astype("<u4").tobytes()],
        "expansions": [grammar.expansions.astype("<i8").tobytes()],
        "symbol_bytes": pa.array([symbols.itemsize], pa.int32()),
        "symbols": [symbols.tobytes()],
    }
    return pa.record_batch(columns)


def shard(row: dict) -> Grammar:
    """The grammar of a row of the files."""
    return Grammar(
        row["vocabulary"],
        np.frombuffer(row["rules"], "<u4").reshape(-1, 2).astype(np.int64),
        np.frombuffer(row["expansions"], "<i8"),
        np.frombuffer(row["symbols"], f"<u{row['symbol_bytes']}"),
        np.frombuffer(row["begins"], "<i8"),
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files' ids.

    ``start`` counts the ids of all documents before it. Shards are numbered by the ranges
    of doc_ids they come from; their totals, one row each, are summed in that order.
    """
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "number", "n_ids").select(
        "part", "number", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before")
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in range(part.num_rows):
                one = part.slice(row, 1)
                held = one.drop_columns(["doc_ids"]).to_pylist()[0]
                grammar = shard(held)
                symbols = grammar.symbols.astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(grammar.lengths(symbols))])[grammar.begins]
                ids = grammar.expanded(symbols).astype("<u4")
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                count = len(sums)
                yield pa.record_batch(
                    [
                        pa.array([held["part"]] * count, pa.int64()),
                        pa.array([held["number"]] * count, pa.int64()),
                        pc.list_flatten(one["doc_ids"]),
                        pa.array(ends[:-1]),
                        pa.array(np.diff(ends)),
                        pa.array(sums, pa.int64()),
                    ],
                    ["part", "number", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    decoded = shipping.map_batches(
        files,
        batches,
        f"part long, number long, doc_id {kind}, within long, n_tokens long, ids_crc32 long",
    )
    return decoded.join(starts, ["part", "number"]).select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
