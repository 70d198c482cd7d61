"""The trie of conversations that begin alike, by a skeleton of range splitters.

A conversation is a path: one step of 16 bytes for each turn, a digest of role and text.
Paths are cut into ranges by splitters, and a task gets one range in order of the paths.
A node, all conversations that begin with the same steps, is a run of that order. So a
node can only be spread over several ranges if it lies on the path of a splitter. The
splitters' own trie, the skeleton, is known to every task: a task finishes every other
node by itself, with the nodes open on a stack, and returns for nodes of the skeleton what
its range adds to them. Spark sums these parts, and one sweep over the skeleton, from its
tips to the root, completes them.

What a task holds are the open nodes of one path and the finished children of these.
The skeleton has at most ``SAMPLE`` paths of ``SPLITTER_TURNS`` steps, whatever the input.
Texts are digested where they are read and are not shuffled; a conversation is one row of
20 bytes a turn.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm import frames, shipping

#: Conversations share their beginning with the first one of so many, for at most
#: ``HEADS`` - 1 turns.
FAMILY, HEADS = 100, 6
STEP = 16
#: Paths drawn to choose splitters from, for each range and in all, and the steps of a
#: splitter; a longer one is cut.
DRAWN, SAMPLE, SPLITTER_TURNS = 40, 20_000, 256
_LOWEST = -(2**63)
_ROWS_AT_ONCE = 10_000
_NO_ENDS = hashlib.sha256().hexdigest()
_NODE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
_FINISHED, _PART, _END = 0, 1, 2
_PASS = (
    "kind int, skeleton long, parent_skeleton long, chars long, conv_id long, depth long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, steps) of each conversation: an array of (turn, step, chars) in order.

    Turns are in ascending order, NULL first; of turns with the same number the one with
    the smaller digest is first. NULL role or text counts as empty. Rows without a conv_id
    are one conversation without an id.
    """
    role, text = frames.whole_text("role"), frames.whole_text("text")
    told = F.concat_ws("", F.length(role).cast("string"), F.lit(":"), role, text)
    step = F.struct(
        F.col("turn"), F.md5(told.cast("binary")).alias("step"), F.length(text).alias("chars")
    )
    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), step.alias("step"))
    return own.groupBy("conv_id").agg(F.sort_array(F.collect_list("step")).alias("steps"))


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    own = F.crc32(conv_id.cast("string").cast("binary")) % HEADS
    return F.coalesce(own, F.lit(0)).cast("int")


def rebuilt(steps: DataFrame) -> DataFrame:
    """(conv_id, path, chars): paths that begin with the turns of the family's first one.

    Conversation c takes the first h turns of c - c % ``FAMILY``, all of them if these are
    fewer and none if there is no such conversation, and goes on with its own turns behind
    its first h. The remainder has the sign of c. A conversation without an id stays as it
    is; one without any turn left is a path without steps.
    """
    first = steps.select(
        F.col("conv_id").alias("first_id"), F.slice("steps", 1, HEADS - 1).alias("head")
    )
    h = shared_turns(F.col("conv_id"))
    none = F.slice("steps", 1, 0)
    own = steps.withColumn("first_id", F.col("conv_id") - F.col("conv_id") % FAMILY)
    joined = own.join(first, "first_id", "left").select(
        "conv_id",
        F.concat(
            F.slice(F.coalesce("head", none), F.lit(1), h),
            F.slice("steps", h + 1, F.greatest(F.size("steps") - h, F.lit(0))),
        ).alias("steps"),
    )
    return joined.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("steps", lambda s: s["step"]), "")).alias("path"),
        F.transform("steps", lambda s: s["chars"]).alias("chars"),
    )


class Skeleton:
    """The trie of the splitters' paths; node 0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.parents, self.depths = [-1], [0]
        known: dict[tuple[int, bytes], int] = {}
        self.of: list[list[int]] = []
        for path, _ in splitters:
            nodes = [0]
            for at in range(0, len(path), STEP):
                key = (nodes[-1], path[at : at + STEP])
                if key not in known:
                    known[key] = len(self.parents)
                    self.parents.append(key[0])
                    self.depths.append(len(nodes))
                nodes.append(known[key])
            self.of.append(nodes)

    def range_of(self, path: bytes, conv_id: int | None) -> int:
        return bisect_right(self.splitters, (path, _LOWEST if conv_id is None else conv_id))

    def around(self, number: int) -> list[tuple[bytes, list[int]]]:
        """The splitters at both ends of a range, with their nodes."""
        ends = (number - 1, number)
        return [(self.splitters[k][0], self.of[k]) for k in ends if 0 <= k < len(self.splitters)]


def skeleton(paths_: DataFrame, ranges: int) -> Skeleton:
    """Splitters that cut the paths into about equal ranges, from a drawn sample."""
    cut = F.length("path") > STEP * SPLITTER_TURNS
    drawn = (
        paths_.select(
            F.substring("path", 1, STEP * SPLITTER_TURNS).alias("path"),
            # A cut path stands for all that begin with it.
            F.when(~cut, F.col("conv_id")).alias("conv_id"),
            F.xxhash64("conv_id", "path").alias("draw"),
        )
        .orderBy("draw")
        .limit(min(SAMPLE, DRAWN * ranges))
        .select("path", "conv_id")
    )
    keys = sorted(
        (bytes(r["path"]), _LOWEST if r["conv_id"] is None else r["conv_id"])
        for r in drawn.collect()
    )
    chosen = {keys[k * len(keys) // ranges] for k in range(1, ranges)} if keys else set()
    return Skeleton(sorted(chosen))


def common_steps(a: bytes, b: bytes) -> int:
    most = min(len(a), len(b))
    at = 0
    while at < most and a[at : at + STEP] == b[at : at + STEP]:
        at += STEP
    return at // STEP


class _Open:
    """A node that may get more members."""

    __slots__ = ("chars", "children", "ends", "held", "least", "leaves", "members", "saved", "skeleton")

    def __init__(self, chars: int, skeleton: int | None):
        self.chars, self.skeleton = chars, skeleton
        self.least: int | None = None
        self.members = self.children = self.leaves = self.saved = 0
        self.ends = None
        self.held: list[list] = []  # finished children, which wait for this node's id

    def take(self, least: int | None, members: int) -> None:
        self.members += members
        if least is not None and (self.least is None or least < self.least):
            self.least = least


def finished(rows: Iterator[tuple[bytes, list[int], int | None]], around) -> Iterator[tuple]:
    """The rows of ``_PASS`` of one range, whose conversations come in order."""
    stack: list[_Open] = []
    before = b""

    def close() -> Iterator[tuple]:
        node = stack.pop()
        for row in node.held:
            yield (*row[:6], node.least, *row[6:])
        if stack:
            stack[-1].take(node.least, node.members)
        if node.skeleton is not None:
            yield (
                _PART, node.skeleton, None, node.chars, node.least, len(stack), None,
                node.members, node.children, node.leaves, node.saved, None,
            )
            return
        node.leaves = node.leaves or 1
        node.saved += (node.members - 1) * node.chars
        above = stack[-1]
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved
        ends = node.ends.hexdigest() if node.ends else _NO_ENDS
        row = [
            _FINISHED, None, above.skeleton, node.chars, node.least, len(stack),
            node.members, node.children, node.leaves, node.saved, ends,
        ]
        if above.skeleton is None:
            above.held.append(row)
        else:
            yield (*row[:6], None, *row[6:])

    for path, chars, conv_id in rows:
        shared = common_steps(before, path) if stack else -1
        while len(stack) > shared + 1:
            yield from close()
        if len(stack) <= len(chars):
            near = [(common_steps(path, other), nodes) for other, nodes in around]
            for depth in range(len(stack), len(chars) + 1):
                own = next((nodes[depth] for steps, nodes in near if depth <= steps), None)
                stack.append(_Open(chars[depth - 1] if depth else 0, own if depth else 0))
        top = stack[-1]
        top.take(conv_id, 1)
        if top.skeleton is not None:
            yield (_END, top.skeleton, None, None, conv_id, *[None] * 7)
        elif conv_id is not None:
            if top.ends is None:
                top.ends = hashlib.sha256(str(conv_id).encode())
            else:
                top.ends.update(b",%d" % conv_id)
        before = path
    while stack:
        yield from close()


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS_AT_ONCE:
            yield pa.record_batch(list(map(list, zip(*held, strict=True))), schema=schema)
            held = []
    if held:
        yield pa.record_batch(list(map(list, zip(*held, strict=True))), schema=schema)


def _schema(text: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in text.split(", "))])


def trie(paths_: DataFrame) -> DataFrame:
    """One row for each node of the paths (conv_id, path, chars).

    Columns: conv_id, the smallest member; depth; parent_conv_id, that of the parent, NULL
    for the root; n_convs, the members; n_children; n_leaves, the childless nodes below or
    at the node; saved_tokens, over the same nodes the sum of (n_convs - 1) times the code
    points of the last text; ends_sha256, of the ids of the members that end at the node,
    in ascending order with commas between. A member without an id is counted and has no
    place in ids. ``paths_`` is read twice, so it should be stored. Without paths there is
    no node.
    """
    spark = paths_.sparkSession
    ranges = frames.tasks(paths_)
    known = skeleton(paths_, ranges)
    dealt = (
        shipping.map_batches(paths_, _placing(known), "conv_id long, path binary, chars array<int>, part int")
        .repartitionById(ranges, "part")
        .sortWithinPartitions("part", "path", "conv_id")
    )
    made = frames.stored(shipping.map_batches(dealt, _finishing(known), _PASS), "trie-nodes")
    tips = _completed(spark, made, known)
    ids = tips.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("above"))
    # Bounded by the skeleton.
    own = made.filter(F.col("kind") == _FINISHED).join(F.broadcast(ids), "parent_skeleton", "left")
    above = F.when(F.col("parent_skeleton").isNotNull(), F.col("above")).otherwise(F.col("parent_conv_id"))
    return own.withColumn("parent_conv_id", above).select(*_NODE).unionByName(tips.select(*_NODE))


def _placing(known: Skeleton):
    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys = zip(part["path"].to_pylist(), part["conv_id"].to_pylist(), strict=True)
            ranges = pa.array([known.range_of(*key) for key in keys], pa.int32())
            yield pa.record_batch(
                [part["conv_id"], part["path"], part["chars"], ranges], ["conv_id", "path", "chars", "part"]
            )

    return place


def _finishing(known: Skeleton):
    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        for part in parts:
            for first in range(0, part.num_rows, _ROWS_AT_ONCE):
                some = part.slice(first, _ROWS_AT_ONCE)
                columns = (some[c].to_pylist() for c in ("path", "chars", "conv_id"))
                yield from zip(some["part"].to_pylist(), zip(*columns, strict=True), strict=True)

    def nodes(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        given = rows(parts)
        held = next(given, None)
        while held is not None:
            number = held[0]

            def same() -> Iterator[tuple]:
                nonlocal held
                while held is not None and held[0] == number:
                    yield held[1]
                    held = next(given, None)

            yield from finished(same(), known.around(number))

    def finish(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(nodes(parts), _schema(_PASS))

    return finish


def _completed(spark: SparkSession, made: DataFrame, known: Skeleton) -> DataFrame:
    """The nodes of the skeleton: parts summed by Spark, then swept from the tips up."""
    sums = (
        made.filter(F.col("kind") == _PART)
        .groupBy("skeleton")
        .agg(
            F.min("conv_id").alias("conv_id"),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
            F.max("chars").alias("chars"),
        )
    )
    nodes = {r["skeleton"]: r.asDict() for r in sums.collect()}
    for k in sorted(nodes, reverse=True):  # a parent's number is below its children's
        node = nodes[k]
        node["n_leaves"] = node["n_leaves"] or 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["chars"]
        if k:
            above = nodes[known.parents[k]]
            above["n_children"] += 1
            above["n_leaves"] += node["n_leaves"]
            above["saved_tokens"] += node["saved_tokens"]
    rows = [
        (
            k, n["conv_id"], known.depths[k], nodes[known.parents[k]]["conv_id"] if k else None,
            n["n_convs"], n["n_children"], n["n_leaves"], n["saved_tokens"],
        )
        for k, n in nodes.items()
    ]
    schema = "skeleton long, " + ", ".join(f"{c} long" for c in _NODE[:-1])
    ends = made.filter(F.col("kind") == _END).select("skeleton", "conv_id")
    return (
        spark.createDataFrame(rows, schema)
        .join(_ends(ends), "skeleton", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    )


def _ends(ends: DataFrame) -> DataFrame:
    """(skeleton, ends_sha256): a digest is one sequence, so its ids stream through a task."""

    def digests(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, digest = None, None
        for part in parts:
            for node, conv_id in zip(part["skeleton"].to_pylist(), part["conv_id"].to_pylist(), strict=True):
                if node != at:
                    if digest:
                        yield at, digest.hexdigest()
                    at, digest = node, None
                if conv_id is None:
                    continue
                if digest is None:
                    digest = hashlib.sha256(str(conv_id).encode())
                else:
                    digest.update(b",%d" % conv_id)
        if digest:
            yield at, digest.hexdigest()

    schema = "skeleton long, ends_sha256 string"
    dealt = ends.repartition("skeleton").sortWithinPartitions("skeleton", "conv_id")
    return shipping.map_batches(dealt, lambda parts: _batches(digests(parts), _schema(schema)), schema)


def plan(turns: DataFrame) -> DataFrame:
    """The trie of the ``rebuilt`` conversations of ``turns``."""
    return trie(frames.stored(rebuilt(paths(turns)), "paths"))
