"""The prefix trie, the alignment of two tokenizers and the Jaccard join."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapeworks import session, storage
from tapeworks.llm import alignment, frames, jaccard_join, prefix_trie
from tests.llm import helpers

TURN = "conv_id long, turn long, role string, text string"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- trie -------------------------------------------------------------------


def plain_trie(turns):
    own = defaultdict(list)
    for conv_id, turn, role, text in turns:
        digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
        own[conv_id].append(((turn is not None, turn or 0, digest), (role or "", text or "")))
    own = {c: [step for _, step in sorted(v)] for c, v in own.items()}
    full = {}
    for c, steps in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        first = None if c is None else c - int(np.fmod(c, 100))
        full[c] = (own.get(first, [])[:h] if c is not None else []) + steps[h:]
    members = defaultdict(list)
    for c, steps in full.items():
        for k in range(len(steps) + 1):
            members[tuple(steps[:k])].append(c)
    children, leaves, saved = Counter(n[:-1] for n in members if n), Counter(), Counter()
    for n, m in members.items():
        for k in range(len(n) + 1):
            saved[n[:k]] += (len(m) - 1) * len(n[-1][1]) if n else 0
            leaves[n[:k]] += n not in children
    least = lambda m: min((c for c in m if c is not None), default=None)
    found = []
    for n, m in members.items():
        ends = sorted(c for c in m if c is not None and len(full[c]) == len(n))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        above = least(members[n[:-1]]) if n else None
        found.append((least(m), len(n), above, len(m), children[n], leaves[n], saved[n], sha))
    return sorted(found, key=repr)


def conversations():
    rnd = random.Random(4)
    turns = []
    for c in [*range(0, 260), 5000, -7, 100_000]:
        for k in range(rnd.choice([0, 1, 2, 3, 8, 8])):
            turns.append((c, k, rnd.choice(["user", "assistant"]), rnd.choice(["a", "bb", "", "ccc"])))
    turns += [(400, k, "user", f"long {k}") for k in range(300)]
    turns += [(500 + c, k, "user", "same") for c in range(40) for k in range(7)]  # equal ones
    turns += [
        (None, 1, "user", "x"), (None, None, None, None), (901, None, "user", "first"), (901, 0, "user", None),
        (902, 0, "user", "tie"), (902, 0, "user", "tie 2"), (902, 0, "user", "tie"), (903, 0, None, "r"),
        (904, 0, "ab", "c"), (905, 0, "a", "bc"), (906, 0, "user", helpers.LONG),
    ]
    return turns


@pytest.mark.parametrize("ranges", ["1", "4", "50"])
def test_trie_equals_the_plain_one(spark, ranges):
    turns = conversations()
    frame = spark.createDataFrame(turns, TURN).withColumn("path", F.lit(1)).withColumn("steps", F.lit(2))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        found = prefix_trie.plan(frame).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, found), key=repr) == plain_trie(turns)


def test_no_conversation_has_no_node(spark):
    assert prefix_trie.plan(spark.createDataFrame([], TURN)).count() == 0


def test_skeleton_knows_the_nodes_of_its_splitters():
    a, b = b"a" * 16, b"b" * 16
    known = prefix_trie.Skeleton([(a, 1), (a + b, 5), (b, 0)])
    assert known.parents == [-1, 0, 1, 0] and known.of == [[0, 1], [0, 1, 2], [0, 3]]
    assert [known.range_of(*key) for key in ((b"", 9), (a, 0), (a, 1), (a + b, 5), (b, None), (b, 0))] == [0, 0, 1, 2, 2, 3]


# --- alignment --------------------------------------------------------------


def plain_alignment(docs):
    side_a, side_b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    side_a.encode_special_tokens = True
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}

    def piece(i):
        name = side_b.id_to_piece(i)
        byte = re.fullmatch("<0x(..)>", name)
        return bytes([int(byte[1], 16)]) if byte else name.replace("▁", " ").encode()

    counts, known = Counter(), []
    for doc_id, text in docs:
        ids_a = side_a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = side_b.encode(text) if text else []
        own_a = [bytes(letters[c] for c in side_a.id_to_token(i)) for i in ids_a]
        own_b = [piece(i) for i in ids_b]
        if not text or not b"".join(own_a) == b"".join(own_b) == (" " + text).encode():
            known.append((doc_id, [], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in own_a]), np.cumsum([len(x) for x in own_b])
        links = [
            (ids_a[i], ids_b[j])
            for i in range(len(ids_a))
            for j in range(np.searchsorted(ends_b, ends_a[i] - len(own_a[i]), "right"), len(ids_b))
            if ends_b[j] - len(own_b[j]) < ends_a[i]
        ] if len(ids_a) < 3000 else None
        groups, both = [], sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        i = j = 0
        for end in both:
            k, m = np.searchsorted(ends_a, end) + 1, np.searchsorted(ends_b, end) + 1
            groups.append(f"{','.join(map(str, ids_a[i:k]))}|{','.join(map(str, ids_b[j:m]))}")
            i, j = k, m
        assert links is not None
        counts.update(links)
        known.append((doc_id, ids_a, ids_b, groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    found = []
    for doc_id, ids_a, ids_b, groups, links in known:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        found.append(
            (
                doc_id, len(ids_a), len(ids_b), len(groups), len(links), sha,
                sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
            )
        )
    return sorted(found, key=repr)


@pytest.mark.parametrize("limits", [{}, {"block_pieces": 40, "remembered": 60}])
def test_alignment_equals_the_plain_one(spark, sf_dir, limits):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("length(text) < 4000")
    odd = [
        (-1, None), (-2, ""), (-3, " "), (-4, "a  b   c \n d  "), (-5, "x▁y z"), (-6, "<|endoftext|> hi </s> <s>"),
        (-7, "  lead"), (-8, "aaaa" * 500), (-9, "あい \U0001F600 \x00 a\tb\r\n c"), (-10, "a b   c \x1c d"),
        (-11, "one two"), (-11, "one two"), (None, "one two"), (-12, "\n\n x"), (-13, "a \x85b   c"),
    ]
    docs = given.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    clashing = docs.withColumn("block", F.lit(1)).withColumn("pairs", F.lit("x")).withColumn("links", F.lit(0))
    found = alignment.aligned(clashing, A, B, **limits).collect()
    assert sorted(map(tuple, found), key=repr) == plain_alignment([tuple(r) for r in docs.collect()])
    assert alignment.aligned(docs.limit(0), A, B).count() == 0


def test_a_task_leaves_no_pieces_in_its_worker():
    known = alignment.Aligner(A, B)
    texts = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(900)]
    parts = [pa.record_batch([pa.array(range(900)), pa.array(texts)], ["doc_id", "text"])]
    most = [len(known.told) for _ in alignment._dealt(iter(parts), known, 0, 5_000, 1_000)]
    assert len(most) > 2 and max(most) <= 6_000
    assert not known.told and not known.number
    assert alignment.REMEMBERED < alignment.BLOCK_PIECES


def test_pairs_are_counted_without_python_tasks_or_a_stored_step(spark, monkeypatch):
    texts = [(k, f"word{k % 7} ünï{k % 3} odd\u00adness {k}") for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    made = frames.stored(alignment.blocks(docs, A, B, 40, 60), "blocks")
    monkeypatch.setattr(frames, "stored", None)
    found = alignment.pair_counts(made, alignment.aligner(A, B).same)
    rows, best = found.collect(), Counter()
    assert sum(r["links"] for r in rows) == sum(x[4] for x in plain_alignment(texts))
    for pair, links, _ in rows:
        best[pair & 0xFFFFFFFF] = max(best[pair & 0xFFFFFFFF], links)
    assert all(is_best == (links == best[pair & 0xFFFFFFFF]) for pair, links, is_best in rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "ReusedExchange" in plan


def test_cut_pieces_join_to_the_text():
    for text in ("", "a", " a", "a  b c\n d", "  ", "a \x1cb", "x y  "):
        assert "".join(alignment.cut(text)) == " " + text


# --- Jaccard join -----------------------------------------------------------


def plain_join(docs, least=80):
    shingles = []
    for _, text in docs:
        words = helpers.white_words(text)
        few = [tuple(words)] if words else []
        shingles.append(frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) > 4 else frozenset(few))
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, own in enumerate(shingles):
        for other in range(k):
            shared = len(own & shingles[other])
            if own and shared and 100 * shared >= least * (len(own) + len(shingles[other]) - shared):
                root[find(k)] = find(other)
    ids = {}
    for k, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            ids[find(k)] = min(doc_id, ids.get(find(k), doc_id))
    return sorted(
        ((d, len(shingles[k]), ids.get(find(k)) if shingles[k] else d) for k, (d, _) in enumerate(docs)), key=repr
    )


def near_copies():
    """A large group of near copies, chains of edits, and a passage that many texts hold."""
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(3000)]
    base = [rnd.choice(words) for _ in range(150)]
    rows = []
    for k in range(150):
        text = list(base)
        for _ in range(rnd.randrange(0, 8)):
            text[rnd.randrange(150)] = rnd.choice(words)
        rows.append((10_000 + k, " ".join(text)))
    passage = [rnd.choice(words) for _ in range(60)]
    for k in range(150):
        rows.append((20_000 + k, " ".join([rnd.choice(words) for _ in range(rnd.randrange(3, 90))] + passage)))
    chain = [rnd.choice(words) for _ in range(100)]
    for k in range(12):
        chain[k * 8] = rnd.choice(words)
        rows.append((30_000 + k, " ".join(chain)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"HOT": 4, "BLOCK": 20, "CELL": 8, "SENT_ROWS": 0}])
def test_join_equals_all_pairs(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard_join, name, value)
    rows = [r[:2] for r in helpers.awkward_rows()] + near_copies()
    docs = helpers.documents(spark, *rows)
    for name in ("node", "root", "n", "kind", "row_key"):
        docs = docs.withColumn(name, F.lit("clash"))
    found = jaccard_join.plan(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == plain_join(rows)


def test_no_whole_sets_are_stored(spark, monkeypatch):
    stored = []
    keep = frames.stored
    monkeypatch.setattr(frames, "stored", lambda df, label: stored.append(df.columns) or keep(df, label))
    rnd = random.Random(4)
    rows = []
    for _ in range(6):
        words = [f"w{rnd.randint(0, 99)}" for _ in range(60)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join([*words, "end"]))]
    found = jaccard_join.plan(helpers.documents(spark, *rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {k: k - k % 2 for k, _ in rows}
    assert stored and not any("shingles" in columns for columns in stored)


def test_join_of_nothing(spark):
    assert jaccard_join.plan(helpers.awkward(spark).limit(0)).count() == 0


def test_prefixes_and_sets():
    for n in range(1, 200):
        kept = n - jaccard_join.prefix_size(n, 80)
        assert (kept + 1) * 100 >= 80 * n and kept * 100 < 80 * n
    (own,) = jaccard_join.sets(pa.array(["a b c d e f a b c d e"]))
    assert len(own) == 6 and (np.diff(own.astype(object)) > 0).all()
    last = np.sort(own[:2])
    assert jaccard_join.ordered(own, last).tolist() == [*own[2:].tolist(), *last.tolist()]


def test_tasks_get_whole_texts_in_small_batches(spark):
    docs = helpers.documents(spark, *((k, f"{k} " * 2500) for k in range(2000))).coalesce(1)

    def sizes(parts):
        for part in parts:
            yield pa.record_batch([pa.array([part.num_rows]), pa.array([part.nbytes])], ["n_rows", "n_bytes"])

    found = frames.stored(docs.select("text").mapInArrow(sizes, "n_rows long, n_bytes long"), "sizes").collect()
    assert sum(r["n_rows"] for r in found) == 2000 and sum(r["n_bytes"] for r in found) > 20_000_000
    assert max(r["n_bytes"] for r in found) < 8 << 20


def test_frequent_shingles_are_counted_over_different_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT", 2)
    rows = [(k, f"a b c d e f {k}") for k in range(4)] + [(9, "a b c d e f 0"), (10, "p q r s t u"), (11, None), (12, "one")]
    found = jaccard_join.frequent(helpers.documents(spark, *rows).coalesce(1))
    own = list(jaccard_join.sets(pa.array([text for _, text in rows])))
    counts = Counter(x for one in {y.tobytes(): y for y in own}.values() for x in one.tolist())
    assert found.tolist() == sorted(x for x, n in counts.items() if n > 2) and len(found) == 2


def test_the_join_leaves_only_the_steps_that_its_result_reads(spark, monkeypatch):
    named, scratch = [], session.scratch
    monkeypatch.setattr(session, "scratch", lambda s, label: named.append(scratch(s, label)) or named[-1])
    text = " ".join(f"w{k}" for k in range(60))
    found = jaccard_join.plan(helpers.documents(spark, (1, text), (2, f"{text} x"), (3, "other words")))
    left = [path.split("/")[-1][:-33] for path in named if storage.exists(spark, path)]
    assert left == ["set-classes", "component-ids"] and len(named) > 10
    assert sorted((r["doc_id"], r["component_id"]) for r in found.collect()) == [(1, 1), (2, 1), (3, 3)]
