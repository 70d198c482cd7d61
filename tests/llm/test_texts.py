"""SimHash, decontamination, fingerprints, token files, quality, chat and the pipeline."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tapeworks import session, storage
from tapeworks.llm import (
    chat,
    components,
    decontamination,
    fingerprints,
    frames,
    quality,
    queries,
    simhash,
    token_files,
)
from tests.llm import helpers
from tests.oracle import connect, differences

BPE = public_tokenizers.path("byte_bpe_50k.json")


def plain_simhash(text):
    words = helpers.white_words(text)
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42)
        for k in range(max(1, len(words) - 3))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, budget=4):
    label = np.arange(len(values))
    own = np.array(values, np.uint64)
    a, b = np.nonzero(np.bitwise_count(own[:, None] ^ own[None]) <= budget)
    components.union(label, a, b)
    return label


def flipped(value, bits):
    for bit in bits:
        value ^= 1 << bit
    return value


@pytest.mark.parametrize("dense", [False, True])
def test_tries_find_every_component(spark, dense):
    rnd = random.Random(3)
    centres = [rnd.getrandbits(64) for _ in range(1 if dense else 150)]
    values = {
        flipped(c, rnd.sample(range(64), rnd.choice([0, 1, 3, 4, 5, 6])))
        for c in centres
        for _ in range(800 if dense else 4)
    }
    values = sorted(values | {0, 2**64 - 1} | {rnd.getrandbits(64) for _ in range(50)})
    signed = [v - 2**64 if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    links = simhash.links(frame)
    assert links.count() <= 5 * len(values)
    roots = {r["node"]: r["root"] for r in components.connected(links).collect()}
    label = plain_components(values)
    groups, found = {}, {}
    for k, v in enumerate(signed):
        groups.setdefault(label[k], set()).add(v)
        found.setdefault(roots.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_simhash_of_awkward_documents(spark):
    rows = [r[:2] for r in helpers.awkward_rows()]
    found = simhash.plan(helpers.awkward(spark)).collect()
    assert len(found) == len(rows)
    values = [plain_simhash(text) for _, text in rows]
    label = plain_components(values)
    ids = {}
    for (doc_id, _), root in zip(rows, label, strict=True):
        if doc_id is not None:
            ids[root] = min(doc_id, ids.get(root, doc_id))
    expected = sorted(
        ((d, v, ids.get(root)) for (d, _), v, root in zip(rows, values, label, strict=True)), key=repr
    )
    assert sorted(((r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in found), key=repr) == expected
    kept = simhash.dedup(helpers.awkward(spark)).collect()
    assert len(kept) == len(set(label))


def plain_hits(docs, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", helpers.ascii_lower(t or ""))
    windows = {}
    for item, text in items:
        own = words(text)
        for k in range(max(1, len(own) - size + 1) if own else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add(item)
    result = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for length in {len(w) for w in windows}:
            for k in range(len(own) - length + 1):
                if held := windows.get(tuple(own[k : k + length])):
                    hit |= set(range(k, k + length))
                    found |= held
        result.append((doc_id, len(own), len(hit), tuple(sorted(found)), bool(hit)))
    return sorted(result, key=repr)


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_BYTES, 400])
def test_hits_equal_the_plain_ones(spark, block_bytes):
    rnd = random.Random(5)
    words, gaps = ["a", "of", "The", "é", "ñu", "x1", "Über"], [" ", "  ", ".\n", "-"]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(n))
    items = [(k, text(rnd.choice([0, 1, 3, 9, 10, 11, 40]))) for k in range(20)]
    items += [(20, items[4][1]), (21, None), (22, "")]
    docs = [(k, text(rnd.choice([0, 1, 9, 300]))) for k in range(40)]
    docs += [(50 + k, text(9) + (rnd.choice(items)[1] or "") + text(3)) for k in range(20)]
    docs += [r[:2] for r in helpers.awkward_rows()]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = helpers.documents(spark, *docs)
    found = decontamination.marked(frame, benchmark, block_bytes=block_bytes)
    rows = [
        (r["doc_id"], r["n_words"], r["n_hit"], tuple(r["hit_items"]), r["contaminated"])
        for r in found.withColumn("n_hit", decontamination.hit_words(F.col("hit_spans"))).collect()
    ]
    assert sorted(rows, key=repr) == plain_hits(docs, items)
    clean = decontamination.clean(frame, benchmark)
    assert clean.count() == sum(not row[-1] for row in rows) and clean.columns == frame.columns


def test_decontamination_of_nothing_and_of_clashing_columns(spark):
    benchmark = spark.createDataFrame([(1, "text number 3 of some words")], "item_id long, text string")
    docs = helpers.clashing(spark)
    left = decontamination.clean(docs, benchmark)
    assert left.columns == docs.columns and left.count() == 39
    assert helpers.bag(decontamination.clean(docs, benchmark.limit(0))) == helpers.bag(docs)
    assert decontamination.clean(docs.limit(0), benchmark).count() == 0


def shingle_set(text):
    words = helpers.white_words(text)
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_fingerprints_and_edits(spark):
    rows = [(k, f"{'common start of a text ' * 3} number {k} " + "tail " * (k % 9)) for k in range(60)]
    rows += [(100, None), (101, ""), (102, helpers.LONG), (103, "é ü"), (104, rows[3][1]), (None, "no id here")]
    found = {r["doc_id"]: r for r in fingerprints.compared(helpers.documents(spark, *rows)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited, row = text[: len(text) - half] + following[:half], found[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingle_set(text), shingle_set(edited)
        true = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(row["near_edited"] - true) < 0.2
    assert found[104]["fingerprint"] == found[3]["fingerprint"]
    assert len(fingerprints.compared(helpers.awkward(spark)).collect()) == len(helpers.awkward_rows())
    assert fingerprints.compared(helpers.awkward(spark).limit(0)).count() == 0
    one = fingerprints.compared(helpers.documents(spark, (1, "a b c d e f"))).first()
    assert one["near_next"] == 1.0


def test_near_duplicates_are_classes_of_similar_texts(spark):
    rnd = random.Random(9)
    base = [[rnd.choice("abcdefghij") + str(rnd.randint(0, 99)) for _ in range(120)] for _ in range(12)]
    rows = []
    for words in base:
        for k in range(5):
            edited = list(words)
            for _ in range(k):  # each edit changes five shingles of 116
                edited[rnd.randrange(len(edited))] = "edit"
            rows.append((len(rows), " ".join(edited)))
    rows += [(100, None), (101, ""), (102, "a b"), (103, "A  b"), (None, rows[0][1]), (104, rows[7][1])]
    found = fingerprints.near_duplicates(helpers.documents(spark, *rows)).collect()
    sets = [shingle_set(text) for _, text in rows]
    label = np.arange(len(rows))
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if (len(sets[i] & sets[j]) / len(sets[i] | sets[j]) if sets[i] | sets[j] else 1) >= 0.8
    ]
    components.union(label, *np.array(pairs).T)
    ids = {}
    for (doc_id, _), root in zip(rows, label, strict=True):
        if doc_id is not None:
            ids[root] = min(doc_id, ids.get(root, doc_id))
    expected = sorted(((d, ids.get(r)) for (d, _), r in zip(rows, label, strict=True)), key=repr)
    assert sorted(((r["doc_id"], r["class_id"]) for r in found), key=repr) == expected
    none = helpers.documents(spark, *rows).limit(0)
    assert fingerprints.near_duplicates(none).count() == 0


def similar_classes(rows, least=0.8):
    sets = [shingle_set(text) for _, text in rows]
    label = np.arange(len(rows))
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if (len(sets[i] & sets[j]) / len(sets[i] | sets[j]) if sets[i] | sets[j] else 1) >= least
    ]
    components.union(label, *np.array(pairs).T)
    return label


def test_the_copies_stage_drops_texts_of_similarity_from_0_8(spark, sf_dir):
    rnd = random.Random(5)
    rows = []
    for edits in [1, 2, 3, 4, 5, 6] * 5:
        words = [f"{rnd.choice('abcdefghij')}{rnd.randint(0, 99)}" for _ in range(250)]
        rows.append((len(rows), " ".join(words)))
        for k in range(edits):  # each changes five shingles of 246
            words[10 + 40 * k] = "edit"
        rows.append((len(rows), " ".join(words)))
    label = similar_classes(rows)
    assert 40 > len(set(label)) >= 30
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = stage(spark, helpers.documents(spark, *rows), sf_dir)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(label.tolist()))


def test_texts_of_large_bands_are_compared_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "SMALL_BAND", 2)
    monkeypatch.setattr(fingerprints, "BLOCK_TEXTS", 4)
    monkeypatch.setattr(fingerprints, "TURNS", 1)
    rnd = random.Random(2)
    common = [f"w{k}" for k in range(150)]
    rows = []
    for _ in range(8):  # all share bands, only those of the same tail are similar
        tail = [f"t{rnd.randint(0, 9999)}" for _ in range(60)]
        for k in range(3):
            rows.append((len(rows), " ".join([*common, *tail, f"end{k}"])))
    blocks = []
    whole = fingerprints._linked
    monkeypatch.setattr(
        fingerprints, "_blocked", lambda *given, own=fingerprints._blocked: blocks.append(given[0].count()) or own(*given)
    )
    found = fingerprints.near_duplicates(helpers.documents(spark, *rows)).collect()
    label = similar_classes(rows)
    assert blocks[0] > 0 and len(set(label)) == 8
    assert {r["doc_id"]: r["class_id"] for r in found} == dict(enumerate(label.tolist()))
    assert {r["class_rows"] for r in found} == {3}
    same = pa.table(
        {
            "node": range(200),
            "root": range(200),
            "is_low": [True] * 200,
            "is_high": [True] * 200,
            "shingles": [[1, 2, 3]] * 100 + [[k, -k] for k in range(10, 110)],
        }
    )
    assert whole(same, 0.8).num_rows == 99  # of 4,950 similar pairs


def test_fingerprints_of_the_query_come_with_their_classes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    label = similar_classes(rows)
    found = {r["doc_id"]: r for r in queries.QUERIES["op1_fingerprints"](spark, sf_dir).collect()}
    for (doc_id, _), root in zip(rows, label, strict=True):
        assert found[doc_id]["class_id"] == rows[root][0]
        assert found[doc_id]["class_rows"] == (label == root).sum()


def test_classes_go_to_the_fingerprints_not_back(spark):
    rows = [(k, f"a b c d e f{k // 3} g h") for k in range(40)]
    docs = helpers.awkward(spark).unionByName(helpers.documents(spark, *rows, *rows[:5], (None, rows[0][1])))
    found = fingerprints.near_duplicates(docs)
    given = fingerprints.compared(docs, found)
    of_row = found.select("row_key", "class_id", "class_rows").distinct()
    joined = fingerprints.compared(docs).join(of_row, "row_key").select(*given.columns)
    plain = lambda df: sorted(map(repr, df.collect()))
    assert plain(given) == plain(joined) and given.count() == docs.count()
    plan = given._jdf.queryExecution().optimizedPlan().toString()
    # Above the fingerprints is nothing: they are as large as the texts.
    assert "Join" not in plan[: plan.index("MapInArrow")] and plan.startswith("MapInArrow")
    assert fingerprints.compared(docs.limit(0), found).columns == given.columns


def test_pieces_encode_like_whole_texts():
    rnd = random.Random(1)
    parts = ["a", " ", "  ", "\n", "\t", " \n", "é", "1", "'s", "!", "<|endoftext|>", "\x1c", "\x85", " "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    own, whole = token_files.Encoder(BPE), Tokenizer.from_file(BPE)
    assert own.by_pieces
    expected = [x.ids for x in whole.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode(texts)] == expected
    assert not token_files.Encoder(public_tokenizers.path("word_bpe_49k.json")).by_pieces


def test_texts_of_odd_spaces_encode_like_whole_texts():
    rnd = random.Random(11)
    parts = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u3000", "\u180e"]
    parts += ["a", "word", "Été", "ß", "“", "—", "日本", "ạ", "Ω", "😀", "1", "23", "'s", "don't", ",", ".", "\x00", "ÿ", "Ā"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(4000)]
    texts[100:103] = ["", "", " "]
    whole = Tokenizer.from_file(BPE)
    expected = [x.ids for x in whole.encode_batch(texts, add_special_tokens=False)]
    own = token_files.Encoder(BPE)
    for column in (pa.array(texts), pa.array(["x", *texts])[1:], pa.array(texts, pa.large_string())):
        assert [x.tolist() for x in own.encode(column)] == expected
    assert own.encode(pa.array([], pa.string())) == []
    assert [len(x) for x in own.encode(pa.array(["", ""]))] == [0, 0]


def test_different_words_are_encoded_in_one_call(monkeypatch):
    special = token_files.Encoder(BPE).special[0]
    texts = [f"the same words, and word {k % 7} of the\nsame" for k in range(300)] + [f"a {special} b"]
    own, asked = token_files.Encoder(BPE), []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            plain = getattr(self.inner, name)

            def counted(batch, **how):
                asked.append((name, sum(len(x) if isinstance(x, list) else 1 for x in batch)))
                return plain(batch, **how)

            return counted

    expected = [x.ids for x in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(own, "tokenizer", Counted(own.tokenizer))
    monkeypatch.setattr(own, "words_only", Counted(own.words_only))
    assert [x.tolist() for x in own.encode(pa.array(texts))] == expected
    # Only the text with a special token goes whole; 300 texts have these words.
    words = {w for text in texts[:300] for w in token_files._WORDS.findall(text)}
    assert sorted(asked) == [("encode_batch", 1), ("encode_batch_fast", len(words))]


def test_grammars_decode_whole_and_in_part():
    rng = np.random.default_rng(2)
    ends = np.sort(rng.choice(20_000, 50, replace=False))
    begins = np.concatenate([[0, 0], ends, [20_000, 20_000]])
    for ids in (rng.zipf(1.4, 20_000) % 60, np.full(20_000, 7), np.tile([1, 2], 10_000)):
        grammar = token_files.compress(ids, begins, 100)
        assert len(grammar.symbols) < len(ids)
        assert np.array_equal(grammar.expanded(grammar.symbols.astype(np.int64)), ids)
        for k in range(len(begins) - 1):
            own = ids[begins[k] : begins[k + 1]]
            start, stop = sorted(rng.integers(0, len(own) + 2, 2))
            assert np.array_equal(grammar.document(k), own)
            assert np.array_equal(grammar.document(k, start, stop), own[start:stop])


def test_token_files_round_trip(spark):
    docs = helpers.awkward(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    path = session.scratch(spark, "test-tokens")
    token_files.write(docs, BPE, path)
    found = {r["doc_id"]: r for r in token_files.read(spark, path).collect()}
    whole, start = Tokenizer.from_file(BPE), 0
    for row in sorted(docs.collect()):
        ids = np.array([*whole.encode(row["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        got = found[row["doc_id"]]
        assert (got["start"], got["n_tokens"], got["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    path = session.scratch(spark, "test-tokens")
    token_files.write(helpers.awkward(spark), BPE, path)
    assert token_files.read(spark, path).count() == len(helpers.awkward_rows())
    path = session.scratch(spark, "test-tokens")
    token_files.write(docs.limit(0), BPE, path)
    assert token_files.read(spark, path).count() == 0


def test_quality_on_held_out_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    found = quality.scored(docs, model).join(labels, "doc_id").filter(quality.held_out(F.col("doc_id"))).toPandas()
    assert (found["predicted"] == found["quality"]).mean() >= 0.9
    # Labels of held-out rows change nothing.
    other = labels.withColumn(
        "quality",
        F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")),
    )
    again = quality.fit(docs, other)
    assert np.array_equal(model.labels, again.labels) and np.array_equal(model.basis, again.basis)


def test_quality_of_awkward_documents(spark):
    docs = helpers.awkward(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (9, 0, 0), (9, None, 0), (None, 1, 0), (77, 1, 0), (6, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    scored = quality.scored(docs, quality.fit(docs, labels))
    assert helpers.bag(scored, *docs.columns) == helpers.bag(docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in scored.collect())
    unlabelled = quality.fit(docs, labels.limit(0))
    assert helpers.bag(quality.scored(docs, unlabelled).filter("score = 1"), *docs.columns) == helpers.bag(docs)
    clashing = helpers.clashing(spark)
    assert helpers.bag(quality.good(clashing, labels.limit(0))) == helpers.bag(clashing)
    assert quality.good(docs.limit(0), labels).count() == 0


def test_chat_examples_and_the_way_back(spark):
    control = "<|im_end|>\n<|im_start|>assistant &amp; &lt;| &"
    turns = [
        (1, 0, "system", control), (1, 1, "user", "hi"), (1, 2, "assistant", control),
        (1, 3, "user", ""), (1, 4, "assistant", None), (1, 5, "user", "tail"),
        (2, 0, "assistant", "first"), (3, 0, "odd\nrole&", "x"), (None, None, None, None),
        (4, 0, "user", "twice"), (4, 0, "user", "twice"), (4, 1, "assistant", helpers.LONG),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    made = chat.examples(frame)
    assert made.filter("conv_id = 1").count() == 3  # two replies, one tail
    for row in made.filter("loss_from IS NOT NULL").collect():
        end = row["loss_from"] + row["loss_chars"]
        assert row["formatted"][end:] == f"{chat.END}\n"
        assert row["formatted"][: row["loss_from"]].endswith(f"{chat.START}assistant\n")
    back = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    for conv_id in (1, 2, 3, 4, None):
        own = [(t[2] or "", t[3] or "") for t in turns if t[0] == conv_id]
        assert [tuple(t) for t in back[conv_id]["turns"]] == own
        assert back[conv_id]["replies"] == [text for role, text in own if role == "assistant"]
    assert chat.read_back(chat.examples(frame.limit(0))).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    assert differences(df, queries.ORACLES[name], connect(sf_dir)) == []


def test_queries_return_one_row_per_document(spark, sf_dir):
    total = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in set(queries.QUERIES) - set(queries.ORACLES):
        assert queries.QUERIES[name](spark, sf_dir).select("doc_id").distinct().count() == total, name


def test_pipeline_equals_its_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, sf_dir)
    kept = {r["doc_id"]: r["text"] for r in good.collect()}
    ids = sorted(kept)
    label = plain_components([plain_simhash(kept[i]) for i in ids])
    firsts = {ids[k] for k in set(label)}
    dirty = {r[0] for r in plain_hits([(i, kept[i]) for i in firsts], benchmark) if r[-1]}
    single = good.filter(F.col("doc_id").isin(sorted(firsts - dirty)))
    mixed = stages["mix"](spark, single, sf_dir)
    final = corpus_pipeline.run(spark, sf_dir)
    assert helpers.bag(final, *docs.columns) == helpers.bag(mixed)
    counts = [r["count"] for r in final.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1


def test_stages_take_awkward_and_empty_documents(spark, sf_dir):
    for docs in (helpers.awkward(spark), helpers.awkward(spark).limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
        last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert helpers.bag(last, *docs.columns) == helpers.bag(docs)


def test_slices_cover_every_text():
    column = pa.array(["a" * 10, None, "", "b" * 100, "c"])
    from tapeworks.llm import texts

    seen = []
    for first, data, offsets in texts.slices(column, 20):
        for k in range(len(offsets) - 1):
            seen.append((first + k, data[offsets[k] : offsets[k + 1]].tobytes().decode()))
    assert seen == list(enumerate(["a" * 10, "", "", "b" * 100, "c"]))


def _shuffle_files(spark) -> int:
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_the_shuffle_files_of_a_stored_step_go_with_it(spark):
    before = _shuffle_files(spark)
    counted = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
    assert len(frames.stored(counted, "counted").collect()) == 10
    for _ in range(50):
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) != "true"


def test_steps_on_the_way_are_discarded(spark):
    seen = []

    def build():
        one = frames.stored(spark.range(10), "one")
        two = frames.concluded(lambda: frames.stored(one.filter("id > 2"), "inner").filter("id > 4"), "two")
        seen.extend([*one.inputFiles(), *two.inputFiles()])
        return two.join(one, "id")

    found = frames.concluded(build, "last")
    assert sorted(r["id"] for r in found.collect()) == [5, 6, 7, 8, 9]
    assert seen and not any(storage.exists(spark, path) for path in seen)


def test_bands_that_one_text_has_are_not_shuffled_again(spark):
    same = " ".join(f"w{k}" for k in range(40))
    docs = helpers.documents(spark, (1, same), (2, f"{same} tail"), (3, "all other words here today"), (4, None))
    marked = fingerprints.banded(docs)
    member = marked.select("node", F.explode("bands").alias("band"))
    shared = member.groupBy("band").agg(F.count_distinct("node").alias("n")).filter("n > 1").select("band")
    expected = sorted(map(tuple, member.join(shared, "band").select("node", "band").collect()))
    found = sorted(map(tuple, fingerprints._passing(marked, shared).collect()))
    assert set(expected) <= set(found) and 0 < len(expected) <= len(found) < member.count()
