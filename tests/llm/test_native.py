"""Sharding, mixing, line dedup and licences."""

from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tapeworks import session
from tapeworks.llm import frames, licences, line_runs, mixing, sharding
from tests.llm import helpers


def shard_counts(planned, shards):
    found = Counter(r["shard"] for r in planned.select("shard").collect())
    return [found.get(k, 0) for k in range(shards)]


def test_shards_are_even_and_slots_gapless(spark):
    planned = sharding.plan(helpers.awkward(spark), shards=5).collect()
    assert len(planned) == len(helpers.awkward_rows())
    slots = defaultdict(list)
    for row in planned:
        slots[row["shard"]].append(row["slot"])
    sizes = [len(x) for x in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert {r["size"] for r in planned if r["doc_id"] == 3} == {1}


def test_equal_texts_meet_in_one_shard(spark):
    rows = [(k, f"alone {k}") for k in range(300)] + [
        (1000 + 10 * g + k, f"group {g}") for g in range(20) for k in range(4)
    ]
    planned = sharding.plan(helpers.documents(spark, *rows))
    assert sharding.cut(planned).first()["cut_links"] == 0
    assert max(shard_counts(planned, 8)) - min(shard_counts(planned, 8)) <= 1


def test_a_link_larger_than_a_shard_fills_whole_shards(spark):
    rows = [(k, "copy") for k in range(120)] + [(500 + k, f"alone {k}") for k in range(120)]
    planned = sharding.plan(helpers.documents(spark, *rows))
    held = Counter(r["shard"] for r in planned.collect() if r["doc_id"] < 120)
    assert sorted(held.values()) == [30] * 4  # 240 rows in 8 shards: 30 each
    assert shard_counts(planned, 8) == [30] * 8


@pytest.mark.parametrize(
    "flows",
    [
        {(0, 1): 5, (1, 0): 2, (1, -1): 10, (0, -1): 0},
        {(0, 1): 5, (1, -1): 2},
        {(0, 1): 5, (2, 1): 5, (1, 2): 1, (1, -1): 4, (2, -1): 1},
        {(0, 1): 5},
    ],
)
def test_quotas_leave_every_count_as_it_was(flows):
    granted, fillers = sharding.quotas(dict(flows), 3)
    change = Counter()
    for (a, b), n in granted.items():
        assert 0 <= n <= flows[a, b]
        change[a] -= n
        change[b] += n
    used = Counter()
    for a, b, first, last in fillers:
        change[a] -= last - first
        change[b] += last - first
        used[a] = max(used[a], last)
    assert not any(change.values())
    assert all(n <= flows.get((a, -1), 0) for a, n in used.items())


def test_sharded_keeps_every_row_and_column(spark):
    docs = helpers.awkward(spark)
    result = sharding.sharded(docs, shards=3)
    assert helpers.bag(result, *docs.columns) == helpers.bag(docs)
    clashing = helpers.clashing(spark)
    result = sharding.sharded(clashing)
    assert sorted(result.columns) == sorted(clashing.columns)
    assert result.schema["shard"].dataType.simpleString() == "int"


def test_targets_are_the_fixed_point_of_resharing(spark):
    sizes = {"a": 100, "b": 1000, "c": 10, "d": 0, "e": 500}
    frame = spark.createDataFrame(list(sizes.items()), "source_key string, source_size long")
    found = {r["source_key"]: r["target"] for r in mixing.targets(frame).collect()}
    weight = dict(zip(sorted(sizes), [5, 2, 1, 5, 2], strict=True))
    # Plain resharing: hand out, cut at twice the size, hand out the rest again.
    goal, open_, rest = dict.fromkeys(sizes, 0.0), set(sizes), 1.5 * sum(sizes.values())
    while open_ and rest > 1e-9:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        rest = 0.0
        for source, words in share.items():
            goal[source] += words
            if goal[source] >= 2 * sizes[source]:
                rest += goal[source] - 2 * sizes[source]
                goal[source] = 2.0 * sizes[source]
                open_.discard(source)
    assert found == pytest.approx(goal)


def test_the_mix_reaches_its_targets(spark):
    rows = [(k, "w " * (1 + k * 7 % 50), f"s{k % 7 if k % 3 else 0}") for k in range(300)]
    docs = helpers.documents(spark, *rows, (900, None, None), (901, "a b", None))
    planned = mixing.plan(docs).collect()
    by_target = defaultdict(list)
    for row in planned:
        assert 0 <= row["taken"] <= 2 * row["size"]
        assert (row["position"] is None) == (row["taken"] == 0)
        by_target[row["target"], row["source_size"]].append(row["taken"])
    assert all(abs(sum(x) - t) <= 0.5 for (t, _), x in by_target.items())
    assert [tuple(r) for r in mixing.plan(docs).collect()] != [] and helpers.bag(
        mixing.plan(docs)
    ) == sorted((tuple(r) for r in planned), key=repr)


def test_position_inverts_the_demand(spark):
    frame = spark.createDataFrame(
        [(d / 20, a) for d in range(21) for a in (-1.0, -0.5, 0.0, 0.5, 1.0)], "d double, a double"
    ).filter("d > 0 OR a > -1")
    for row in frame.withColumn("t", mixing.position(F.col("d"), F.col("a"))).collect():
        assert (1 + row["a"]) * row["t"] - row["a"] * row["t"] ** 2 == pytest.approx(row["d"])


def test_mixed_returns_whole_documents_in_training_order(spark):
    docs = helpers.awkward(spark)
    result = mixing.mixed(docs)
    assert result.columns == docs.columns
    allowed = Counter(helpers.bag(docs))
    assert all(n <= 2 * allowed[row] for row, n in Counter(helpers.bag(result)).items())
    clashing = helpers.clashing(spark)
    assert set(helpers.bag(mixing.mixed(clashing))) <= set(helpers.bag(clashing))


def plain_line_dedup(rows):
    keys = lambda t: [
        helpers.ascii_lower(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")
    ]
    holders = defaultdict(list)
    for doc_id, text in rows:
        for key in set(keys(text)):
            holders[key].append(-1 if doc_id is None else doc_id)
    result = []
    for doc_id, text in rows:
        own = -1 if doc_id is None else doc_id
        lines = (text or "").split("\n")
        kept = [
            line
            for line, key in zip(lines, keys(text), strict=True)
            if len(key) < 40 or len(holders[key]) < 5 or own == max(holders[key])
        ]
        result.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(result, key=repr)


def test_line_dedup_equals_the_plain_one(spark):
    common, rare = "A line that many documents share, of some length " * 2, "x" * 39
    rows = [
        (k, "\n".join([f"own {k}", f"  {common.upper() if k % 2 else common}\t", rare, common]))
        for k in range(9)
    ]
    rows += [r[:2] for r in helpers.awkward_rows()]
    rows += [(20 + k, ("\n" + "é" * 40) * 3) for k in range(4)] + [(None, "é" * 40)]
    docs = helpers.documents(spark, *rows)
    found = line_runs.dedup(docs)
    assert helpers.bag(found, "doc_id", "n_lines", "n_dropped", "kept_text") == plain_line_dedup(rows)


def test_runs_are_levelled_and_found_again(spark):
    docs = helpers.documents(spark, *((k, f"{'line ' * 10}{k % 3}") for k in range(18)))
    lines = frames.stored(line_runs.lines(docs), "test-lines")
    runs = line_runs.LineRuns(spark, session.scratch(spark, "test-runs"), fan_in=2)
    for k in range(6):
        batch = lines.filter(f"doc_id % 6 = {k}")
        unseen = runs.unseen(batch).count()
        assert unseen == (batch.count() if k < 3 else 0)
        runs.add(batch)
    assert [len(level) for level in runs.levels] == [0, 1, 1]
    merged = runs.merged().collect()
    assert sorted((r["documents"], r["last_doc"]) for r in merged) == [(6, 15), (6, 16), (6, 17)]


def test_line_dedup_levels_its_runs_and_anti_joins_each_batch(spark, monkeypatch):
    docs = helpers.documents(spark, *((k, f"{'line ' * 10}{k % 7}\n{'own ' * 12}{k}") for k in range(60)))
    made, asked = [], []
    plain_put, plain_unseen = line_runs.LineRuns._put, line_runs.LineRuns.unseen

    def put(self, level, run):
        plain_put(self, level, run)
        made.append((level, run.filter("first").count(), run.count()))

    def unseen(self, batch):
        found = plain_unseen(self, batch)
        asked.append((found.count(), batch.count(), "SortMergeJoin" in helpers_plan(found)))
        return found

    monkeypatch.setattr(line_runs.LineRuns, "_put", put)
    monkeypatch.setattr(line_runs.LineRuns, "unseen", unseen)
    kept = line_runs.dedup(docs)
    assert kept.agg(F.sum("n_dropped")).first()[0] == 60 - 7
    assert [level for level, _, _ in made] == [0, 0, 1, 0, 0, 1, 2]
    # Each of the 67 keys is first in one run alone, and in the last one all are.
    assert sum(first for level, first, _ in made if level == 0) == 67 and made[-1][1:] == (67, 67)
    assert len(asked) == 3 and all(new < every and merge for new, every, merge in asked)


def test_line_dedup_stores_one_file_of_lines_per_task_and_starts_no_python(spark):
    rows = [(k, f"{'line ' * 10}{k % 7}\n{'own ' * 12}{k}") for k in range(60)]
    folder = Path(session.shared_folder(spark))
    before = set(folder.iterdir())
    kept = line_runs.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert kept.agg(F.sum("n_dropped")).first()[0] == 60 - 7
    made = {path.name.rsplit("-", 1)[0]: path for path in set(folder.iterdir()) - before}
    # Each file costs a process where Spark writes it.
    lines = made["lines"]
    assert len(list(lines.rglob("*.parquet"))) <= 3
    runs = line_runs.LineRuns(spark, session.scratch(spark, "test-runs"))
    for none in (runs.merged(), runs.unseen(runs.merged())):
        assert none.count() == 0 and "ExistingRDD" not in helpers_plan(none)


def helpers_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_dedup_keeps_other_columns(spark):
    names = ["row_key", "dropped_places", "_kept_text", "split_lines", "staying_places", "batch", "n_lines"]
    docs = helpers.documents(spark, *((k, "same line " * 6 + "\nx") for k in range(6)))
    more = docs.withColumns({name: F.col("doc_id") + 100 for name in names})
    found = line_runs.dedup(more)
    assert sorted(found.columns) == sorted([*more.columns, "n_dropped", "kept_text"])
    for row in found.collect():
        assert all(row[name] == row["doc_id"] + 100 for name in names[:-1]) and row["n_lines"] == 2
        assert row["kept_text"] == ("x" if row["doc_id"] < 5 else "same line " * 6 + "\nx")


def test_licences_are_found_and_inherited(spark):
    rows = [
        ("LICENSE", "MIT License\n\nPermission is hereby granted, free of charge, to any person "
         "obtaining a copy of this software and associated documentation files"),
        ("a/LICENSE.txt", "Licensed under the Apache License, Version 2.0"),
        ("a/b/x.py", "code without anything"),
        ("a/b/y.py", "# This work is licensed under the GNU General Public License, version 3\n" + "code " * 50),
        ("c/z.py", None),
        ("z.py", ""),
        ("a/b/w.py", "the licence of a driver"),
        (None, "code"),
    ]
    docs = spark.createDataFrame(
        [(k, text, path) for k, (path, text) in enumerate(rows)],
        "doc_id long, text string, path string",
    )
    found = {
        r["doc_id"]: (r["licence"], r["origin"], r["licence_dir"])
        for r in licences.scanned(docs, F.col("path")).collect()
    }
    assert found == {
        0: ("MIT", "own", None),
        1: ("Apache-2.0", "own", None),
        2: ("Apache-2.0", "inherited", "a"),
        3: ("GPL-3.0", "own", None),
        4: ("MIT", "inherited", ""),
        5: ("MIT", "inherited", ""),
        6: ("Apache-2.0", "inherited", "a"),
        7: (None, None, None),
    }
    repeated = licences.scanned(docs.unionByName(docs), F.col("path"))
    assert repeated.count() == 2 * len(rows)


def test_empty_tables_give_no_rows(spark):
    none = helpers.documents(spark, (1, "x")).limit(0)
    assert sharding.sharded(none).count() == 0
    assert mixing.mixed(none).count() == 0 and mixing.plan(none).count() == 0
    assert line_runs.dedup(none).count() == 0
    assert licences.scanned(none, F.col("source")).count() == 0


def test_running_totals_are_exact_across_lanes(spark):
    frame = spark.range(2000).select(
        (F.col("id") % 2).alias("key"), F.xxhash64("id").alias("spread"), "id"
    )
    found = frames.running(frame, ["key"], "spread", ["id"], F.lit(1), "rank", 8)
    ranks = defaultdict(list)
    for row in found.collect():
        ranks[row["key"]].append(row["rank"])
    assert all(sorted(x) == list(range(1000)) for x in ranks.values())
