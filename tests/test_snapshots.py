"""Versioned tables: switches, crashes, compaction, and marts kept up by change."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeworks.plans import mart_changes, marts
from tapeworks.schemas import CANDLE_DAY
from tapeworks.sinks import snapshots
from tests.helpers import candle, candles, rows

DAYS = "day string, n int"


def frame(spark, *given):
    return spark.createDataFrame(list(given), DAYS)


def stored(spark, path, slices=None):
    return rows(snapshots.read(spark, snapshots.current(spark, path), slices))


def test_slices_are_replaced_and_others_kept_unread(spark, path):
    first = snapshots.replace(frame(spark, ("a", 1), ("b", 2), (None, 3)), path, "day")
    assert first.slices == {"a", "b", None}
    second = snapshots.replace_slices(frame(spark, ("b", 4)), path, "day", {"b", "c"})
    assert stored(spark, path) == [("a", 1), ("b", 4), (None, 3)]
    assert snapshots.touched(first, second) == {"b"}
    assert snapshots.touched(None, first) == {"a", "b", None}
    # The old version is still there, whole, for whoever has taken it.
    assert rows(snapshots.read(spark, first)) == [("a", 1), ("b", 2), (None, 3)]
    only = snapshots.read(spark, second, {"b"})
    assert all("_slice=b" in name for name in only.inputFiles())
    snapshots.replace_slices(frame(spark), path, "day", {"a", None})
    assert stored(spark, path) == [("b", 4)]
    with pytest.raises(ValueError):
        snapshots.replace_slices(frame(spark, ("z", 1)), path, "day", {"a"})


def test_odd_slice_values_come_back(spark, path):
    given = [("a/b=c d%", 1), ("ü", 2), ("2024-01-01 00:00:00", 3)]
    made = snapshots.replace(frame(spark, *given), path, "day")
    assert made.slices == {x[0] for x in given}
    assert stored(spark, path, {"a/b=c d%"}) == [("a/b=c d%", 1)]


@pytest.mark.parametrize("step", ["stage", "write_once"])
def test_readers_see_the_old_table_until_the_switch(spark, path, monkeypatch, step):
    snapshots.replace(frame(spark, ("a", 1), ("b", 2)), path, "day")
    real = getattr(snapshots, step)

    def killed(*args):
        if step == "stage":
            real(*args)  # parts are written, the manifest is not
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshots, step, killed)
    for write in (
        lambda: snapshots.replace(frame(spark, ("c", 9)), path, "day"),
        lambda: snapshots.replace_slices(frame(spark, ("a", 9)), path, "day", {"a"}),
    ):
        with pytest.raises(KeyboardInterrupt):
            write()
        assert stored(spark, path) == [("a", 1), ("b", 2)]
    monkeypatch.undo()
    snapshots.replace(frame(spark, ("c", 9)), path, "day")
    assert stored(spark, path) == [("c", 9)]
    gone = snapshots.expire(spark, path, keep=1)
    assert gone and stored(spark, path) == [("c", 9)]
    assert snapshots.expire(spark, path, keep=1) == []
    assert len(snapshots.versions(spark, path)) == 1


def test_the_second_of_two_writers_gets_a_conflict(spark, path):
    base = snapshots.replace(frame(spark, ("a", 1)), path, "day")
    kind = frame(spark).schema
    snapshots.publish(spark, path, base, base.parts, kind, "day")
    with pytest.raises(snapshots.Conflict):
        snapshots.publish(spark, path, base, [], kind, "day")
    assert stored(spark, path) == [("a", 1)]
    names = snapshots.children(spark, f"{path}/manifests")
    assert [x for x in names if x.endswith(".draft")] == []


def test_runs_leave_few_parts_and_each_row_is_read_once(spark, path):
    seen, followed = 0, []
    for number in range(17):
        for _ in range(2):  # delivered twice
            snapshots.append(frame(spark, ("a", number), ("b" if number % 2 else None, -number)), path, "day", f"r{number}")
        if number % 5 == 0:
            now = snapshots.current(spark, path)
            followed += rows(snapshots.since(spark, now, seen), "day", "n")
            seen = len(now.runs)
        snapshots.compact(spark, path, fan_in=3)
        parts = snapshots.current(spark, path).parts
        for day in ("a", "b", None):
            levels = [p.level for p in parts if p.slice == day]
            assert all(levels.count(level) < 3 for level in set(levels)) and len(levels) <= 6
    last = snapshots.current(spark, path)
    followed += rows(snapshots.since(spark, last, seen), "day", "n")
    expected = sorted(
        [(d, n) for k in range(17) for d, n in (("a", k), ("b" if k % 2 else None, -k))], key=str
    )
    assert sorted(followed, key=str) == expected
    assert sorted(rows(snapshots.read(spark, last), "day", "n"), key=str) == expected


def test_compaction_goes_on_after_another_writer(spark, path, monkeypatch):
    for number in range(3):
        snapshots.append(frame(spark, ("a", number)), path, "day", f"r{number}")
    real, calls = snapshots.publish, []

    def raced(*args, **kinds):
        calls.append(1)
        if len(calls) == 1:
            monkeypatch.setattr(snapshots, "publish", real)
            snapshots.append(frame(spark, ("a", 99)), path, "day", "late")
        return real(*args, **kinds)

    monkeypatch.setattr(snapshots, "publish", raced)
    snapshots.compact(spark, path, fan_in=3)
    assert [n for _, n, _ in stored(spark, path)] == [0, 1, 2, 99]
    assert len(snapshots.current(spark, path).parts) <= 2


AT = dt.datetime(2024, 3, 1, 10)


def some(spark, *days, price=1.0):
    made = []
    for day in days:
        for minute in (0, 1, 61):
            start = AT + dt.timedelta(days=day, minutes=minute)
            made += [candle("A", start, c=price + minute, n=2), candle("B", start, c=price)]
    return candles(spark, *made)


def test_only_changed_days_are_folded_again(spark, tmp_path):
    path, root = str(tmp_path / "candles"), str(tmp_path / "kept")
    mart_changes.put_candles(some(spark, 0, 1, 2), path)
    assert set(mart_changes.refresh(spark, path, root)["hours"]) == {"2024-03-01", "2024-03-02", "2024-03-03"}
    assert mart_changes.refresh(spark, path, root) == {name: set() for name in mart_changes.KEPT}
    before = snapshots.current(spark, f"{root}/summary")
    mart_changes.put_candles(some(spark, 1, 3, price=5.0), path)
    done = mart_changes.refresh(spark, path, root)
    assert done == {name: {"2024-03-02", "2024-03-04"} for name in mart_changes.KEPT}
    after = snapshots.current(spark, f"{root}/summary")
    same = {p.folder for p in before.parts} & {p.folder for p in after.parts}
    assert {p.slice for p in after.parts if p.folder in same} == {"2024-03-01", "2024-03-03"}
    newest = snapshots.current(spark, path)
    read = snapshots.read(spark, newest, done["hours"]).inputFiles()
    assert all("_slice=2024-03-02" in f or "_slice=2024-03-04" in f for f in read)


def test_kept_marts_equal_rebuilt_ones(spark, tmp_path):
    path, root = str(tmp_path / "candles"), str(tmp_path / "kept")
    sentiment = spark.createDataFrame(
        [(dt.date(2024, 3, 2), 40, "Fear")], "date date, fng_value int, fng_classification string"
    )
    as_of = AT + dt.timedelta(days=3, minutes=70)
    for changes in (some(spark, 0, 1), some(spark, 2, 3), some(spark, 1, 2, price=7.0)):
        mart_changes.put_candles(changes, path)
        mart_changes.refresh(spark, path, root)
    whole = snapshots.read(spark, snapshots.current(spark, path)).drop(CANDLE_DAY)
    kept = mart_changes.marts(spark, path, root, sentiment, as_of, symbol="a")
    built = marts.marts(whole, sentiment, as_of, symbol="a")
    for name, mart in built.items():
        assert rows(kept[name], *mart.columns) == rows(mart), name


def test_an_interrupted_refresh_is_completed(spark, tmp_path, monkeypatch):
    path, root = str(tmp_path / "candles"), str(tmp_path / "kept")
    mart_changes.put_candles(some(spark, 0), path)
    mart_changes.refresh(spark, path, root)
    mart_changes.put_candles(some(spark, 0, price=3.0), path)
    real = snapshots.replace_slices

    def killed(df, where, *args, **notes):
        if where.endswith("days"):
            raise KeyboardInterrupt
        return real(df, where, *args, **notes)

    monkeypatch.setattr(snapshots, "replace_slices", killed)
    with pytest.raises(KeyboardInterrupt):
        mart_changes.refresh(spark, path, root)
    monkeypatch.undo()
    done = mart_changes.refresh(spark, path, root)
    assert done["hours"] == set() and done["days"] == done["summary"] == {"2024-03-01"}
    # Expired versions of the candles: everything counts as changed, nothing is lost.
    mart_changes.put_candles(some(spark, 4), path)
    snapshots.expire(spark, path, keep=1)
    assert mart_changes.refresh(spark, path, root)["hours"] == {"2024-03-01", "2024-03-05"}
    total = snapshots.read(spark, snapshots.current(spark, f"{root}/hours"))
    assert total.agg(F.sum("candles_count")).first()[0] == 12
