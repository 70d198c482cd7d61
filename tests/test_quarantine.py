"""Dead letters: reasons, text, and replays that add each mended message once."""

import pytest
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.plans import quarantine
from tapeworks.sinks import snapshots
from tapeworks.sources.files import parquet_tree
from tests.helpers import rows

GOOD = '{"source":"f","symbol":"A","price":1.5,"quantity":2.0,"trade_time":1709287200000,"is_buyer_maker":true,"ingested_at":"x"}'
UNIT = GOOD.replace('"quantity":2.0', '"quantity":"2 lots"')
TWO = UNIT.replace("1.5", '"?"')
GIVEN = [
    (GOOD, None), ('{"symbol":"A"}', None), ("{}", None), (GOOD.replace("1.5", "null"), None),
    (None, "empty"), ("  ", "empty"), ("not json", "no JSON object"), ("[1]", "no JSON object"),
    ("7", "no JSON object"), (UNIT, "wrong type: quantity"), (TWO, "wrong type: price, quantity"),
    (GOOD.replace("true", '"yes"'), "wrong type: is_buyer_maker"),
]


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def mend(text):
    return F.regexp_replace(text, '"([0-9.]+) lots"', "$1")


@pytest.mark.parametrize("text,reason", GIVEN)
def test_reasons(spark, text, reason):
    assert messages(spark, text).select(quarantine.fault(F.col("value"))).first()[0] == reason


def test_letters_keep_their_text_and_are_added_once(spark, path):
    given = messages(spark, UNIT, UNIT, "not json", GOOD, None)
    for _ in range(2):
        quarantine.quarantine(given, path, "r1")
    letters = snapshots.read(spark, snapshots.current(spark, path))
    assert rows(letters, "value", "copies") == rows(
        spark.createDataFrame([(UNIT, 2), ("not json", 1), (None, 1)], "value string, copies long")
    )
    assert quarantine.sound(given).count() == 1


@pytest.mark.parametrize("crash", [False, True])
def test_a_replay_adds_each_mended_message_once(spark, tmp_path, monkeypatch, crash):
    path, target = str(tmp_path / "letters"), str(tmp_path / "bronze")
    quarantine.quarantine(messages(spark, UNIT, UNIT, TWO, "not json"), path, "r1")
    if crash:  # bronze is written, the table is not switched
        def killed(*args, **kinds):
            raise KeyboardInterrupt

        monkeypatch.setattr(snapshots, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            quarantine.replay(spark, path, mend, target, "lots")
        monkeypatch.undo()
    assert quarantine.replay(spark, path, mend, target, "lots") == 1
    assert quarantine.replay(spark, path, mend, target, "lots") == 0
    added = parquet_tree(spark, target, schemas.BRONZE)
    assert rows(added, "symbol", "price", "quantity", "hour") == [("A", 1.5, 2.0, 10)]
    left = snapshots.read(spark, snapshots.current(spark, path))
    assert rows(left, "value") == [("not json",), (TWO,)]


def test_nothing_to_quarantine(spark, path):
    quarantine.quarantine(messages(spark, GOOD), path, "r1")
    assert snapshots.read(spark, snapshots.current(spark, path)).count() == 0
    assert quarantine.replay(spark, path, mend, path + "-bronze", "x") == 0
