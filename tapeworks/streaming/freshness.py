"""Freshness that changes by the clock: a stream of state changes per symbol.

``plans.pipeline_health.freshness`` scans the candles and says how things stand. Here a
symbol's newest candle is kept as state with a timer at the moment its label changes, so
a feed that falls silent is noticed although nothing arrives, and no candle is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tapeworks import fixed_values as fv

_CHANGE = "symbol string, changed_ms bigint, freshness_status string, latest_ms bigint"
_KEPT = "status string, timer bigint, spans array<bigint>"
_LABELS = (fv.STATUS_FRESH, fv.STATUS_STALE, fv.STATUS_DEAD)


def freshness_changes(
    candles: DataFrame,
    ticks: DataFrame | None = None,
    lateness: str = fv.LATENESS,
    fresh: float = fv.FRESH_MINUTES,
    stale: float = fv.STALE_MINUTES,
) -> DataFrame:
    """Every change of a symbol's freshness, once, as event time passes.

    ``candles`` is a stream with ``symbol`` and ``candle_start_time``. Columns of the
    result: ``symbol``, ``changed_at`` (the first millisecond of the new state),
    ``freshness_status`` and ``latest_candle_time`` then. Event time is the watermark:
    the newest candle of any symbol, less ``lateness``. A stream ``ticks`` with a column
    ``moment`` moves it while all symbols are silent. Candles behind the watermark are
    dropped; within ``lateness`` their order does not matter, nor how they fall into
    micro-batches. Candles without a time are skipped; those without a symbol are one.

    State per symbol is a few numbers: candles no further apart than ``fresh`` are kept
    as the ends of their span.
    """
    seen = _seen(candles)
    if ticks is not None:
        beat = ticks.select(
            F.lit(None).cast("string").alias("symbol"), F.col("moment"), F.lit(True).alias("tick")
        )
        seen = seen.unionByName(beat)
    timed = seen.withWatermark("moment", lateness).withColumn("at_ms", F.unix_millis("moment"))
    watch = _event_time_watch(_ms(fresh), _ms(stale), _LABELS)
    return _changes(timed, watch, "EventTime")


def live_freshness_changes(
    candles: DataFrame, fresh: float = fv.FRESH_MINUTES, stale: float = fv.STALE_MINUTES
) -> DataFrame:
    """The same by the clock of the machine: for feeds that may fall silent as a whole.

    A change is stamped with the time it was found at. Needs a trigger that goes on, such
    as ``processingTime``: its empty micro-batches let the timers run. The age counts from
    the start of the newest candle, so ``fresh`` has to cover a candle's width and the time
    it takes to be written.
    """
    seen = _seen(candles).withColumn("at_ms", F.unix_millis("moment"))
    return _changes(seen, _clock_watch(_ms(fresh), _ms(stale), _LABELS), "ProcessingTime")


def _seen(candles: DataFrame) -> DataFrame:
    moment = F.col("candle_start_time")
    return candles.filter(moment.isNotNull()).select(
        "symbol", moment.alias("moment"), F.lit(False).alias("tick")
    )


def _ms(minutes: float) -> int:
    return round(minutes * 60_000)


def _changes(seen: DataFrame, watch: StatefulProcessor, clock: str) -> DataFrame:
    found = seen.groupBy("symbol").transformWithState(
        statefulProcessor=watch, outputStructType=_CHANGE, outputMode="Append", timeMode=clock
    )
    return found.select(
        "symbol",
        F.timestamp_millis("changed_ms").alias("changed_at"),
        "freshness_status",
        F.timestamp_millis("latest_ms").alias("latest_candle_time"),
    )


# The processors are made in functions, so that they travel to the executors by value.


def _event_time_watch(fresh: int, stale: int, labels: tuple[str, str, str]) -> StatefulProcessor:
    from bisect import bisect_right

    from pyspark.sql import Row

    class Watch(StatefulProcessor):
        """``spans`` holds first and last of each run of candles, in order. With a status
        the first span is the one that made it; the others lie in the future."""

        def init(self, handle):
            self.handle = handle
            self.kept = handle.getValueState("kept", _KEPT)

        def handleInputRows(self, key, rows, timerValues):
            passed = timerValues.getCurrentWatermarkInMs()
            status, timer, spans = self.load()
            for row in rows:
                if not row.tick and row.at_ms > passed:
                    self.insert(spans, row.at_ms)
            yield from self.advance(key, status, timer, spans, passed)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            status, _, spans = self.load()
            yield from self.advance(key, status, None, spans, timerValues.getCurrentWatermarkInMs())

        def close(self):
            pass

        def load(self):
            found = self.kept.get() if self.kept.exists() else None
            return (found[0], found[1], list(found[2])) if found else (None, None, [])

        @staticmethod
        def insert(spans, moment):
            place = bisect_right(spans, moment)
            if place % 2:
                return
            joins_last = place > 0 and moment - spans[place - 1] <= fresh
            joins_next = place < len(spans) and spans[place] - moment <= fresh
            if joins_last and joins_next:
                del spans[place - 1 : place + 1]
            elif joins_last:
                spans[place - 1] = moment
            elif joins_next:
                spans[place] = moment
            else:
                spans[place:place] = [moment, moment]

        def advance(self, key, status, timer, spans, passed):
            """The changes up to ``passed``, and a timer at the next possible one."""
            found = []
            while spans:
                if status is None:
                    if spans[0] > passed:
                        break
                    status = labels[0]
                    found.append((spans[0], status, spans[0]))
                last = spans[1]
                following = spans[2] if len(spans) > 2 else None
                for before, after, moment in (
                    (labels[0], labels[1], last + fresh + 1),
                    (labels[1], labels[2], last + stale + 1),
                ):
                    due = moment <= passed and (following is None or moment < following)
                    if status == before and due:
                        status = after
                        found.append((moment, status, last))
                if following is None or following > passed:
                    break
                del spans[:2]
                if status != labels[0]:
                    status = labels[0]
                    found.append((following, status, following))
            self.store(status, timer, spans)
            for moment, label, latest in found:
                yield Row(symbol=key[0], changed_ms=moment, freshness_status=label, latest_ms=latest)

        def store(self, status, timer, spans):
            if not spans:
                return
            if status is None:
                wanted = spans[0]
            else:
                limit = {labels[0]: fresh, labels[1]: stale}.get(status)
                ahead = [spans[1] + limit + 1] if limit is not None else []
                wanted = min([*ahead, *spans[2:3]], default=None)
            if timer is not None and timer != wanted:
                self.handle.deleteTimer(timer)
            if wanted is not None and wanted != timer:
                self.handle.registerTimer(wanted)
            self.kept.update((status, wanted, spans))

    return Watch()


def _clock_watch(fresh: int, stale: int, labels: tuple[str, str, str]) -> StatefulProcessor:
    from pyspark.sql import Row

    class Watch(StatefulProcessor):
        """``spans`` holds the newest candle only."""

        def init(self, handle):
            self.handle = handle
            self.kept = handle.getValueState("kept", _KEPT)

        def handleInputRows(self, key, rows, timerValues):
            status, timer, spans = self.kept.get() if self.kept.exists() else (None, None, [])
            newest = max([*spans, *(row.at_ms for row in rows)])
            now = timerValues.getCurrentProcessingTimeInMs()
            yield from self.judge(key, status, timer, newest, now)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            status, _, spans = self.kept.get()
            now = timerValues.getCurrentProcessingTimeInMs()
            yield from self.judge(key, status, None, spans[0], now)

        def close(self):
            pass

        def judge(self, key, status, timer, newest, now):
            age = now - newest
            label = labels[0] if age <= fresh else labels[1] if age <= stale else labels[2]
            limit = {labels[0]: fresh, labels[1]: stale}.get(label)
            wanted = None if limit is None else newest + limit + 1
            if timer is not None and timer != wanted:
                self.handle.deleteTimer(timer)
            if wanted is not None and wanted != timer:
                self.handle.registerTimer(wanted)
            self.kept.update((label, wanted, [newest]))
            if label != status:
                yield Row(symbol=key[0], changed_ms=now, freshness_status=label, latest_ms=newest)

    return Watch()
