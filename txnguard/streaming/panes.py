"""Sliding velocity on a stream by panes (the sliding form of D2).

A window of 60 seconds that slides by 10 is six panes of 10 seconds, and a pane
belongs to six windows. The state holds one count per user and pane, shared by all
windows that overlap it, instead of one per window; a row costs one addition. An
event-time timer evaluates the windows that the watermark has passed, in order,
from running sums over the panes, and panes that no later window holds are dropped.
What a call holds is a user's open panes: their number is bounded by the window,
the watermark's delay and the time that a micro-batch spans, not by the rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from txnguard.functions.columns import event_time, interval_micros
from txnguard.schemas import VELOCITY_MIN_EXCLUSIVE, VELOCITY_WATERMARK, VELOCITY_WINDOW

_NULL = "\x00null"
_PANES = T.StructType([T.StructField("panes", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("done", T.LongType())])
ALERTS = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("start_us", T.LongType()), T.StructField("end_us", T.LongType()), T.StructField("count", T.LongType())])


def closed_windows(panes: dict[int, int], done: int | None, passed: int, size: int, slide: int) -> list[tuple[int, int]]:
    """(end, rows) of the non-empty windows that end after ``done`` and at ``passed`` or before; all in microseconds."""
    starts = sorted(panes)
    if not starts:
        return []
    first = starts[0] + slide if done is None else max(starts[0], done) + slide
    last = min(starts[-1] + size, passed - passed % slide)
    out, total, lo, hi = [], 0, 0, 0
    for end in range(first, last + 1, slide):
        while hi < len(starts) and starts[hi] < end:
            total += panes[starts[hi]]
            hi += 1
        while lo < hi and starts[lo] < end - size:
            total -= panes[starts[lo]]
            lo += 1
        if total:
            out.append((end, total))
    return out


class PaneCounts(StatefulProcessor):
    def __init__(self, size: int, slide: int, min_exclusive: int):
        self.size, self.slide, self.min_exclusive = size, slide, min_exclusive

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", _PANES)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = Counter(r["event_us"] // self.slide * self.slide for r in rows)
        before = self.state.get()
        panes, done = (Counter(dict(zip(before[0], before[1]))), before[2]) if before else (Counter(), None)
        panes.update(new)
        self.state.update((list(panes), list(panes.values()), done))
        self.handle.registerTimer((min(new) + self.slide) // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        before = self.state.get()
        if not before:
            return iter(())
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        panes, done = dict(zip(before[0], before[1])), before[2]
        user = None if key[0] == _NULL else key[0]
        out = [Row(*ALERTS.names)(user, end - self.size, end, n) for end, n in closed_windows(panes, done, passed, self.size, self.slide) if n > self.min_exclusive]
        done = passed - passed % self.slide
        panes = {p: n for p, n in panes.items() if p + self.size > done}
        if panes:
            self.state.update((list(panes), list(panes.values()), done))
            self.handle.registerTimer((max(min(panes), done) + self.slide) // 1000)
        else:
            self.state.clear()
        return iter(out)

    def close(self) -> None:
        pass


def sliding_velocity_stream(
    silver: DataFrame, window: str = VELOCITY_WINDOW, slide: str = "10 seconds", min_exclusive: int = VELOCITY_MIN_EXCLUSIVE, watermark: str = VELOCITY_WATERMARK
) -> DataFrame:
    """user_id, window, count of every sliding window with more than ``min_exclusive`` rows, once the watermark has passed it."""
    size, step = interval_micros(window), interval_micros(slide)
    if size % step or step % 1000:
        raise ValueError("the window must be a whole number of slides, and a slide whole milliseconds")
    rows = silver.select(F.coalesce("user_id", F.lit(_NULL)).alias("_ukey"), event_time("transaction_time").alias("_et")).where("_et is not null")
    rows = rows.withColumn("event_us", F.unix_micros("_et")).withWatermark("_et", watermark)
    found = rows.groupBy("_ukey").transformWithState(PaneCounts(size, step, min_exclusive), outputStructType=ALERTS, outputMode="Append", timeMode="EventTime")
    window_col = F.struct(F.timestamp_micros("start_us").alias("start"), F.timestamp_micros("end_us").alias("end"))
    return found.select("user_id", window_col.alias("window"), "count")


def sliding_velocity(silver: DataFrame, window: str = VELOCITY_WINDOW, slide: str = "10 seconds", min_exclusive: int = VELOCITY_MIN_EXCLUSIVE) -> DataFrame:
    """The batch twin, by panes too: rows are counted per pane before a pane is copied into the windows that hold it."""
    size, step = interval_micros(window), interval_micros(slide)
    us = F.unix_micros(event_time("transaction_time"))
    panes = silver.withColumn("_us", us).where("_us is not null").groupBy("user_id", (F.col("_us") - F.pmod(F.col("_us"), F.lit(step))).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    starts = F.sequence(F.col("_p") - F.lit(size - step), F.col("_p"), F.lit(step))
    counts = panes.withColumn("_s", F.explode(starts)).groupBy("user_id", "_s").agg(F.sum("_n").alias("count")).where(F.col("count") > F.lit(int(min_exclusive)))
    return counts.select("user_id", F.struct(F.timestamp_micros("_s").alias("start"), F.timestamp_micros(F.col("_s") + F.lit(size)).alias("end")).alias("window"), "count")
