"""Consolidation as a stream of changes (R7): keyed rule-set state per transaction.

``rule_set_changes`` keeps the set of triggered rules of every flagged transaction
as typed state (RocksDB) and emits a row whenever a set grows: the transaction, its
whole sorted rule set and a version. A micro-batch costs time and reads in
proportion to its own hits; no day is read again. The changes are appended to a
table, whose highest version per key is the consolidated row (``latest``, a grouped
maximum), so a reader may merge them at any time, and a batch written twice changes
nothing.

A transaction's hits arrive within the window and the watermark's delay of each
other; ``keep`` (event time) says how long a set is remembered after the
transaction. A later hit starts the set anew, so give it room.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from txnguard.functions.columns import event_time, interval_micros
from txnguard.schemas import SILVER_SCHEMA, TXN_COLS, VELOCITY_WATERMARK

_KEY = "change_key"
CHANGES = T.StructType(
    [T.StructField(_KEY, T.StringType()), *SILVER_SCHEMA.fields, T.StructField("triggered_rules", T.ArrayType(T.StringType())), T.StructField("version", T.IntegerType())]
)
_RULES = T.StructType([T.StructField("rules", T.ArrayType(T.StringType()))])


def change_key() -> Column:
    """128-bit key of a transaction: all nine columns, NULLs included."""
    return F.md5(F.to_json(F.struct(*TXN_COLS), {"ignoreNullFields": "false"}))


class RuleSets(StatefulProcessor):
    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rules = handle.getValueState("rules", _RULES)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first, new = None, set()
        for r in rows:  # one transaction; its rules are few however often a hit is delivered
            first = first or r
            new.add(r["triggered_rule"])
        before = self.rules.get()
        known = set(before[0]) if before else set()
        if new <= known:
            return iter(())
        both = sorted(known | new)
        self.rules.update((both,))
        if self.keep_ms is not None and first["event_ms"] is not None:
            self.handle.registerTimer(max(first["event_ms"] + self.keep_ms, timerValues.getCurrentWatermarkInMs() + 1))
        return iter([Row(*CHANGES.names)(key[0], *[first[c] for c in TXN_COLS], both, len(both))])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.rules.clear()
        return iter(())

    def close(self) -> None:
        pass


def rule_set_changes(hits: DataFrame, keep: str | None = "1 day", watermark: str = VELOCITY_WATERMARK) -> DataFrame:
    """Changes of the rule sets in a stream of hits (``HIT_COLS``). The version is the set's size: it only grows."""
    timed = hits.withColumn("_et", event_time("transaction_time")).withColumn("event_ms", F.unix_millis("_et")).withColumn(_KEY, change_key())
    keep_ms = None if keep is None else interval_micros(keep) // 1000
    if keep_ms is not None:
        timed = timed.withWatermark("_et", watermark)
    mode = "None" if keep_ms is None else "EventTime"
    return timed.groupBy(_KEY).transformWithState(RuleSets(keep_ms), outputStructType=CHANGES, outputMode="Append", timeMode=mode)


def latest(changes: DataFrame) -> DataFrame:
    """The consolidated table: the row with the highest version of each key, by a grouped maximum."""
    row = F.struct(*TXN_COLS, "triggered_rules")
    return changes.groupBy(_KEY).agg(F.max_by(row, "version").alias("_r")).select("_r.*")
