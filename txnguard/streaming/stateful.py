"""Custom stateful streaming rules: D1–D5 on a stream.

Spark has no streaming ``lag`` or running window, so these rules keep state with
``transformWithState`` (RocksDB state store, typed state fields). Every access to the
state and every timer is a call from Python to the JVM, so the state belongs to a
*bucket* of users (``BUCKETS`` of them, by a hash of the user) and a call serves all
users of a bucket:

* rows wait in a map state under (slot, number): a slot is a minute of event time,
  a number a chunk of at most ``CHUNK`` rows of it. An event-time timer per slot
  releases that slot alone, each user's rows in (event time, transaction_id) order,
  once the watermark has passed it. Arrival order does not change the answer, which
  equals the batch rule, and a call never holds more than one slot of one bucket,
  however many rows a micro-batch brings;
* a small *carry* per user holds what the rule needs of the rows released so far
  (D1: count and sum of amounts; D2: event times of the last window; D3: last
  time and location; D5: first sighting); a bucket's carries are one value. D4 keeps
  the (user, device) pairs seen in a map state of ``SEGMENTS`` entries by their hash,
  of which a slot reads and writes those that its pairs fall in;
* carries that can no longer matter (D2, D3) are dropped, at a slot's release or by a
  timer.

The key is the user's bucket alone. It does not depend on any setting, so a checkpoint
can be restarted under other ones; the number of state partitions is fixed in
the checkpoint by Spark. Rows later than the watermark are dropped by Spark
before they reach the state (the usual streaming contract).
"""

from __future__ import annotations

import zlib
from collections import namedtuple
from collections.abc import Callable, Iterator
from itertools import groupby

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from txnguard.functions.columns import event_time, interval_micros
from txnguard.schemas import HIGH_AMOUNT_THRESHOLD, SILVER_SCHEMA, TXN_COLS, VELOCITY_WATERMARK

_UK = "_ukey"  # bucket of the user
_NULL = "\x00null"
PENDING = T.StructType(list(SILVER_SCHEMA.fields) + [T.StructField("event_us", T.LongType())])
ROW_COLS = [f.name for f in PENDING.fields]
PendingRow = namedtuple("PendingRow", ROW_COLS)
CARRY = T.StructType(
    [
        T.StructField("n", T.LongType()),            # D1 count of amounts
        T.StructField("total", T.DoubleType()),      # D1 sum of amounts
        T.StructField("last_us", T.LongType()),      # D3 last event time
        T.StructField("last_loc", T.StringType()),   # D3 last location
        T.StructField("first_us", T.LongType()),     # D5 first sighting
        T.StructField("recent", T.ArrayType(T.LongType())),  # D2 event times within the window
    ]
)
CARRIES = T.StructType([T.StructField("users", T.ArrayType(T.StructType([T.StructField("user_id", T.StringType())] + CARRY.fields)))])
EMPTY = {"n": 0, "total": 0.0, "last_us": None, "last_loc": None, "first_us": None, "recent": []}

# rule(rows of one user in order, carry, seen) -> (hits with the rule's own values; microseconds after
# which the carry no longer matters, or None); ``seen(device)`` is True from a device's second time on
Rule = Callable[[list[PendingRow], dict, Callable[[str], bool]], tuple[list[tuple[PendingRow, tuple]], int | None]]


BUCKETS = 1024  # groups of users; fixed, as it is part of every checkpoint
SEGMENTS = 64  # entries that hold a bucket's (user, device) pairs; fixed too
CHUNK = 512  # rows of a state entry, which is read and written as a whole
SLOT_MS = 60_000  # event time that is released at once
_OPEN = 4096  # rows that a call holds before it writes them to the state

_SLOT = T.StructType([T.StructField("slot", T.LongType())])
_SLOT_CHUNK = T.StructType([T.StructField("slot", T.LongType()), T.StructField("number", T.IntegerType())])


class UserRule(StatefulProcessor):
    """Buffers the rows of a bucket's users by slots until the watermark passes them, then runs ``rule`` over one slot
    after the other, user by user. Rows begin with ``ROW_COLS``."""

    def __init__(self, rule: Rule, names: list[str], slot_ms: int = SLOT_MS):
        self.rule, self.names, self.slot_ms = rule, names, slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", _SLOT_CHUNK, T.StructType([T.StructField("rows", T.ArrayType(PENDING))]))
        self.numbers = handle.getMapState("numbers", _SLOT, T.StructType([T.StructField("n", T.IntegerType())]))
        self.carry = handle.getValueState("carry", CARRIES)
        self.devices = handle.getMapState("devices", T.StructType([T.StructField("segment", T.IntegerType())]), T.StructType([T.StructField("pairs", T.ArrayType(T.StringType()))]))

    def _slot_end(self, slot: int) -> int:
        return (slot + 1) * self.slot_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held: dict[int, list[tuple]] = {}
        numbers: dict[int, int] = {}
        open_rows, width, slot_us = 0, len(ROW_COLS), 1000 * self.slot_ms

        def write(slot: int) -> None:
            nonlocal open_rows
            own = held.pop(slot)
            if slot not in numbers:
                before = self.numbers.getValue((slot,))
                numbers[slot] = before[0] if before else 0
                if not before:
                    self.handle.registerTimer(self._slot_end(slot))
            self.chunks.updateValue((slot, numbers[slot]), (own,))
            numbers[slot] += 1
            open_rows -= len(own)

        for r in rows:
            row = tuple(r)[:width]
            slot = row[-1] // slot_us
            held.setdefault(slot, []).append(row)
            open_rows += 1
            if len(held[slot]) >= CHUNK:
                write(slot)
            elif open_rows >= _OPEN:
                write(max(held, key=lambda s: len(held[s])))
        for slot in list(held):
            write(slot)
        for slot, n in numbers.items():
            self.numbers.updateValue((slot,), (n,))
        return iter(())

    def _taken(self, slot: int) -> dict[str | None, list[PendingRow]]:
        """The rows of a slot by user, each user's in order; they leave the state."""
        n = self.numbers.getValue((slot,))
        if not n:
            return {}
        users: dict[str | None, list[PendingRow]] = {}
        for number in range(n[0]):
            for r in self.chunks.getValue((slot, number))[0]:
                row = PendingRow._make(r)
                users.setdefault(row.user_id, []).append(row)
            self.chunks.removeKey((slot, number))
        self.numbers.removeKey((slot,))
        for rows in users.values():
            rows.sort(key=lambda r: (r.event_us, r.transaction_id is not None, r.transaction_id or ""))
        return users

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        ready = self._taken(at // self.slot_ms - 1)
        before = self.carry.get()
        carries = {user: values for user, *values in before[0]} if before else {}
        out, found, until, pairs = Row(*self.names), [], None, {}
        for user, rows in ready.items():
            carry = dict(zip(CARRY.names, carries[user])) if user in carries else dict(EMPTY)
            carry["recent"] = list(carry["recent"] or [])
            hits, keep_until = self.rule(rows, carry, lambda device, user=user: self._seen(pairs, user, device))
            carries[user] = [carry[c] for c in CARRY.names]
            if keep_until is not None:
                until = keep_until if until is None else max(until, keep_until)
            found += [out(*r[: len(TXN_COLS)], *extra) for r, extra in hits]
        for segment, (own, known) in pairs.items():
            if len(own) > known:
                self.devices.updateValue((segment,), (sorted(own),))
        kept = [(user, *values) for user, values in carries.items() if not self._expired(values, at * 1000)]
        if kept and (ready or len(kept) < len(before[0])):
            self.carry.update((kept,))
        elif before and not kept:
            self.carry.clear()
        if until is not None:  # at a slot's end too, where a timer may stand already
            self.handle.registerTimer(self._slot_end(until // (1000 * self.slot_ms)))
        return iter(found)

    def _expired(self, carry: list, passed: int) -> bool:
        """Whether nothing that may still come can need the carry: every rule that drops it keeps its latest event time."""
        last = carry[CARRY.names.index("last_us")]
        return last is not None and self.rule.keeps is not None and last + self.rule.keeps < passed

    def _seen(self, pairs: dict[int, tuple[set[str], int]], user: str | None, device: str | None) -> bool:
        """Whether the user had the device before. ``pairs``: the segments that a call has read, and their size in the state."""
        user, device = (_NULL if x is None else x for x in (user, device))
        pair = f"{len(user)}:{user}{device}"
        segment = zlib.crc32(pair.encode()) % SEGMENTS
        if segment not in pairs:
            own = self.devices.getValue((segment,))
            pairs[segment] = (set(own[0]), len(own[0])) if own else (set(), 0)
        own = pairs[segment][0]
        if pair in own:
            return True
        own.add(pair)
        return False

    def close(self) -> None:
        pass


def _run(silver: DataFrame, rule: Rule, out_schema: T.StructType, watermark: str, keeps: int | None = None) -> DataFrame:
    rule.keeps = keeps
    bucket = F.pmod(F.xxhash64(F.coalesce(F.col("user_id"), F.lit(_NULL))), F.lit(BUCKETS))
    rows = (
        silver.withColumn("_et", event_time("transaction_time"))
        .filter(F.col("_et").isNotNull())
        .withColumn("event_us", F.unix_micros("_et"))
        .select(*ROW_COLS, bucket.alias(_UK), "_et")
        .withWatermark("_et", watermark)
    )
    return rows.groupBy(_UK).transformWithState(
        UserRule(rule, out_schema.names), outputStructType=out_schema, outputMode="Append", timeMode="EventTime"
    )


def _schema_plus(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(list(SILVER_SCHEMA.fields) + [T.StructField(n, t) for n, t in fields])


# --- D1 -----------------------------------------------------------------------------

AVG_SCHEMA = _schema_plus(("prior_n", T.LongType()), ("prior_avg", T.DoubleType()))


def amount_vs_history_stream(silver: DataFrame, factor: float = 3.0, watermark: str = VELOCITY_WATERMARK) -> DataFrame:
    """D1 on a stream: amount > factor × mean of the user's earlier amounts."""

    def rule(rows, carry, seen):
        hits = []
        for r in rows:
            amount = r.transaction_amount
            if amount is None:
                continue
            if carry["n"] and amount > factor * (carry["total"] / carry["n"]):
                hits.append((r, (carry["n"], carry["total"] / carry["n"])))
            carry["n"], carry["total"] = carry["n"] + 1, carry["total"] + amount
        return hits, None

    return _run(silver, rule, AVG_SCHEMA, watermark)


# --- D2 -----------------------------------------------------------------------------

ROLLING_SCHEMA = _schema_plus(("rolling_count", T.LongType()))


def rolling_velocity_stream(
    silver: DataFrame, window: str = "60 seconds", min_exclusive: int = 5, watermark: str = VELOCITY_WATERMARK
) -> DataFrame:
    """D2 on a stream: more than ``min_exclusive`` of the user's transactions
    in ``(t - window, t]``, evaluated at every transaction."""
    w_us = interval_micros(window)

    def rule(rows, carry, seen):
        hits, recent = [], carry["recent"]
        for t, peers in groupby(rows, key=lambda r: r.event_us):
            peers = list(peers)
            recent = [x for x in recent if x > t - w_us] + [t] * len(peers)
            if len(recent) > min_exclusive:
                hits += [(r, (len(recent),)) for r in peers]
        carry["recent"], carry["last_us"] = recent, rows[-1].event_us
        return hits, rows[-1].event_us + w_us

    return _run(silver, rule, ROLLING_SCHEMA, watermark, keeps=w_us)


# --- D3 -----------------------------------------------------------------------------

JUMP_SCHEMA = _schema_plus(("prev_location", T.StringType()), ("gap_seconds", T.DoubleType()))


def location_jump_stream(silver: DataFrame, max_gap: str = "5 minutes", watermark: str = VELOCITY_WATERMARK) -> DataFrame:
    """D3 on a stream: flagged rows with prev_location and gap. The previous row
    counts even if its location is NULL; it then gives no jump."""
    g_us = interval_micros(max_gap)

    def rule(rows, carry, seen):
        hits = []
        for r in rows:
            gap = None if carry["last_us"] is None else r.event_us - carry["last_us"]
            before = carry["last_loc"]
            if gap is not None and gap < g_us and before is not None and r.location is not None and r.location != before:
                hits.append((r, (before, gap / 1e6)))
            carry["last_us"], carry["last_loc"] = r.event_us, r.location
        return hits, carry["last_us"] + g_us

    return _run(silver, rule, JUMP_SCHEMA, watermark, keeps=g_us)


# --- D4 -----------------------------------------------------------------------------


def new_device_stream(
    silver: DataFrame, threshold: float = HIGH_AMOUNT_THRESHOLD, watermark: str = VELOCITY_WATERMARK
) -> DataFrame:
    """D4 on a stream: first (user, device) sighting with amount > threshold."""

    def rule(rows, carry, seen):
        return [(r, ()) for r in rows if not seen(r.device_id) and r.transaction_amount is not None and r.transaction_amount > threshold], None

    return _run(silver, rule, SILVER_SCHEMA, watermark)


# --- D5 -----------------------------------------------------------------------------

AGE_SCHEMA = _schema_plus(("account_age_seconds", T.DoubleType()))


def young_account_stream(
    silver: DataFrame, max_age: str = "7 days", threshold: float = HIGH_AMOUNT_THRESHOLD, watermark: str = VELOCITY_WATERMARK
) -> DataFrame:
    """D5 on a stream: amount above threshold within max_age of first sighting.
    The first sighting is kept for the user's lifetime."""
    age_us = interval_micros(max_age)

    def rule(rows, carry, seen):
        if carry["first_us"] is None:
            carry["first_us"] = rows[0].event_us
        ages = [(r, r.event_us - carry["first_us"]) for r in rows]
        return [(r, (age / 1e6,)) for r, age in ages if age < age_us and r.transaction_amount is not None and r.transaction_amount > threshold], None

    return _run(silver, rule, AGE_SCHEMA, watermark)
