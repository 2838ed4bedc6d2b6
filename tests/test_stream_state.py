"""Stateful stream parts: what a call holds, late rows, changes of rule sets, panes."""

from __future__ import annotations

import datetime as dt
import random
from types import SimpleNamespace

from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import silver_df, txn
from txnguard.operators import rules as R
from txnguard.streaming import changes as CH
from txnguard.streaming import late as L
from txnguard.streaming import panes as PA
from txnguard.streaming import stateful as ST


class FakeValue:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def exists(self):
        return self.value is not None


class FakeMap:
    def __init__(self):
        self.data, self.most = {}, 0

    def getValue(self, key):
        v = self.data.get(key)
        if v is not None and isinstance(v[0], list):
            self.most = max(self.most, len(v[0]))
        return v

    def updateValue(self, key, value):
        if isinstance(value[0], list):
            self.most = max(self.most, len(value[0]))
        self.data[key] = value

    def containsKey(self, key):
        return key in self.data

    def removeKey(self, key):
        del self.data[key]


class FakeHandle:
    def __init__(self):
        self.timers, self.states = set(), {}

    def getMapState(self, name, *_):
        return self.states.setdefault(name, FakeMap())

    def getValueState(self, name, *_):
        return self.states.setdefault(name, FakeValue())

    def registerTimer(self, at):
        self.timers.add(at)


def fire(processor, handle, key, watermark_ms):
    out = []
    while handle.timers and min(handle.timers) <= watermark_ms:
        at = min(handle.timers)
        handle.timers.remove(at)
        values = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark_ms)
        out += list(processor.handleExpiredTimer(key, values, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at)))
    return out


def test_a_hot_user_is_released_slot_by_slot_and_never_held_whole():
    seen = []

    def rule(rows, carry, seen_device):
        seen.append([r.event_us for r in rows])
        return [(r, ()) for r in rows], None

    rule.keeps = None
    processor, handle = ST.UserRule(rule, ST.TXN_COLS), FakeHandle()
    processor.init(handle)
    rng = random.Random(1)
    minutes, per_minute = 40, 700
    rows = [Row(*ST.ROW_COLS)(*txn(f"t{m}-{i}"), m * 60_000_000 + rng.randrange(60_000_000)) for m in range(minutes) for i in range(per_minute)]
    rng.shuffle(rows)
    for lo in range(0, len(rows), 10_000):  # a micro-batch far larger than a slot
        list(processor.handleInputRows(("u",), iter(rows[lo : lo + 10_000]), None))
    assert handle.states["chunks"].most <= ST.CHUNK
    early = fire(processor, handle, ("u",), 20 * 60_000)
    assert len(early) == 20 * per_minute and max(map(len, seen)) == per_minute
    late = fire(processor, handle, ("u",), 10**12)
    assert [x for own in seen for x in own] == sorted(r.event_us for r in rows)
    assert len(early) + len(late) == len(rows) and not handle.states["chunks"].data and not handle.states["numbers"].data


def test_rows_of_one_slot_come_in_order_over_chunks_and_the_carry_expires():
    def rule(rows, carry, seen_device):
        carry["last_us"] = rows[-1].event_us
        return [(r, ()) for r in rows], rows[-1].event_us + 60_000_000

    rule.keeps = 60_000_000
    processor, handle = ST.UserRule(rule, ST.TXN_COLS), FakeHandle()
    processor.init(handle)
    rows = [Row(*ST.ROW_COLS)(*txn(f"t{i:05d}"), 5_000_000) for i in range(3 * ST.CHUNK)]
    random.Random(2).shuffle(rows)
    list(processor.handleInputRows(("u",), iter(rows), None))
    out = fire(processor, handle, ("u",), 60_000)
    assert [r.transaction_id for r in out] == sorted(r.transaction_id for r in rows)
    assert handle.states["carry"].exists()
    assert fire(processor, handle, ("u",), 600_000) == [] and not handle.states["carry"].exists()


def test_panes_give_every_sliding_window_once():
    rng = random.Random(3)
    size, slide = 60, 10
    for _ in range(200):
        times = sorted(rng.randrange(400) for _ in range(rng.randrange(1, 40)))
        want = {e: n for e in range(slide, 400 + size + 1, slide) if (n := sum(e - size <= t < e for t in times))}
        panes, done, got = {}, None, {}
        for t in times:
            panes[t // slide * slide] = panes.get(t // slide * slide, 0) + 1
        for passed in (rng.randrange(500), 10_000):
            found = PA.closed_windows(panes, done, passed, size, slide)
            assert not got.keys() & {e for e, _ in found} and all(e <= passed for e, _ in found)
            got |= dict(found)
            done = passed - passed % slide
            panes = {p: n for p, n in panes.items() if p + size > done}
        assert got == want and not panes


def test_rule_sets_emit_only_growth():
    processor, handle = CH.RuleSets(1000), FakeHandle()
    processor.init(handle)
    values = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    hit = lambda rule: Row(*CH.TXN_COLS, "triggered_rule", "event_ms")(*txn("t"), rule, 5000)
    send = lambda *rules: [(r.triggered_rules, r.version) for r in processor.handleInputRows(("k",), iter([hit(x) for x in rules]), values)]
    assert send("B", "B") == [(["B"], 1)] and send("B") == [] and send("A", "B") == [(["A", "B"], 2)]
    fire(processor, handle, ("k",), 10_000)
    assert not handle.states["rules"].exists()


def test_latest_change_wins_and_keys_tell_nulls_apart(spark):
    rows = [txn("t1"), txn("t1", device=None), txn("t1", device="null"), txn(None)]
    keyed = silver_df(spark, rows).withColumn("change_key", CH.change_key())
    assert keyed.select("change_key").distinct().count() == 4
    changes = keyed.select("change_key", *CH.TXN_COLS, F.array(F.lit("A")).alias("triggered_rules"), F.lit(1).alias("version"))
    grown = changes.limit(1).withColumns({"triggered_rules": F.array(F.lit("A"), F.lit("B")), "version": F.lit(2)})
    out = CH.latest(changes.unionByName(grown).unionByName(grown)).collect()
    assert len(out) == 4 and sorted(len(r.triggered_rules) for r in out) == [1, 1, 1, 2]


def test_routing_is_idempotent_and_alerts_are_repaired(spark, scratch):
    first = [txn(f"a{i}", user="u1", time="2024-01-01T10:00:10") for i in range(5)] + [txn("z", user="u2", time="2024-01-01T10:09:00"), txn("x", time="bad")]
    second = [txn("late1", user="u1", time="2024-01-01T10:00:20"), txn("on-time", user="u1", time="2024-01-01T10:08:59"), txn("late2", user=None, time="2024-01-01T10:01:00"), txn("y", time=None)]
    for batch_id, rows in ((0, first), (1, second), (1, second)):
        L.route(silver_df(spark, rows), batch_id, scratch)
    assert sorted(r.transaction_id for r in L.routed(spark, scratch, late=True).collect()) == ["late1", "late2"]
    assert L.routed(spark, scratch).count() == len(first) + len(second)
    high = dt.datetime(2024, 1, 1, 10, 9, tzinfo=dt.timezone.utc).timestamp() * 1e6
    assert (L.mark_before(spark, scratch, 0), L.mark_before(spark, scratch, 1)) == (None, high)
    on_time = R.velocity_gold(L.routed(spark, scratch, late=False))
    assert on_time.count() == 0  # five rows: no alert without the late one
    other = spark.createDataFrame([(None, (dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 9, 1)), 8, "velocity")], on_time.schema)
    out = L.repaired(on_time.unionByName(other), L.routed(spark, scratch), L.routed(spark, scratch, late=True)).collect()
    assert sorted((r.user_id or "", r["count"]) for r in out) == [("", 8), ("u1", 6)]


def test_users_of_a_bucket_share_state_calls_and_keep_their_own_carry():
    """500 users in a slot cost the calls of one; each user's carry and devices stay apart."""
    def rule(rows, carry, seen):
        before, carry["n"] = carry["n"], carry["n"] + len(rows)
        return [(r, (before, seen(r.device_id))) for r in rows], None

    rule.keeps = None
    processor, handle = ST.UserRule(rule, [*ST.TXN_COLS, "before", "seen"]), FakeHandle()
    processor.init(handle)
    users = [None, "", "\x00nul", *(f"u{i}" for i in range(497))]
    rows = [Row(*ST.ROW_COLS)(*txn(f"{s}-{u}", user=u, device=f"d{s % 2}"), s * 60_000_000) for s in range(3) for u in users]
    random.Random(4).shuffle(rows)
    list(processor.handleInputRows((7,), iter(rows), None))
    calls = 0

    def counted(method):
        def call(*args):
            nonlocal calls
            calls += 1
            return method(*args)
        return call

    for state in handle.states.values():
        for name in ("get", "update", "getValue", "updateValue", "containsKey", "removeKey"):
            if hasattr(state, name):
                setattr(state, name, counted(getattr(state, name)))
    out = fire(processor, handle, (7,), 10**9)
    assert len(out) == len(rows) and calls <= 3 * (2 * ST.SEGMENTS + 10)
    found = sorted((int(r.transaction_id[0]), r.before, r.seen) for r in out)
    assert found == [(s, s, s == 2) for s in range(3) for _ in users]
