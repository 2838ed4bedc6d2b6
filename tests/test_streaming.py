"""Structured Streaming: layers, watermark semantics, restart, stream = batch
(SURVEY §2.8, G12–G15; §5 items 3 and 4)."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest


from conftest import SF_SMALL, silver_df, txn
from txnguard.operators import ingest as I
from txnguard.operators import rules as R
from txnguard.sources import lake
from txnguard.sources.tables import read_transactions
from txnguard.streaming import jobs as J
from txnguard.streaming import replay as RP

AVAILABLE_NOW = {"availableNow": True}


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_velocity_with_flush_equals_batch(spark):
    # Append mode holds back the newest windows until the watermark passes
    batch = R.velocity_gold(read_transactions(spark, SF_SMALL))
    streamed = RP.stream_velocity(spark, SF_SMALL)
    assert batch.count() == 14
    assert _same(streamed.select(*batch.columns), batch)

    no_flush = RP.run_to_table(R.velocity_gold(RP.silver_stream(spark, SF_SMALL)), spark, "vel_noflush")
    assert no_flush.count() < 14


def test_stream_layers_equal_batch(spark):
    silver = read_transactions(spark, SF_SMALL)
    assert _same(RP.stream_silver(spark, SF_SMALL), silver)
    assert _same(RP.stream_high_amount(spark, SF_SMALL), R.high_amount_gold(silver))


def test_update_mode_final_counts_equal_batch(spark):
    batch = R.velocity_gold(read_transactions(spark, SF_SMALL))
    upd = RP.stream_velocity_update(spark, SF_SMALL)
    assert _same(upd.select(*batch.columns), batch)


def _write_silver_file(spark, path, rows, idx):
    # append one part file straight into the source folder (idx documents order)
    silver_df(spark, rows).coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)  # distinct modification times keep file order stable


def _run_velocity(spark, src, out, ckpt):
    silver = lake.read_silver_stream(spark, src, max_files_per_trigger=1)
    q = J.write_stream(R.velocity_gold(silver), ckpt, out, trigger=AVAILABLE_NOW)
    J.drain([q])
    return q


def test_watermark_emission_and_late_drop_across_runs(spark, scratch):
    src, out, ckpt = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt"
    f1 = [txn(f"u1-{i}", user="u1", time="2024-01-01T10:00:10") for i in range(6)]
    f1 += [txn(f"u2-{i}", user="u2", time="2024-01-01T10:00:20") for i in range(5)]
    f1 += [txn("bad", user="u9", time="garbage"), txn("null", user="u9", time=None)]
    _write_silver_file(spark, src, f1, 1)
    _run_velocity(spark, src, out, ckpt)
    assert spark.read.parquet(out).count() == 0  # G12: nothing closed yet

    _write_silver_file(spark, src, [txn("u3-a", user="u3", time="2024-01-01T10:03:00")], 2)
    _run_velocity(spark, src, out, ckpt)
    rows = spark.read.parquet(out).collect()
    assert [(r.user_id, r["count"]) for r in rows] == [("u1", 6)]  # watermark 10:01:00 closes [10:00,10:01)

    # a new run: nine late rows for u2's closed window are dropped
    _write_silver_file(spark, src, [txn(f"u2-late-{i}", user="u2", time="2024-01-01T10:00:30")
                                    for i in range(9)], 3)
    q = _run_velocity(spark, src, out, ckpt)
    dropped = sum(
        op.get("numRowsDroppedByWatermark", 0)
        for p in q.recentProgress for op in p["stateOperators"]
    )
    assert dropped >= 1  # G15: counted after partial aggregation, not per event
    _write_silver_file(spark, src, [txn("u3-b", user="u3", time="2024-01-01T10:10:00")], 4)
    _run_velocity(spark, src, out, ckpt)
    rows = spark.read.parquet(out).collect()
    assert sorted((r.user_id, r["count"]) for r in rows) == [("u1", 6)]  # written once, u2 never


def _json_line(tid, user, amount, t, intl):
    return json.dumps({"transaction_id": tid, "user_id": user, "merchant_id": "amazon",
                       "transaction_amount": amount, "transaction_time": t, "device_id": "device_1",
                       "location": "India", "is_international": intl})


def _write_text(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.tmp", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    os.replace(f"{path}/{name}.tmp", f"{path}/{name}.txt")


def test_bronze_silver_restart_no_loss_no_duplicates(spark, scratch):
    raw_dir, bronze, silver, ckpt = f"{scratch}/raw", f"{scratch}/bronze", f"{scratch}/silver", f"{scratch}/ck"
    for k in range(3):
        _write_text(raw_dir, f"part{k}", [_json_line(f"t{k}-{i}", "u", 10.0, "2024-01-01T10:00:00", False)
                                          for i in range(4)])

    def run():
        J.drain([J.start_bronze(lake.read_text_stream(spark, raw_dir, 1), bronze, ckpt, AVAILABLE_NOW)])
        J.drain([J.start_silver(spark, bronze, silver, ckpt, AVAILABLE_NOW)])

    run()
    assert spark.read.parquet(silver).count() == 12
    for k in range(3, 5):
        _write_text(raw_dir, f"part{k}", [_json_line(f"t{k}-{i}", "u", 10.0, "2024-01-01T10:00:00", False)
                                          for i in range(4)])
    run()  # restart on the same checkpoints
    s = spark.read.parquet(silver)
    assert s.count() == 20 and s.select("transaction_id").distinct().count() == 20
    assert spark.read.parquet(bronze).count() == 20


def test_detect_from_text_stream(spark, scratch):
    raw_dir = f"{scratch}/raw"
    lines = [_json_line(f"b{i}", "burst", 10.0, f"2024-01-01T10:00:0{i}", False) for i in range(6)]
    lines += [_json_line("big", "rich", 50000.0, "2024-01-01T10:00:00", True),
              _json_line("flush", "zz", 1.0, "2099-01-01T00:00:00", False), "not json"]
    _write_text(raw_dir, "batch", lines)
    high, vel = J.detect(lake.read_text_stream(spark, raw_dir))
    h = RP.run_to_table(high, spark, "detect_high")
    v = RP.run_to_table(vel, spark, "detect_vel")
    assert [r.transaction_id for r in h.collect()] == ["big"]
    assert [(r.user_id, r["count"]) for r in v.collect()] == [("burst", 6)]


def test_update_mode_shows_open_windows(spark, scratch):
    src = f"{scratch}/in"
    _write_silver_file(spark, src, [txn(f"x{i}", user="x", time="2024-01-01T10:00:00") for i in range(7)], 1)
    silver = lake.read_silver_stream(spark, src)
    got = RP.run_updates(R.velocity_gold(silver), spark, "upd_open", ["user_id", "window"]).collect()
    assert [(r.user_id, r["count"]) for r in got] == [("x", 7)]  # emitted although still open


def test_await_any_stops_all(spark, scratch):
    src = f"{scratch}/in"
    _write_silver_file(spark, src, [txn("a")], 1)
    silver = lake.read_silver_stream(spark, src)
    qs = J.start_gold(spark, src, f"{scratch}/gold", f"{scratch}/ck", trigger=AVAILABLE_NOW)
    J.await_any(spark, qs)
    for q in qs:
        q.awaitTermination()
    assert all(not q.isActive for q in qs)
    assert silver.isStreaming


def test_rules_run_unchanged_on_stream_and_batch(spark, scratch):
    src = f"{scratch}/in"
    rows = [txn(f"v{i}", user="u", time=f"2024-01-01T10:00:0{i}", amount=25000.0, intl=True) for i in range(6)]
    rows.append(txn("flush", user="zz", time="2099-01-01T00:00:00"))
    _write_silver_file(spark, src, rows, 1)
    stream = lake.read_silver_stream(spark, src)
    batch = silver_df(spark, rows)
    for rule in (R.high_amount_gold, R.velocity_gold):
        s = RP.run_to_table(rule(stream), spark, f"same_{rule.__name__}")
        assert _same(s.select(*rule(batch).columns), rule(batch))


def test_ingestion_time_constant_within_batch(spark, scratch):
    raw_dir = f"{scratch}/raw"
    _write_text(raw_dir, "one", [_json_line(f"c{i}", "u", 1.0, "2024-01-01T10:00:00", False) for i in range(5)])
    out = RP.run_to_table(I.to_bronze(lake.read_text_stream(spark, raw_dir)), spark, "ingest_ts")
    assert out.select("ingestion_time").distinct().count() == 1
    assert isinstance(out.first().ingestion_time, dt.datetime)


def test_streaming_consolidation_equals_batch_and_evicts_state(spark):
    # Expansion streams to hit tables, grouping happens in batch
    from txnguard.operators import consolidate as C
    from txnguard.streaming import consolidate as SC

    out, qs = SC.consolidate_stream(spark, RP.silver_stream(spark, SF_SMALL, flush=True))
    out = out.filter(out.user_id != RP.SENTINEL_USER)
    silver = read_transactions(spark, SF_SMALL)
    batch = C.consolidate(R.high_amount(silver), R.velocity(silver), silver)
    assert out.count() == 93 and _same(out, batch)
    last = qs[1].lastProgress
    join_state = [o for o in last["stateOperators"] if o["operatorName"] == "symmetricHashJoin"]
    assert join_state and join_state[0]["numRowsTotal"] < 10  # silver rows evicted past the watermark


def test_stateful_location_jump_equals_batch(spark):
    from txnguard.operators import behaviour as B
    from txnguard.streaming import stateful as ST

    rule = ST.location_jump_stream(RP.silver_stream(spark, SF_SMALL, flush=True), max_gap="10 seconds")
    out = RP.run_to_table(rule, spark, "ljump_test")
    batch = B.location_jump(read_transactions(spark, SF_SMALL), max_gap="10 seconds").select(*out.columns)
    assert out.count() == 149 and _same(out, batch)


def test_stateful_location_jump_out_of_order_arrival(spark, scratch):
    from txnguard.streaming import stateful as ST

    src = f"{scratch}/in"
    # later row arrives first; the answer must follow event time, not arrival
    _write_silver_file(spark, src, [txn("b", location="USA", time="2024-01-01T10:00:05")], 1)
    _write_silver_file(spark, src, [txn("a", location="India", time="2024-01-01T10:00:00")], 2)
    _write_silver_file(spark, src, [txn("z", user="zz", time="2099-01-01T00:00:00")], 3)
    silver = lake.read_silver_stream(spark, src, max_files_per_trigger=1)
    out = RP.run_to_table(ST.location_jump_stream(silver, max_gap="10 seconds"), spark, "ljump_ooo")
    rows = out.collect()
    assert [(r.transaction_id, r.prev_location) for r in rows] == [("b", "India")]


def test_stateful_amount_and_device_rules_equal_batch(spark):
    from txnguard.operators import behaviour as B
    from txnguard.streaming import stateful as ST

    silver = read_transactions(spark, SF_SMALL)
    for stream_rule, batch_rule, n in [(ST.amount_vs_history_stream, B.amount_vs_history, 48),
                                      (ST.new_device_stream, B.new_device, 9)]:
        out = RP.run_to_table(stream_rule(RP.silver_stream(spark, SF_SMALL, flush=True)), spark,
                              f"st_{stream_rule.__name__}")
        assert out.count() == n and _same(out, batch_rule(silver).select(*out.columns))


def test_stateful_young_account_equals_batch(spark):
    from txnguard.operators import behaviour as B
    from txnguard.streaming import stateful as ST

    out = RP.run_to_table(ST.young_account_stream(RP.silver_stream(spark, SF_SMALL, flush=True),
                                                  max_age="7 minutes"), spark, "st_young")
    batch = B.young_account(read_transactions(spark, SF_SMALL), max_age="7 minutes").select(*out.columns)
    assert out.count() == 5 and _same(out, batch)


def test_sink_folder_reads_only_committed_files(spark, scratch):
    # A Spark sink folder is read through its _spark_metadata log
    src, out = f"{scratch}/in", f"{scratch}/out"
    _write_silver_file(spark, src, [txn("a"), txn("b")], 1)
    J.drain([J.write_stream(lake.read_silver_stream(spark, src), f"{scratch}/ck", out, trigger=AVAILABLE_NOW)])
    silver_df(spark, [txn("stray")]).coalesce(1).write.mode("append").parquet(out)  # not in the log
    assert sorted(r.transaction_id for r in spark.read.parquet(out).collect()) == ["a", "b"]
    assert sorted(r.transaction_id for r in lake.read_silver_stream(spark, out).transform(
        lambda d: RP.run_to_table(d, spark, "g16")).collect()) == ["a", "b"]


def test_dedup_within_watermark_on_stream(spark, scratch):
    src = f"{scratch}/in"
    _write_silver_file(spark, src, [txn("a"), txn("b")], 1)
    _write_silver_file(spark, src, [txn("a", ingested=dt.datetime(2024, 1, 1, 10, 2))], 2)
    out = RP.run_to_table(I.dedup_stream(lake.read_silver_stream(spark, src, 1)), spark, "dedup_stream")
    assert sorted(r.transaction_id for r in out.collect()) == ["a", "b"]


def test_layered_streams_then_batch_consolidation(spark, scratch):
    """text → bronze → silver → gold as streams (date-partitioned sinks), then
    the batch consolidation job over the gold tables: same 93 rows as batch."""
    from pyspark.sql import functions as F

    from txnguard.operators import consolidate as C
    from txnguard.plans import jobs
    from txnguard.schemas import TXN_COLS

    silver_ref = read_transactions(spark, SF_SMALL)
    raw = f"{scratch}/raw"
    I.to_wire_json(silver_ref).select("value").coalesce(2).write.text(raw)
    # one folder, one sink per layer: file sinks sharing a folder share its commit log
    _write_text(raw, "zz_flush", [_json_line("flush", "zz", 1.0, "2099-01-01T00:00:00", False)])
    bronze, silver, gold, ck = f"{scratch}/bronze", f"{scratch}/silver", f"{scratch}/gold", f"{scratch}/ck"
    J.drain([J.start_bronze(lake.read_text_stream(spark, raw), bronze, ck, AVAILABLE_NOW)])
    J.drain([J.start_silver(spark, bronze, silver, ck, AVAILABLE_NOW)])
    J.drain(J.start_gold(spark, silver, gold, f"{ck}/g", AVAILABLE_NOW, max_files_per_trigger=1))
    assert spark.read.parquet(f"{gold}/velocity_fraud").count() == 14
    jobs.consolidate_gold(spark, silver, gold)
    out = spark.read.parquet(f"{gold}/fraud_union")
    expected = C.consolidate(R.high_amount(silver_ref), R.velocity(silver_ref), silver_ref)
    cols = [c for c in TXN_COLS if c != "ingestion_time"] + ["triggered_rules"]
    assert out.count() == 93
    assert _same(out.select(*cols), expected.select(*cols))
    assert out.filter(F.col("event_date").isNull()).count() == 0


def test_console_sinks_and_processing_time_trigger(spark, scratch, capfd):
    # K5 append console, K6 update console, W6 processing-time trigger
    src = f"{scratch}/in"
    _write_silver_file(spark, src, [txn(f"x{i}", user="x", amount=30000.0, intl=True,
                                        time="2024-01-01T10:00:00") for i in range(7)], 1)
    qs = J.start_gold(spark, src, f"{scratch}/gold", f"{scratch}/ck",
                      trigger={"processingTime": "1 second"}, debug_console=True)
    try:
        for q in qs:
            q.processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    assert len(qs) == 4 and all(q.exception() is None for q in qs)
    assert spark.read.parquet(f"{scratch}/gold/high_amount_fraud").count() == 7


def test_continuous_consolidation_regroups_touched_dates(spark, scratch):
    from txnguard.operators import consolidate as C
    from txnguard.streaming import consolidate as SC
    from txnguard.streaming.jobs import state_partitions

    silver_ref = read_transactions(spark, SF_SMALL)
    hits, out = f"{scratch}/hits", f"{scratch}/fraud_union"
    with state_partitions(spark):
        qs = SC.start_hit_streams(RP.silver_stream(spark, SF_SMALL, flush=True), hits, f"{scratch}/ck",
                                  trigger=AVAILABLE_NOW)
    J.drain(qs)
    J.drain([SC.start_consolidation(spark, hits, out, f"{scratch}/ck/cons", trigger=AVAILABLE_NOW)])
    expected = C.consolidate(R.high_amount(silver_ref), R.velocity(silver_ref), silver_ref)
    got = spark.read.parquet(out).drop("event_date")
    assert got.count() == 93 and _same(got, expected)
    # replaying every batch on a fresh checkpoint rewrites the same dates: same table
    J.drain([SC.start_consolidation(spark, hits, out, f"{scratch}/ck/cons2", trigger=AVAILABLE_NOW)])
    assert spark.read.parquet(out).count() == 93


def test_checked_silver_stream_splits_valid_and_rejected(spark, scratch):
    raw = f"{scratch}/raw"
    _write_text(raw, "a", [_json_line("ok1", "u", 10.0, "2024-01-01T10:00:00", False), "not json",
                           '{"testing_key":"testing_pair"}', _json_line("ok2", "u", 5.0, "bad time", True)])
    bronze, root = f"{scratch}/bronze", f"{scratch}/silver"
    J.drain([J.start_bronze(lake.read_text_stream(spark, raw), bronze, f"{scratch}/ck", AVAILABLE_NOW)])
    J.drain([J.start_silver_checked(spark, bronze, root, f"{scratch}/ck", AVAILABLE_NOW)])
    table = spark.read.parquet(root)
    assert [r.transaction_id for r in table.filter("_status = 'valid'").collect()] == ["ok1"]
    reasons = sorted(r.reject_reason for r in table.filter("_status = 'rejected'").collect())
    assert reasons == ["bad_transaction_time", "malformed_json", "missing_transaction_id"]


def test_stateful_rolling_velocity_equals_batch(spark):
    from txnguard.operators import behaviour as B
    from txnguard.streaming import stateful as ST

    out = RP.run_to_table(ST.rolling_velocity_stream(RP.silver_stream(spark, SF_SMALL, flush=True)),
                          spark, "st_rolling")
    batch = B.rolling_velocity(read_transactions(spark, SF_SMALL)).select(*out.columns)
    assert out.count() == 73 and _same(out, batch)


def test_regroup_with_an_empty_hit_sink(spark, scratch):
    # no high-amount hit yet: its sink folder exists without data files
    from txnguard.streaming import consolidate as SC
    from txnguard.streaming.jobs import state_partitions

    src = f"{scratch}/in"
    rows = [txn(f"v{i}", user="u", time=f"2024-01-01T10:00:0{i}") for i in range(6)]
    rows.append(txn("flush", user="zz", time="2099-01-01T00:00:00"))
    _write_silver_file(spark, src, rows, 1)
    hits, out = f"{scratch}/hits", f"{scratch}/union"
    with state_partitions(spark):
        J.drain(SC.start_hit_streams(lake.read_silver_stream(spark, src), hits, f"{scratch}/ck",
                                     trigger=AVAILABLE_NOW))
    J.drain([SC.start_consolidation(spark, hits, out, f"{scratch}/ck/cons", trigger=AVAILABLE_NOW)])
    got = spark.read.parquet(out)
    assert got.count() == 6 and {tuple(r.triggered_rules) for r in got.collect()} == {("HIGH_VELOCITY",)}


AVAILABLE = {"availableNow": True}


def _slices(spark, path, groups):
    """Each group of rows as one file, in order, and a far-future row last."""
    for rows in [*groups, [txn("end", user="__end__", time="2099-01-01T00:00:00")]]:
        silver_df(spark, rows).coalesce(1).write.mode("append").parquet(path)


def _many_batches(users=6, hours=4):
    """Per file one hour later; a new user in every file; one NULL location in between."""
    groups = []
    for h in range(hours):
        own = []
        for u in [*range(users), 100 + h]:
            own.append(txn(f"{u}-{h}-a", user=f"u{u}", time=f"2024-01-01T{10 + h}:00:00", amount=100.0 if h < 3 else 30000.0,
                           location=None if (u, h) == (1, 2) else ("India" if h % 2 else "USA"), device=f"d{h // 2}"))
            own += [txn(f"{u}-{h}-{i}", user=f"u{u}", time=f"2024-01-01T{10 + h}:00:0{i}", device=f"d{h // 2}", location="UK") for i in range(1, 7)]
        groups.append(own)
    return groups


@pytest.mark.parametrize("stream, batch", [
    ("amount_vs_history_stream", lambda B, s: B.amount_vs_history(s)),
    ("rolling_velocity_stream", lambda B, s: B.rolling_velocity(s)),
    ("location_jump_stream", lambda B, s: B.location_jump(s, max_gap="2 hours")),
    ("new_device_stream", lambda B, s: B.new_device(s)),
    ("young_account_stream", lambda B, s: B.young_account(s)),
])
def test_stateful_rules_over_many_micro_batches_and_a_restart(spark, scratch, stream, batch):
    from txnguard.operators import behaviour as B
    from txnguard.streaming import stateful as ST

    groups = _many_batches()
    want = sorted(r.transaction_id for r in batch(B, silver_df(spark, [r for g in groups for r in g])).collect())
    options = {"max_gap": "2 hours"} if stream == "location_jump_stream" else {}

    def drain():
        rule = getattr(ST, stream)(lake.read_silver_stream(spark, f"{scratch}/in", 1), **options)
        J.drain([J.write_stream(rule, f"{scratch}/ck", f"{scratch}/out", trigger=AVAILABLE)])

    for rows in groups[:2]:
        silver_df(spark, rows).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        drain()
        spark.conf.set("spark.sql.shuffle.partitions", "5")  # a restart under another setting keeps every user's state
        _slices(spark, f"{scratch}/in", groups[2:])
        drain()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    got = sorted(r.transaction_id for r in spark.read.parquet(f"{scratch}/out").collect() if r.user_id != "__end__")
    assert want and got == want


def test_gold_ignores_rejected_silver(spark, scratch):
    good, bad = txn("ok", amount=30000.0, intl=True), txn("bad", amount=30000.0, intl=True, merchant=None)
    I.to_wire_json(silver_df(spark, [good, bad])).write.parquet(f"{scratch}/bronze")
    J.drain([J.start_silver_checked(spark, f"{scratch}/bronze", f"{scratch}/silver", f"{scratch}/ck", AVAILABLE)])
    J.drain(J.start_gold(spark, f"{scratch}/silver", f"{scratch}/gold", f"{scratch}/ckg", AVAILABLE))
    got = spark.read.parquet(f"{scratch}/gold/high_amount_fraud").collect()
    assert [r.transaction_id for r in got] == ["ok"]


def test_await_any_waits_although_an_earlier_query_has_ended(spark, scratch):
    import time

    src = f"{scratch}/src"
    silver_df(spark, [txn("a")]).write.parquet(src)
    J.drain([J.write_stream(lake.read_silver_stream(spark, src), f"{scratch}/ck0", f"{scratch}/o0", trigger=AVAILABLE)])
    q = J.write_stream(lake.read_silver_stream(spark, src), f"{scratch}/ck1", f"{scratch}/o1", trigger={"processingTime": "1 second"})
    t = time.monotonic()
    J.await_any(spark, [q], timeout=2)
    assert time.monotonic() - t >= 2 and q.isActive
    q.stop()
