"""Dedup against history, day partials of the rollup, Z-order layout, the model in time."""

from __future__ import annotations

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, silver_df, txn
from txnguard.operators import consolidate as C
from txnguard.operators import marts as M
from txnguard.operators import model as ML
from txnguard.operators import rollup_parts as P
from txnguard.operators import rules as R
from txnguard.operators import scoring as SC
from txnguard.operators import seen as S
from txnguard.plans import layout as L
from txnguard.plans.inspect import executed_plan, pushed_filters
from txnguard.sources.tables import read_transactions


# --- dedup against history ----------------------------------------------------------------


def test_a_delivery_reads_only_buckets_that_may_hold_its_ids(spark, scratch):
    index = S.SeenIds(spark, scratch, buckets=64, segments=1)
    first = silver_df(spark, [txn(f"a{i}") for i in range(500)] + [txn(None), txn(None)])
    fresh, met = S.dedup_delivery(first, index, "d1")
    assert (fresh.count(), met) == (502, [])
    assert index.ids().count() == 500
    new, met = S.dedup_delivery(silver_df(spark, [txn(f"b{i}") for i in range(60)]), index, "d2")
    assert new.count() == 60 and len(met) <= 4  # the filters rule nearly all buckets out
    again, met = S.dedup_delivery(silver_df(spark, [txn("a7"), txn("a8"), txn("c1"), txn("c1", ingested="2024-01-01 09:00:00")]), index, "d3")
    assert [(r.transaction_id, r.ingestion_time.hour) for r in again.collect()] == [("c1", 9)] and 1 <= len(met) <= 4
    ids = index.ids().where(F.col("bucket").isin(met))
    assert "PartitionFilters: [bucket" in executed_plan(ids) or "bucket#" in executed_plan(ids).split("PartitionFilters")[1]


def test_a_delivery_that_runs_again_changes_nothing(spark, scratch):
    index = S.SeenIds(spark, scratch, buckets=8, segments=1)
    rows = silver_df(spark, [txn(f"a{i}") for i in range(40)])
    S.dedup_delivery(silver_df(spark, [txn("a1")]), index, "d0")
    for _ in range(2):
        fresh, _ = S.dedup_delivery(rows, index, "d1")
        assert fresh.count() == 39 and index.ids().count() == 40
    empty, met = S.dedup_delivery(rows.limit(0), index, "d2")
    assert empty.count() == 0 and met == []


def test_filters_have_no_false_negative_and_few_false_positives(spark, scratch):
    index = S.SeenIds(spark, scratch, buckets=4, segments=1)
    held = spark.range(6000).select(F.concat(F.lit("x"), "id").alias("transaction_id"))
    index.add(held, "d1")
    assert index.maybe_seen(held).count() == 6000
    other = spark.range(6000).select(F.concat(F.lit("y"), "id").alias("transaction_id"))
    assert index.maybe_seen(other).count() < 0.15 * 6000


# --- rollup by days -----------------------------------------------------------------------


def test_a_rerun_day_leaves_other_days_files_and_gives_the_full_rollup(spark, scratch):
    silver = read_transactions(spark, SF_MID)
    hits = C.consolidate(R.high_amount(silver), R.velocity(silver), silver)
    P.write_days(P.day_partials(silver, hits), scratch)
    files = lambda: {r.f for r in P.read_days(spark, scratch).select(F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    day = F.to_date("ingestion_time") == F.lit(dt.date(2024, 1, 9))
    P.write_days(P.day_partials(silver.where(day), hits.where(day)), scratch)
    changed = {f for f in before ^ files()}
    assert changed and all("2024-01-09" in f for f in changed)
    got = {(r.location, r.merchant_id, r.grouping_level): r for r in P.rollup_of(P.read_days(spark, scratch)).collect()}
    for r in M.metrics_rollup(silver, hits, exact=True).collect():
        own = got[r.location, r.merchant_id, r.grouping_level]
        assert (own.n_txn, own.total_amount, own.n_flagged, own.flagged_amount, own.flag_rate) == (r.n_txn, r.total_amount, r.n_flagged, r.flagged_amount, r.flag_rate)
        assert abs(own.n_users - r.n_users) <= 1 + 0.05 * r.n_users and abs(own.n_flagged_users - r.n_flagged_users) <= 1 + 0.05 * r.n_flagged_users


# --- layout ---------------------------------------------------------------------------------


def test_bits_interleave(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(1 << 16), rng.randrange(1 << 16)) for _ in range(200)] + [(0, 0), (65535, 0), (0, 65535)]
    for r in spark.createDataFrame(pairs, "a int, b int").select("a", "b", L.zvalue(F.col("a"), F.col("b")).alias("z")).collect():
        assert r.z == sum((r.a >> k & 1) << (2 * k + 1) | (r.b >> k & 1) << (2 * k) for k in range(16))


def _files_met(path, place, low, high):
    """Files whose statistics allow a row of that user and time, and all files."""
    import glob

    met, names = 0, glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True)
    for name in names:
        meta = pq.ParquetFile(name).metadata
        column = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
        stats = [(g.column(column["user_hash"]).statistics, g.column(column["event_us"]).statistics) for g in groups]
        met += any(h.min <= place <= h.max and t.has_min_max and t.min < high and t.max >= low for h, t in stats)
    return met, len(names)


def test_one_user_s_hour_lies_in_few_files_of_a_z_ordered_table(spark, scratch):
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    rows = [txn(f"t{i}", user=f"user_{rng.randrange(300)}", time=(start + dt.timedelta(seconds=rng.randrange(86_400))).isoformat()) for i in range(20_000)]
    silver_df(spark, rows + [txn("null", user=None), txn("bad", user="user_1", time="bad")]).write.parquet(scratch)
    before = spark.read.parquet(scratch)
    want = sorted(r[0] for r in rows if r[1] == "user_7" and "2024-01-01T10:00:00" <= r[4] < "2024-01-01T11:00:00")
    total = before.count()
    L.zorder_table(spark, scratch, rows_per_file=320)
    got = L.read_user_time(spark, scratch, "user_7", start + dt.timedelta(hours=10), start + dt.timedelta(hours=11))
    assert sorted(r.transaction_id for r in got.collect()) == want and want
    pushed = " ".join(pushed_filters(got))
    assert "EqualTo(user_hash," in pushed and "GreaterThanOrEqual(event_us," in pushed
    place = spark.range(1).select(L.user_hash(F.lit("user_7")).alias("h")).first().h
    low = int(start.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6) + 36_000_000_000
    met, files = _files_met(scratch, place, low, low + 3_600_000_000)
    assert files >= 40 and met <= 4
    assert spark.read.parquet(scratch).count() == total
    L.zorder_table(spark, scratch, rows_per_file=320)  # again: the same rows
    assert spark.read.parquet(scratch).count() == total
    assert L.read_user_time(spark, scratch, None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)).count() == 1


# --- the model in time ----------------------------------------------------------------------


def test_next_event_is_strictly_later_and_within_the_horizon(spark):
    rng = random.Random(3)
    at = lambda s: (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)).isoformat()
    rows = [(f"r{i}", rng.choice(["a", "b", None]), rng.randrange(1000)) for i in range(200)]
    events = [(f"e{i}", rng.choice(["a", "b", None]), rng.randrange(1000)) for i in range(25)]
    frame = lambda own: silver_df(spark, [txn(t, user=u, time=at(s)) for t, u, s in own])
    base = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    got = {r.transaction_id: r.next_us for r in ML.next_event(frame(rows), frame(events), "90 seconds").collect()}
    want = {t: min((base + s2 * 10**6 for _, u2, s2 in events if u2 == u and s < s2 <= s + 90), default=None) for t, u, s in rows}
    assert got == want


def test_no_training_label_looks_into_the_test_period(spark):
    silver = read_transactions(spark, SF_MID)
    flagged = SC.scored_transactions(silver, max_gap="10 seconds", max_age="7 minutes").where("is_fraud = 1")
    rows = ML.temporal_training(silver, flagged, horizon="2 minutes", trailing="60 seconds").join(silver.select("transaction_id", "transaction_time"), "transaction_id")
    ends = {r.split: (r.lo, r.hi) for r in rows.groupBy("split").agg(F.min("transaction_time").alias("lo"), F.max("transaction_time").alias("hi")).collect()}
    gap = dt.datetime.fromisoformat(ends["test"][0]) - dt.datetime.fromisoformat(ends["train"][1])
    assert gap >= dt.timedelta(minutes=2) - dt.timedelta(seconds=5)
    scored = ML.fit_temporal(rows.drop("transaction_time"))
    base = scored.agg(F.avg("label")).first()[0]
    area = ML.pr_auc(scored)
    print(f"PR-AUC {area:.3f}, share of label 1 {base:.3f}")
    assert scored.count() == rows.where("split = 'test'").count() and 0 < base < 1 and area > base


@pytest.mark.parametrize("rows", [[], [txn("t", time="bad")]])
def test_temporal_training_of_nothing(spark, rows):
    silver = silver_df(spark, rows)
    assert ML.temporal_training(silver, silver).count() == 0
