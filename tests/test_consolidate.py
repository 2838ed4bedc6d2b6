"""Alert expansion and consolidation (R6, R7, U1, A2; G7, G8, G9, G10)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, silver_df, txn
from txnguard.operators import consolidate as C
from txnguard.operators import rules as R
from txnguard.schemas import FRAUD_UNION_COLS, HIT_COLS
from txnguard.sources.tables import read_transactions


def _boundary_rows():
    # six at 10:00:00..05, one before, one exactly at the window end, one after
    rows = [txn(f"in{i}", user="u", time=f"2024-01-01T10:00:0{i}") for i in range(6)]
    rows += [
        txn("before", user="u", time="2024-01-01T09:59:59"),
        txn("at_end", user="u", time="2024-01-01T10:01:00"),
        txn("after", user="u", time="2024-01-01T10:01:30"),
    ]
    return rows


@pytest.mark.parametrize("method", ["range", "bucketed"])
def test_inclusive_end_is_reference_behaviour(spark, method):
    # The row at exactly 10:01:00 joins the [10:00, 10:01) window
    silver = silver_df(spark, _boundary_rows())
    hits = C.expand_velocity(R.velocity(silver), silver, method=method)
    ids = sorted(r.transaction_id for r in hits.collect())
    assert ids == sorted([f"in{i}" for i in range(6)] + ["at_end"])
    assert hits.columns == HIT_COLS


@pytest.mark.parametrize("method", ["range", "bucketed"])
def test_closed_left_attaches_only_counted_rows(spark, method):
    silver = silver_df(spark, _boundary_rows())
    hits = C.expand_velocity(R.velocity(silver), silver, method=method, closed="left")
    assert sorted(r.transaction_id for r in hits.collect()) == sorted(f"in{i}" for i in range(6))


def test_boundary_row_in_two_windows_collapses(spark):
    # 10:01:00 is in [10:00,10:01] and [10:01,10:02]; two join rows, one output row
    rows = [txn(f"a{i}", user="u", time=f"2024-01-01T10:00:1{i}") for i in range(6)]
    rows += [txn(f"b{i}", user="u", time=f"2024-01-01T10:01:0{i}") for i in range(6)]
    silver = silver_df(spark, rows)
    hits = C.expand_velocity(R.velocity(silver), silver)
    assert hits.filter("transaction_id = 'b0'").count() == 2
    out = C.consolidate(R.high_amount(silver), R.velocity(silver), silver)
    assert out.filter("transaction_id = 'b0'").count() == 1
    assert out.count() == 12


def test_both_rules_sorted_and_duplicates_by_ingestion(spark):
    rows = [txn(f"v{i}", user="u", time=f"2024-01-01T10:00:0{i}") for i in range(5)]
    rows.append(txn("both", user="u", time="2024-01-01T10:00:09", amount=30000.0, intl=True))
    # Same id delivered twice with different ingestion time → two rows
    rows.append(txn("dup", user="x", amount=30000.0, intl=True))
    rows.append(txn("dup", user="x", amount=30000.0, intl=True, ingested=dt.datetime(2024, 1, 1, 12)))
    silver = silver_df(spark, rows)
    out = C.consolidate(R.high_amount(silver), R.velocity(silver), silver)
    assert out.columns == FRAUD_UNION_COLS
    got = {(r.transaction_id, r.ingestion_time.hour): r.triggered_rules for r in out.collect()}
    assert got[("both", 10)] == ["HIGH_AMOUNT", "HIGH_VELOCITY"]
    assert got[("v0", 10)] == ["HIGH_VELOCITY"]
    assert got[("dup", 10)] == ["HIGH_AMOUNT"] and got[("dup", 12)] == ["HIGH_AMOUNT"]


def test_null_users_counted_but_not_joined_back(spark):
    # G10
    rows = [txn(f"n{i}", user=None, time=f"2024-01-01T10:00:0{i}") for i in range(6)]
    silver = silver_df(spark, rows)
    assert R.velocity(silver).count() == 1
    assert C.expand_velocity(R.velocity(silver), silver).count() == 0


def test_union_keeps_duplicates(spark):
    rows = [txn(f"v{i}", user="u", time=f"2024-01-01T10:00:0{i}", amount=30000.0, intl=True)
            for i in range(6)]
    silver = silver_df(spark, rows)
    u = C.union_hits(C.standardize_high_amount(R.high_amount(silver)),
                     C.expand_velocity(R.velocity(silver), silver))
    assert u.count() == 12


def test_range_and_bucketed_agree_on_driver_data(spark):
    silver = read_transactions(spark, SF_SMALL)
    vel = R.velocity(silver)
    a = C.expand_velocity(vel, silver, method="range")
    b = C.expand_velocity(vel, silver, method="bucketed")
    assert a.count() == b.count() == 88
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_consolidated_counts_on_driver_data(spark):
    silver = read_transactions(spark, SF_SMALL)
    out = C.consolidate(R.high_amount(silver), R.velocity(silver), silver)
    sizes = {r.k: r.n for r in out.groupBy(F.concat_ws(",", "triggered_rules").alias("k"))
             .count().withColumnRenamed("count", "n").collect()}
    # FIXTURES: 93 rows = 87 velocity only / 5 amount only / 1 both
    assert sizes == {"HIGH_VELOCITY": 87, "HIGH_AMOUNT": 5, "HIGH_AMOUNT,HIGH_VELOCITY": 1}


def test_bucketed_expansion_is_an_equi_join(spark):
    silver = read_transactions(spark, SF_SMALL)
    plan = C.expand_velocity(R.velocity(silver), silver)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "_wstart_us" in plan
