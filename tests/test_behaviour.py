"""Behavioural rules D1–D7: hand fixtures, bucket invariance and plain-window
references on the driver data."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL, silver_df, txn
from txnguard.functions.columns import event_time
from txnguard.operators import behaviour as B
from txnguard.operators import scoring as S
from txnguard.schemas import TXN_COLS
from txnguard.sources.tables import read_transactions


def _ids(df):
    return sorted(r.transaction_id for r in df.select("transaction_id").collect())


def test_amount_vs_history_fixture(spark):
    rows = [
        txn("a", amount=100.0, time="2024-01-01T10:00:00"),
        txn("b", amount=301.0, time="2024-01-01T10:00:10"),   # > 3 × 100
        txn("c", amount=600.0, time="2024-01-01T10:05:00"),   # avg(100, 301) = 200.5; 600 < 601.5
        txn("d", amount=1000.0, time="2024-01-01T11:00:00"),  # avg 333.67 → 1000 < 1001
        txn("e", amount=2000.0, time="2024-01-02T00:00:00"),  # avg 500.25 → flagged
    ]
    out = B.amount_vs_history(silver_df(spark, rows), keep_all=True)
    got = {r.transaction_id: (r.prior_n, r.amount_vs_avg) for r in out.collect()}
    assert got == {"a": (0, False), "b": (1, True), "c": (2, False), "d": (3, False), "e": (4, True)}


def test_rolling_velocity_catches_burst_over_minute_edge(spark):
    rows = [txn(f"a{i}", user="u", time=f"2024-01-01T10:00:5{7 + i}") for i in range(3)]
    rows += [txn(f"b{i}", user="u", time=f"2024-01-01T10:01:0{i}") for i in range(3)]
    out = B.rolling_velocity(silver_df(spark, rows))
    assert _ids(out) == ["b2"]  # six within (t - 60 s, t] only at the last one


def test_location_jump_fixture(spark):
    rows = [
        txn("a", location="India", time="2024-01-01T10:00:00"),
        txn("b", location="USA", time="2024-01-01T10:00:04"),   # jump within 10 s
        txn("c", location="USA", time="2024-01-01T10:00:06"),   # same place
        txn("d", location="UK", time="2024-01-01T10:00:30"),    # too late
        txn("e", location="India", time="2024-01-01T10:00:59"),  # 29 s: too late
        txn("f", location="USA", time="2024-01-01T10:01:00"),   # 1 s across a minute edge
    ]
    out = B.location_jump(silver_df(spark, rows), max_gap="10 seconds", bucket="1 minute")
    assert _ids(out) == ["b", "f"]


def test_new_device_and_young_account_fixture(spark):
    rows = [
        txn("a", device="d1", amount=30000.0, time="2024-01-01T10:00:00"),
        txn("b", device="d1", amount=30000.0, time="2024-01-01T10:01:00"),  # device seen
        txn("c", device="d2", amount=10.0, time="2024-01-01T10:02:00"),     # small
        txn("d", device="d3", amount=30000.0, time="2024-01-20T10:00:00"),  # new device, old account
    ]
    df = silver_df(spark, rows)
    assert _ids(B.new_device(df)) == ["a", "d"]
    assert _ids(B.young_account(df, max_age="7 days")) == ["a", "b"]


def _plain_references(silver):
    """The textbook single-window forms (one user per partition)."""
    t = silver.withColumn("et", event_time("transaction_time")).filter("et IS NOT NULL")
    w = Window.partitionBy("user_id").orderBy("et", "transaction_id")
    d1 = t.withColumn("avg", F.avg("transaction_amount").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    d1 = d1.filter(F.col("transaction_amount") > 3 * F.col("avg"))
    us = F.unix_micros("et")
    d2 = t.withColumn("us", us).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("user_id").orderBy("us").rangeBetween(-59_999_999, 0))
    ).filter("n > 5")
    d3 = (t.withColumn("pl", F.lag("location").over(w)).withColumn("pu", F.lag(us).over(w))
          .filter((F.col("location") != F.col("pl")) & (us - F.col("pu") < 10_000_000)))
    return d1, d2, d3


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_bucketed_rules_equal_plain_windows(spark, sf):
    silver = read_transactions(spark, sf)
    d1, d2, d3 = _plain_references(silver)
    for bucket in ["10 seconds", "1 minute", "1 hour"]:
        assert _ids(B.amount_vs_history(silver, bucket=bucket)) == _ids(d1)
    for bucket in ["1 minute", "10 minutes"]:
        assert _ids(B.rolling_velocity(silver, bucket=bucket)) == _ids(d2)
        assert _ids(B.location_jump(silver, max_gap="10 seconds", bucket=bucket)) == _ids(d3)


def test_fixture_counts_on_driver_data(spark):
    silver = read_transactions(spark, SF_SMALL)
    # FIXTURES.md: 48 / 149 / 9 / 5 on sf0.001
    assert B.amount_vs_history(silver).count() == 48
    assert B.location_jump(silver, max_gap="10 seconds").count() == 149
    assert B.new_device(silver).count() == 9
    assert B.young_account(silver, max_age="7 minutes").count() == 5


def test_risk_score_and_label(spark):
    rows = [txn(f"v{i}", user="u", time=f"2024-01-01T10:00:0{i}") for i in range(5)]
    rows.append(txn("hot", user="u", time="2024-01-01T10:00:09", amount=30000.0, intl=True,
                    device="fresh"))
    out = S.scored_transactions(silver_df(spark, rows), max_gap="10 seconds", max_age="7 days")
    got = {r.transaction_id: (r.triggered_rules, r.risk_score, r.is_fraud) for r in out.collect()}
    rules, score, label = got["hot"]
    assert {"HIGH_AMOUNT", "HIGH_VELOCITY", "NEW_DEVICE", "YOUNG_ACCOUNT", "AMOUNT_VS_AVG"} <= set(rules)
    assert score == 0.9 and label == 1
    assert got["v1"][1] == 0.3 and got["v1"][2] == 0


def test_rules_keep_silver_columns(spark):
    silver = read_transactions(spark, SF_SMALL)
    for df in [B.amount_vs_history(silver), B.rolling_velocity(silver), B.new_device(silver),
               B.location_jump(silver), B.young_account(silver)]:
        assert df.columns[: len(TXN_COLS)] == TXN_COLS


def test_fraud_model_scores_every_user(spark):
    from __spark_entry__ import queries

    out = queries()["fraud_model"](spark, SF_SMALL)
    rows = out.collect()
    assert len(rows) == read_transactions(spark, SF_SMALL).select("user_id").distinct().count()
    assert all(0.0 <= r.fraud_probability <= 1.0 for r in rows)


@pytest.mark.parametrize("bucket", [None, "3 minutes"])
def test_transaction_features_equal_plain_windows(spark, bucket):
    silver = read_transactions(spark, SF_SMALL)
    got = B.transaction_features(silver, trailing="60 seconds", bucket=bucket)
    t = silver.withColumn("us", F.unix_micros(event_time("transaction_time"))).filter("us IS NOT NULL")
    wr = Window.partitionBy("user_id").orderBy("us").rangeBetween(-59_999_999, 0)
    wo = Window.partitionBy("user_id").orderBy("us", "transaction_id")
    gap = F.col("us") - F.lag("us").over(wo)
    want = t.select(
        "transaction_id",
        F.count(F.lit(1)).over(wr).alias("trailing_count"),
        F.size(F.collect_set("device_id").over(wr)).cast("long").alias("trailing_devices"),
        F.count("transaction_amount").over(wo.rowsBetween(Window.unboundedPreceding, -1)).alias("prior_n"),
        F.when(gap < 60_000_000, gap / 1e6).alias("seconds_since_prev"),
    )
    cols = ["transaction_id", "trailing_count", "trailing_devices", "prior_n", "seconds_since_prev"]
    a, b = got.select(*cols), want.select(*cols)
    assert a.count() == 1000 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_new_device_flags_a_redelivered_sighting_once_and_null_ids(spark):
    rows = [txn("a", amount=30000.0), txn("a", amount=30000.0, ingested="2024-01-01 11:00:00"), txn(None, user="u2", amount=30000.0)]
    got = B.new_device(silver_df(spark, rows)).collect()
    assert sorted((r.user_id, r.transaction_id) for r in got) == [("u1", "a"), ("u2", None)]


def test_null_user_keeps_its_label(spark):
    from txnguard.operators import model as M

    features = spark.createDataFrame([(None, *[1.0] * 8), ("u", *[1.0] * 8)], "user_id string, " + ", ".join(f"{c} double" for c in M.FEATURES))
    labels = spark.createDataFrame([(None, 1.0)], "user_id string, label double")
    assert {r.user_id: r.label for r in M.training_set(features, labels).collect()} == {None: 1.0, "u": 0.0}


def test_passes_get_partitions_by_the_number_of_rows(spark, monkeypatch):
    """A task's share of the feature, label and scoring passes stays the same when the input grows."""
    from txnguard.operators import model as ML
    from txnguard.operators import parts as P
    from txnguard.operators import scoring as SC
    from txnguard.plans.inspect import formatted_plan

    rows = [txn(f"t{i}", user=f"u{i % 40}", time=f"2024-01-01T10:{i % 60:02d}:00", amount=float(i)) for i in range(2000)]
    silver = silver_df(spark, rows)
    want = sorted(B.transaction_features(silver, trailing="60 seconds").collect(), key=str)
    for per_task, parts in ((100, 20), (50, 40)):
        monkeypatch.setattr(P, "ROWS_PER_TASK", per_task)
        features = B.transaction_features(silver, trailing="60 seconds")
        for df in (features, SC.fused_hits(silver), ML.next_event(silver, silver.limit(5), "2 minutes")):
            plan = formatted_plan(df)
            assert re.search(rf"hashpartitioning\(_uk#\d+, _un#\d+, _b\w*#\d+L?, {parts}\)|hashpartitioning\(user_id#\d+, _b#\d+L, {parts}\)", plan)
        assert re.search(rf"hashpartitioning\(user_id#\d+, device_id#\d+, {parts}\)", formatted_plan(SC.fused_hits(silver)))
    assert sorted(features.collect(), key=str) == want
