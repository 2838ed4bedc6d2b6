"""Column quantiles from mergeable sketches."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_MID, silver_df, txn
from txnguard.operators import quantiles as Q
from txnguard.schemas import EVENT_DATE
from txnguard.sources.tables import read_transactions


def amounts(spark, values, days=("2024-01-01",)):
    rows = [txn(f"t{i}", amount=v, time=f"{days[i % len(days)]}T10:00:00") for i, v in enumerate(values)]
    return silver_df(spark, rows)


def ranks(values, v):
    values = np.asarray(values)
    return (values < v).mean(), (values <= v).mean()


def test_quantiles_within_the_rank_error_of_exact_ones(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(6, 2, 30_000), np.full(10_000, 500.0)])
    df = spark.createDataFrame([(float(v),) for v in values], "transaction_amount double").withColumn("transaction_time", F.lit("2024-01-01T00:00:00"))
    row = Q.profile_quantiles(df, columns=["transaction_amount"]).first()
    assert (row.n_values, row.min_measure, row.max_measure) == (len(values), values.min(), values.max())
    for p in Q.DEFAULT_PROBS:
        below, upto = ranks(values, row[Q._name(p)])
        assert below - 2 * Q.rank_error(Q.DEFAULT_K) <= p <= upto + 2 * Q.rank_error(Q.DEFAULT_K)


def test_sketches_of_two_days_merge_into_those_of_one_pass(spark):
    rng = np.random.default_rng(4)
    values = rng.normal(1000, 200, 6000)
    days = ("2024-01-01", "2024-01-02")
    kept = Q.day_sketches(amounts(spark, values.tolist(), days), ["transaction_amount"])
    assert sorted(r[EVENT_DATE].isoformat() for r in kept.collect()) == list(days)
    assert sum(r.n_values for r in kept.collect()) == 6000
    whole = Q.quantiles(Q.merged(kept)).first()
    once = Q.profile_quantiles(amounts(spark, values.tolist(), days), columns=["transaction_amount"]).first()
    assert (whole.n_values, whole.min_measure, whole.max_measure) == (once.n_values, once.min_measure, once.max_measure)
    for p in Q.DEFAULT_PROBS:
        for row in (whole, once):
            below, upto = ranks(values, row[Q._name(p)])
            assert below - 2 * Q.rank_error(Q.DEFAULT_K) <= p <= upto + 2 * Q.rank_error(Q.DEFAULT_K)


def test_a_rerun_day_replaces_its_sketches_only(spark):
    first = Q.day_sketches(amounts(spark, [1.0, 2.0, 3.0, 4.0], ("2024-01-01", "2024-01-02")), ["transaction_amount"])
    again = Q.day_sketches(amounts(spark, [10.0, 20.0, 30.0], ("2024-01-02",)), ["transaction_amount"])
    kept = first.where(F.col(EVENT_DATE) != dt.date(2024, 1, 2)).unionByName(again)
    row = Q.quantiles(Q.merged(kept), (0.5,)).first()
    assert (row.n_values, row.min_measure, row.max_measure) == (5, 1.0, 30.0)


def test_measures_of_types_nulls_and_nan(spark):
    rows = [
        txn("t1", amount=math.nan, time="2024-01-01T00:00:10", device="d"),
        txn("t22", amount=None, time="bad", device=None, intl=True, ingested=None),
        txn(None, amount=-5.0, time="2024-01-01T00:00:30", device="device", intl=None),
    ]
    df = silver_df(spark, rows)
    got = {r.column_name: (r.n_values, r.min_measure, r.max_measure) for r in Q.profile_quantiles(df).collect()}
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()
    assert got["transaction_amount"] == (1, -5.0, -5.0)
    assert got["transaction_time"] == (2, t0 + 10, t0 + 30)
    assert got["transaction_id"] == (2, 2.0, 3.0) and got["device_id"] == (2, 1.0, 6.0)
    assert got["is_international"] == (2, 0.0, 1.0)
    assert got["ingestion_time"][0] == 2
    empty = {r.column_name: tuple(r)[1:] for r in Q.profile_quantiles(silver_df(spark, [])).collect()}
    assert empty == {}  # no day, no sketch
    nothing = Q.profile_quantiles(silver_df(spark, [txn("t1", amount=None)]), columns=["transaction_amount"]).first()
    assert nothing.n_values == 0 and nothing.min_measure is None and nothing.q500 is None


def test_a_wrong_quantile_fails_the_rank_check(spark):
    df = amounts(spark, [float(i) for i in range(1000)])
    found = Q.profile_quantiles(df, (0.5,), ["transaction_amount"])
    assert Q.within_error(df, found, (0.5,)).first().q500_ok
    assert not Q.within_error(df, found.withColumn("q500", F.lit(700.0)), (0.5,)).first().q500_ok


def test_one_pass_ships_sketches_not_rows(spark):
    from txnguard.plans.inspect import executed_plan

    plan = executed_plan(Q.profile_quantiles(read_transactions(spark, SF_MID)))
    assert plan.count("Exchange hashpartitioning") == 2 and "BatchEvalPython" not in plan  # by day, then by column
    assert isinstance(Q.day_sketches(read_transactions(spark, SF_MID)).schema["sketch"].dataType, T.BinaryType)
