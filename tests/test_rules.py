"""R1/R2 semantics."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import silver_df, txn
from txnguard.operators import rules as R


def test_high_amount_strict_and_null_handling(spark):
    rows = [
        txn("eq", amount=20000.0, intl=True),      # exactly threshold: out (G5)
        txn("in", amount=20000.01, intl=True),     # in
        txn("dom", amount=50000.0, intl=False),    # domestic: out
        txn("nullamt", amount=None, intl=True),    # NULL amount: out (G6)
        txn("nullflag", amount=50000.0, intl=None),  # NULL flag: out (G6)
    ]
    out = R.high_amount(silver_df(spark, rows))
    assert [r.transaction_id for r in out.collect()] == ["in"]
    r = out.first()
    assert r.high_amount_flag and r.intl_flag and r.is_fraud


def test_high_amount_gold_layout(spark):
    out = R.high_amount_gold(silver_df(spark, [txn(amount=30000.0, intl=True)]))
    assert out.columns[-4:] == ["high_amount_flag", "intl_flag", "is_fraud", "fraud_type"]
    assert len(out.columns) == 13
    assert out.first().fraud_type == "high_amount"


def test_high_amount_threshold_parameter(spark):
    df = silver_df(spark, [txn("a", amount=150.0, intl=True), txn("b", amount=50.0, intl=True)])
    assert [r.transaction_id for r in R.high_amount(df, threshold=100).collect()] == ["a"]


def _burst(user, n, second0=0, minute="10:00"):
    return [txn(f"{user}-{minute}-{i}", user=user, time=f"2024-01-01T{minute}:{second0 + i:02d}") for i in range(n)]


def test_velocity_counts_strictly_more_than_five(spark):
    df = silver_df(spark, _burst("five", 5) + _burst("six", 6))
    out = R.velocity(df).collect()
    assert [(r.user_id, r["count"]) for r in out] == [("six", 6)]
    w = out[0].window
    assert (w.start.minute, w.end.minute) == (0, 1)


def test_velocity_tumbling_not_sliding(spark):
    # 3 + 3 events across a minute edge: no tumbling window holds six
    rows = [txn(f"a{i}", user="edge", time=f"2024-01-01T10:00:5{7 + i}") for i in range(3)]
    rows += [txn(f"b{i}", user="edge", time=f"2024-01-01T10:01:0{i}") for i in range(3)]
    assert R.velocity(silver_df(spark, rows)).count() == 0


def test_velocity_bad_and_null_times_ignored(spark):
    # G1: bad text must not kill the query on ANSI Spark; G2: ignored by window()
    rows = _burst("u", 6) + [txn("bad", user="u", time="not a time"), txn("null", user="u", time=None)]
    out = R.velocity(silver_df(spark, rows)).collect()
    assert [r["count"] for r in out] == [6]


def test_velocity_null_users_grouped_together(spark):
    # NULL users form one group
    rows = [txn(f"n{i}", user=None, time=f"2024-01-01T10:00:{i:02d}") for i in range(6)]
    out = R.velocity(silver_df(spark, rows)).collect()
    assert len(out) == 1 and out[0].user_id is None


def test_velocity_zone_less_text_read_as_utc(spark):
    # Session time zone is UTC; window start equals the wall-clock minute
    out = R.velocity(silver_df(spark, _burst("u", 6))).select(
        F.date_format("window.start", "HH:mm").alias("s")
    )
    assert out.first().s == "10:00"


def test_velocity_gold_layout(spark):
    out = R.velocity_gold(silver_df(spark, _burst("u", 7)))
    assert out.columns == ["user_id", "window", "count", "fraud_type"]
    assert out.first().fraud_type == "velocity"
