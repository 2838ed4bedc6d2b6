"""Property tests: the scale forms equal the literal forms on random inputs
with boundary-heavy times (exact minute edges, duplicates, NULL users)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import silver_df, txn
from test_behaviour import _ids, _plain_references
from txnguard.operators import behaviour as B
from txnguard.operators import consolidate as C
from txnguard.operators import rules as R

BASE = dt.datetime(2024, 1, 1, 10, 0, 0)

# seconds from 10:00:00 drawn mostly on or next to minute edges
offsets = st.one_of(
    st.sampled_from([0, 59, 60, 61, 119, 120, 180]),
    st.integers(min_value=0, max_value=240),
)
events = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), offsets, st.sampled_from(["India", "USA"]),
              st.sampled_from([10.0, 100.0, 350.0, 2000.0])),
    min_size=6,
    max_size=40,
)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _silver(spark, evs):
    rows = [
        txn(f"t{i}", user=u, time=(BASE + dt.timedelta(seconds=s)).isoformat(), location=loc, amount=amt)
        for i, (u, s, loc, amt) in enumerate(evs)
    ]
    return silver_df(spark, rows)


@SETTINGS
@given(evs=events)
def test_bucketed_expansion_equals_range_join(spark, evs):
    from pyspark.sql import functions as F

    from txnguard.functions.columns import event_time

    silver = _silver(spark, evs)
    vel = R.velocity(silver, min_exclusive=2)
    # the literal reference join (user only + BETWEEN), fine on tiny inputs
    v, s = C.flatten_windows(vel).alias("v"), silver.alias("s")
    et = event_time(F.col("s.transaction_time"))
    literal = {
        "both": v.join(s, (F.col("v.user_id") == F.col("s.user_id")) & et.between(F.col("v.start"), F.col("v.end"))),
        "left": v.join(s, (F.col("v.user_id") == F.col("s.user_id")) & (et >= F.col("v.start"))
                       & (et < F.col("v.end"))),
    }
    for closed in ("both", "left"):
        want = sorted(r.transaction_id for r in literal[closed].select("s.transaction_id").collect())
        for method in ("bucketed", "range"):
            got = C.expand_velocity(vel, silver, method=method, closed=closed)
            assert sorted(r.transaction_id for r in got.collect()) == want


@SETTINGS
@given(evs=events)
def test_bucketed_behaviour_equals_plain_windows(spark, evs):
    silver = _silver(spark, evs)
    d1, d2, d3 = _plain_references(silver)
    assert _ids(B.amount_vs_history(silver, bucket="1 minute")) == _ids(d1)
    assert _ids(B.rolling_velocity(silver, bucket="2 minutes")) == _ids(d2)
    assert _ids(B.location_jump(silver, max_gap="10 seconds", bucket="1 minute")) == _ids(d3)


devices = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), offsets, st.sampled_from(["d1", "d2", None]),
              st.sampled_from([10.0, 25000.0])),
    min_size=4,
    max_size=30,
)


@SETTINGS
@given(evs=devices)
def test_device_and_age_rules_equal_plain_windows(spark, evs):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from txnguard.functions.columns import event_time

    rows = [
        txn(f"t{i}", user=u, device=d, amount=amt, time=(BASE + dt.timedelta(seconds=s)).isoformat())
        for i, (u, s, d, amt) in enumerate(evs)
    ]
    silver = silver_df(spark, rows)
    t = silver.withColumn("et", event_time("transaction_time"))
    rn = F.row_number().over(Window.partitionBy("user_id", "device_id").orderBy("et", "transaction_id"))
    d4 = t.withColumn("rn", rn).filter("rn = 1 AND transaction_amount > 20000")
    first = F.min(F.unix_micros("et")).over(Window.partitionBy("user_id"))
    d5 = t.withColumn("age", F.unix_micros("et") - first).filter(
        "transaction_amount > 20000 AND age < 90000000")
    assert _ids(B.new_device(silver)) == _ids(d4)
    assert _ids(B.young_account(silver, max_age="90 seconds")) == _ids(d5)


stream_events = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.integers(min_value=0, max_value=100),
              st.sampled_from(["India", "USA"]), st.sampled_from(["d1", "d2"]),
              st.sampled_from([10.0, 100.0, 25000.0])),
    min_size=6,
    max_size=30,
)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(evs=stream_events, order=st.permutations([0, 1, 2]))
def test_stateful_streams_equal_batch_for_any_arrival_order(spark, evs, order):
    import uuid

    from txnguard.session import work_dir
    from txnguard.sources import lake
    from txnguard.streaming import replay as RP
    from txnguard.streaming import stateful as ST

    rows = [
        txn(f"t{i}", user=u, location=loc, device=d, amount=amt,
            time=(BASE + dt.timedelta(seconds=s)).isoformat())
        for i, (u, s, loc, d, amt) in enumerate(evs)
    ]
    src = work_dir(spark, "tests", "prop_stream", uuid.uuid4().hex[:8])
    chunks = [rows[k::3] for k in range(3)]
    for k in order:   # files arrive out of event-time order
        if chunks[k]:
            silver_df(spark, chunks[k]).coalesce(1).write.mode("append").parquet(src)
    silver_df(spark, [txn("flush", user="zz", time="2099-01-01T00:00:00")]).coalesce(1) \
        .write.mode("append").parquet(src)
    batch = silver_df(spark, rows)
    pairs = [
        (ST.location_jump_stream, lambda s: B.location_jump(s, max_gap="10 seconds"),
         {"max_gap": "10 seconds"}),
        (ST.amount_vs_history_stream, B.amount_vs_history, {}),
        (ST.new_device_stream, B.new_device, {}),
        (ST.young_account_stream, lambda s: B.young_account(s, max_age="30 seconds"), {"max_age": "30 seconds"}),
        (ST.rolling_velocity_stream, lambda s: B.rolling_velocity(s, window="20 seconds", min_exclusive=2),
         {"window": "20 seconds", "min_exclusive": 2}),
    ]
    for stream_rule, batch_rule, kw in pairs:
        stream = lake.read_silver_stream(spark, src, max_files_per_trigger=1)
        out = RP.run_to_table(stream_rule(stream, **kw), spark, "prop_" + stream_rule.__name__)
        assert _ids(out) == _ids(batch_rule(batch)), stream_rule.__name__
