"""One key holding a third of all rows: results stay exact and the work for
the hot key is spread over many tasks instead of one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from test_behaviour import _ids, _plain_references
from txnguard.functions.columns import event_time
from txnguard.operators import behaviour as B
from txnguard.operators import consolidate as C
from txnguard.operators import ingest as I
from txnguard.operators import parts as P
from txnguard.operators import rules as R
from txnguard.sources.tables import read_transactions


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the transactions re-assigned to one user ("user_hot")."""
    silver = read_transactions(spark, SF_MID)
    hot_user = F.when(F.xxhash64("transaction_id") % 3 == 0, F.lit("user_hot")).otherwise(F.col("user_id"))
    return silver.withColumn("user_id", hot_user).cache()


def test_fixture_is_skewed(hot):
    n = hot.count()
    share = hot.filter("user_id = 'user_hot'").count() / n
    assert 0.3 < share < 0.37


def test_behaviour_rules_exact_under_skew(hot):
    d1, d2, d3 = _plain_references(hot)
    assert _ids(B.amount_vs_history(hot)) == _ids(d1)
    assert _ids(B.rolling_velocity(hot)) == _ids(d2)
    assert _ids(B.location_jump(hot, max_gap="10 seconds")) == _ids(d3)


def test_hot_user_is_spread_over_buckets(hot):
    # the window stages partition by (user, bucket): the largest group is a
    # small slice of the hot user's rows, not all of them
    rows = B.timed(hot).withColumn("_b", F.col("_us") - F.pmod(F.col("_us"), F.lit(60_000_000)))
    groups = rows.filter("user_id = 'user_hot'").groupBy("_b").count()
    biggest = groups.agg(F.max("count")).first()[0]
    total = rows.filter("user_id = 'user_hot'").count()
    assert groups.count() >= 10 and biggest < total / 5


def test_expansion_and_consolidation_exact_under_skew(hot):
    vel = R.velocity(hot)
    a = C.expand_velocity(vel, hot, method="range")
    b = C.expand_velocity(vel, hot, method="bucketed")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0
    out = C.consolidate(R.high_amount(hot), vel, hot)
    assert out.count() == out.select("transaction_id", "ingestion_time").distinct().count()


def test_redelivered_copies_collapse(hot):
    # a group of copies: every hot row delivered three times
    copies = hot.filter("user_id = 'user_hot'")
    many = hot.unionByName(copies).unionByName(copies)
    assert I.dedup_earliest(many).count() == hot.count()


def test_velocity_counts_exact_under_skew(hot):
    got = R.velocity(hot).filter("user_id = 'user_hot'").select(F.sum("count")).first()[0]
    et = event_time("transaction_time")
    want = (
        hot.filter("user_id = 'user_hot'")
        .groupBy(F.window(et, "60 seconds"))
        .count()
        .filter("count > 5")
        .select(F.sum("count"))
        .first()[0]
    )
    assert got == want


def test_bucket_load_shows_the_hot_user_spread(hot):
    top = B.bucket_load(hot, "1 minute", top=5).collect()
    assert len(top) == 5 and top[0].user_id == "user_hot"
    assert top[0].share < 0.2   # the hot user's biggest minute is a small slice of the table


def _one_hot_minute(spark, n=4000):
    """A user with all rows of one minute, and a few others."""
    from conftest import silver_df, txn

    rng = random.Random(4)
    places = ["India", "USA", "UK"]
    rows = [txn(f"t{i:05d}", user="hot", amount=float(rng.choice([10, 20, 5000])), time=f"2024-01-01T10:00:{rng.randrange(60):02d}.{rng.randrange(10**6):06d}", location=rng.choice(places)) for i in range(n)]
    rows += [txn(f"s{i}", user=rng.choice(["a", None]), amount=1.0, time=f"2024-01-01T10:0{rng.randrange(3)}:{rng.randrange(60):02d}", location=rng.choice(places)) for i in range(60)]
    rows.append(txn("bad", user="hot", time="bad"))
    return silver_df(spark, rows)


@pytest.mark.parametrize("rule", [B.amount_vs_history, B.rolling_velocity, B.location_jump])
def test_one_minute_of_one_user_is_split_and_gives_the_same_rows(spark, rule):
    silver = _one_hot_minute(spark)
    whole, split = rule(silver, keep_all=True), rule(silver, keep_all=True, max_group=100)
    if rule is B.amount_vs_history:  # means are sums in another order
        whole, split = (df.withColumn("prior_avg", F.round("prior_avg", 6)) for df in (whole, split))
    assert whole.columns == split.columns and whole.count() == split.count()
    assert whole.exceptAll(split).isEmpty() and split.exceptAll(whole).isEmpty()


def test_no_part_holds_an_eighth_of_a_hot_group(spark):
    rows = B.timed(_one_hot_minute(spark)).withColumn("_b", F.lit(0))
    parts = P.with_parts(rows, ["user_id", "_b"], ["_us", "transaction_id"], 200)
    sizes = {(r.user_id, r._part): r["count"] for r in parts.groupBy("user_id", "_part").count().collect()}
    hot = [n for (user, _), n in sizes.items() if user == "hot"]
    assert sum(hot) == 4000 and max(hot) < 500 and len(hot) >= 10
    assert {p for user, p in sizes if user != "hot"} == {0}
    # in order: no row of a part comes after one of the next
    ends = parts.where("user_id = 'hot'").groupBy("_part").agg(F.min(F.struct("_us", "transaction_id")).alias("lo"), F.max(F.struct("_us", "transaction_id")).alias("hi")).orderBy("_part").collect()
    assert all(a.hi < b.lo for a, b in zip(ends, ends[1:]))
    # the same parts by a shuffle of the groups' splitters
    again = P.with_parts(rows, ["user_id", "_b"], ["_us", "transaction_id"], 200, broadcast_groups=0)
    assert parts.exceptAll(again).isEmpty()
    assert P.with_parts(rows.limit(0), ["user_id", "_b"], ["_us"], 10).count() == 0
