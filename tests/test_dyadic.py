"""Alert expansion over windows of any length: dyadic cells."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, silver_df, txn
from txnguard.operators import consolidate as C
from txnguard.operators import rules as R
from txnguard.sources.tables import read_transactions


def test_cells_cover_exactly_and_are_few(spark):
    rng = random.Random(1)
    pairs = [(a, a + n) for a in (0, 1, 7, 1 << 20, 28_401_120) for n in (0, 1, 2, 3, 5, 60, 1440, 4096)]
    pairs += [(a, a + rng.randrange(100_000)) for a in (rng.randrange(1 << 40) for _ in range(200))]
    df = spark.createDataFrame(pairs, "first long, last long").select("*", C.dyadic_cells(F.col("first"), F.col("last")).alias("c"))
    for r in df.collect():
        spans = sorted((c.cell << c.level, (c.cell + 1) << c.level) for c in r.c)
        assert spans[0][0] == r.first and spans[-1][1] == r.last + 1
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert len(spans) <= 2 * (r.last - r.first + 1).bit_length()


def test_cells_before_the_epoch(spark):
    df = spark.createDataFrame([(-5, 4), (-1, -1), (-1000, -3)], "first long, last long").select("*", C.dyadic_cells(F.col("first"), F.col("last")).alias("c"))
    for r in df.collect():
        covered = sorted(x for c in r.c for x in range(c.cell * 2**c.level, (c.cell + 1) * 2**c.level))
        assert covered == list(range(r.first, r.last + 1))


def windows_df(spark, rows):
    return spark.createDataFrame(rows, "user_id string, window struct<start: timestamp, end: timestamp>, count long")


@pytest.mark.parametrize("closed", ["both", "left"])
def test_mixed_windows_equal_the_range_join(spark, closed):
    silver = read_transactions(spark, SF_MID)
    alerts = [R.velocity(silver, window=w) for w in ("60 seconds", "7 minutes", "1 hour", "24 hours")]
    alerts = alerts[0].unionByName(alerts[1]).unionByName(alerts[2]).unionByName(alerts[3])
    dyadic = C.expand_velocity(alerts, silver, method="dyadic", closed=closed)
    by_range = C.expand_velocity(alerts, silver, method="range", closed=closed)
    assert dyadic.count() == by_range.count() > 0
    assert dyadic.exceptAll(by_range).isEmpty() and by_range.exceptAll(dyadic).isEmpty()


def test_rows_per_window_grow_with_the_log_of_its_length(spark):
    import datetime as dt

    start = dt.datetime(2024, 1, 1, 0, 0, 13)
    rows = [("u", (start, start + dt.timedelta(minutes=m)), 9) for m in (1, 60, 1440, 100_000)]
    flat = C.flatten_windows(windows_df(spark, rows))
    counts = {r.m: r["count"] for r in C.windows_by_cell(flat, "1 minute").withColumn("m", (F.unix_timestamp("end") - F.unix_timestamp("start")) / 60).groupBy("m").count().collect()}
    assert counts[1] <= 2 and counts[60] <= 12 and counts[1440] <= 22 and counts[100_000] <= 34


def test_windows_without_time_empty_tables_and_null_users(spark):
    silver = silver_df(spark, [txn("t1", time="2024-01-01T00:00:30"), txn("t2", time="bad"), txn("t3", user=None, time="2024-01-01T00:00:30")])
    rows = [("u1", None, 7), (None, None, 7)]
    assert C.expand_velocity(windows_df(spark, rows), silver, method="dyadic").count() == 0
    assert C.expand_velocity(windows_df(spark, []), silver, method="dyadic").count() == 0
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [("u1", (t, t + dt.timedelta(hours=5)), 7), ("u1", (t + dt.timedelta(hours=5), t), 7), (None, (t, t + dt.timedelta(hours=5)), 7)]
    hits = C.expand_velocity(windows_df(spark, rows), silver, method="dyadic").collect()
    assert [(r.transaction_id, r.triggered_rule) for r in hits] == [("t1", "HIGH_VELOCITY")]
