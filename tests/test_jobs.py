"""Batch lake jobs: stage-by-stage writes, idempotent reruns, pruning."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, silver_df, txn
from txnguard.operators import consolidate as C
from txnguard.operators import ingest as I
from txnguard.operators import rules as R
from txnguard.plans import inspect as P
from txnguard.plans import jobs
from txnguard.schemas import FRAUD_UNION_COLS, SILVER_SCHEMA
from txnguard.sources import lake as L
from txnguard.sources.tables import read_table, read_transactions


@pytest.fixture(scope="module")
def lake(spark):
    from txnguard.session import work_dir

    root = work_dir(spark, "tests", "lake", unique=True)
    txns = read_transactions(spark, SF_SMALL)
    noise = read_table(spark, SF_SMALL, "events").select(
        F.col("event_type").alias("value"), F.col("ts").cast("timestamp").alias("ingestion_time")
    )
    I.to_wire_json(txns).unionByName(noise).write.parquet(f"{root}/bronze")
    info = jobs.run_all(spark, f"{root}/bronze", f"{root}/lake")
    return root, info


def test_run_all_counts(spark, lake):
    root, info = lake
    assert spark.read.parquet(info["silver"]).count() == 1000
    assert spark.read.parquet(info["rejects"]).count() == 1000
    fu = spark.read.parquet(f"{info['gold']}/fraud_union")
    assert fu.count() == 93
    assert fu.columns[: len(FRAUD_UNION_COLS)] == FRAUD_UNION_COLS
    assert info["broadcast_windows"] is True


def test_rerun_is_idempotent(spark, lake):
    root, info = lake
    days = [r[0].isoformat() for r in spark.read.parquet(info["silver"]).select("event_date").distinct().collect()]
    jobs.consolidate_gold(spark, info["silver"], info["gold"], dates=days)
    jobs.consolidate_gold(spark, info["silver"], info["gold"], dates=days)
    assert spark.read.parquet(f"{info['gold']}/fraud_union").count() == 93


def test_shuffle_expansion_when_windows_too_big_to_broadcast(spark, lake):
    root, info = lake
    gold2 = f"{root}/gold_noshare"
    jobs.silver_to_gold(spark, info["silver"], gold2)
    res = jobs.consolidate_gold(spark, info["silver"], gold2, broadcast_max_bytes=1)
    assert res["broadcast_windows"] is False
    a = spark.read.parquet(f"{gold2}/fraud_union")
    b = spark.read.parquet(f"{info['gold']}/fraud_union")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_date_filter_prunes_partitions(spark, lake):
    root, info = lake
    df = jobs._dates_filter(spark.read.parquet(info["silver"]), ["2024-01-01"])
    assert "PartitionFilters: [isnotnull(event_date" in P.formatted_plan(df)


def test_schema_assertion_and_preview(spark, lake):
    root, info = lake
    silver = spark.read.parquet(info["silver"]).drop("value", "reject_reason", "event_date")
    jobs.assert_schema(silver, SILVER_SCHEMA)
    with pytest.raises(AssertionError):
        jobs.assert_schema(silver.drop("location"), SILVER_SCHEMA)
    assert len(jobs.preview(silver, 5)) == 5


def test_compaction_rewrites_batch_tables_only(spark, lake):
    import os

    from txnguard.sources import lake as L
    from txnguard.streaming import jobs as J

    root, info = lake
    table = f"{root}/many_files"
    spark.read.parquet(f"{info['gold']}/fraud_union").repartition(20).write.partitionBy("event_date").parquet(table)
    before = sorted(map(repr, spark.read.parquet(table).collect()))   # small: 93 rows
    jobs.compact_table(spark, table)
    assert sorted(map(repr, spark.read.parquet(table).collect())) == before
    files = [f for _, _, fs in os.walk(table) for f in fs if f.endswith(".parquet")]
    assert len(files) == 1

    sink = f"{root}/sink"
    J.drain([J.write_stream(L.read_silver_stream(spark, info["silver"]), f"{root}/sink_ck", sink,
                            trigger={"availableNow": True})])
    with pytest.raises(ValueError):
        jobs.compact_table(spark, sink)


def _lake(spark, root, rows):
    """Run the lake jobs over these silver rows (as bronze JSON)."""
    I.to_wire_json(silver_df(spark, rows)).write.mode("overwrite").parquet(f"{root}/bronze")
    return jobs.run_all(spark, f"{root}/bronze", f"{root}/lake")


def _union_ids(spark, info):
    return sorted(r.transaction_id for r in L.read_high_amount(spark, f"{info['gold']}/fraud_union").collect())


def test_rebuilding_a_date_keeps_rows_ingested_long_after_it(spark, scratch):
    rows = [txn("a"), txn("late", ingested="2024-03-01 00:00:00")]
    bronze = I.to_wire_json(silver_df(spark, rows)).withColumn("ingest_date", F.to_date("ingestion_time"))
    bronze.write.partitionBy("ingest_date").parquet(f"{scratch}/bronze")
    for dates in (None, ["2024-01-01"]):
        silver, _ = jobs.bronze_to_silver(spark, f"{scratch}/bronze", f"{scratch}/silver", dates=dates)
        assert sorted(r.transaction_id for r in spark.read.parquet(silver).collect()) == ["a", "late"]


@pytest.mark.parametrize("dates", [None, ["2024-01-01"]])
def test_rerun_clears_a_day_that_lost_its_hits(spark, scratch, dates):
    rows = [txn("x", amount=30000.0, intl=True), txn("y", amount=30000.0, intl=True, time="2024-01-02T10:00:00")]
    info = _lake(spark, scratch, rows)
    assert _union_ids(spark, info) == ["x", "y"]
    rows[0] = txn("x", amount=30.0, intl=True)
    I.to_wire_json(silver_df(spark, rows)).write.mode("overwrite").parquet(f"{scratch}/bronze")
    info = jobs.run_all(spark, f"{scratch}/bronze", f"{scratch}/lake", dates)
    assert _union_ids(spark, info) == ["y"]


def test_rerun_of_one_date_keeps_other_days_hits_without_a_time(spark, scratch):
    rows = [txn("p", amount=30000.0, intl=True, time="?", ingested="2024-01-01 10:00:00"),
            txn("q", amount=30000.0, intl=True, time="?", ingested="2024-01-02 10:00:00")]
    silver = I.with_event_date(silver_df(spark, rows))
    silver.write.partitionBy("event_date").parquet(f"{scratch}/silver")
    info = {"gold": f"{scratch}/gold"}
    for dates in (None, ["2024-01-01"]):
        jobs.silver_to_gold(spark, f"{scratch}/silver", info["gold"], dates)
        jobs.consolidate_gold(spark, f"{scratch}/silver", info["gold"], dates)
        assert _union_ids(spark, info) == ["p", "q"]


def test_empty_gold_consolidates_to_nothing(spark, scratch):
    info = _lake(spark, scratch, [txn("a")])
    assert _union_ids(spark, info) == []


def test_five_minute_windows_find_all_their_members(spark, scratch):
    rows = [txn(f"t{i}", time=f"2024-01-01T10:0{i % 5}:10.0000{i:02d}") for i in range(7)]
    silver = silver_df(spark, rows)
    vel = R.velocity_gold(silver, window="5 minutes")
    for how in ("bucketed", "range"):
        assert C.expand_velocity(vel, silver, method=how, window="5 minutes").count() == 7
    assert C.expand_velocity(vel, silver, method="range").count() == 7
    with pytest.raises(Exception, match="window length"):
        C.expand_velocity(vel, silver).count()
    I.with_event_date(silver).write.partitionBy("event_date").parquet(f"{scratch}/silver")
    jobs.silver_to_gold(spark, f"{scratch}/silver", f"{scratch}/gold", window="5 minutes")
    jobs.consolidate_gold(spark, f"{scratch}/silver", f"{scratch}/gold", ["2024-01-01"], window="5 minutes")
    assert len(_union_ids(spark, {"gold": f"{scratch}/gold"})) == 7


def test_compaction_sizes_the_selected_days(spark, scratch):
    import os

    rows = spark.range(20000).selectExpr("id", "date_add(date'2024-01-01', cast(id % 20 as int)) event_date", "repeat(uuid(), 3) pad")
    rows.coalesce(1).write.partitionBy("event_date").parquet(f"{scratch}/t")
    jobs.compact_table(spark, f"{scratch}/t", ["2024-01-03"], target_file_bytes=1 << 20)
    files = [f for f in os.listdir(f"{scratch}/t/event_date=2024-01-03".replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) == 1
