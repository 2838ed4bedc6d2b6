"""Streaming consolidation (the reference runs R6/R7 as a batch job).

The velocity aggregate (append mode: a window is emitted once, when the
watermark passes its end) is joined back to the silver stream with a
stream-stream join:

* equi keys ``(user_id, window_start)`` — the same bucketed form as the
  batch expansion (a transaction exactly on a window start also names the
  window before, for the inclusive end);
* an event-time range ``start <= event_time <= end`` on top, which lets
  Spark bound the join state: silver rows are dropped from state once the
  watermark passes the end of any window they could still join.

The final per-transaction grouping (A2) is **not** done in the same stream:
joined rows are emitted only once their window has closed, so a later
windowed aggregate would see them as late and drop them silently (G17).
Hits are streamed to tables and grouped in batch (or per touched
``event_date`` partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txnguard.functions.columns import bucket_micros, event_time, interval_micros
from txnguard.operators import consolidate as C
from txnguard.operators import rules as R
from txnguard.operators.ingest import with_event_date
from txnguard.schemas import (
    EVENT_DATE,
    HIT_COLS,
    SILVER_SCHEMA,
    RULE_HIGH_VELOCITY,
    TXN_COLS,
    VELOCITY_MIN_EXCLUSIVE,
    VELOCITY_WATERMARK,
    VELOCITY_WINDOW,
)
from txnguard.session import work_dir
from txnguard.sources import lake
from txnguard.streaming.jobs import drain, state_partitions, write_stream

HIT_STREAM_SCHEMA = T.StructType(
    list(SILVER_SCHEMA.fields)
    + [T.StructField("triggered_rule", T.StringType()), T.StructField(EVENT_DATE, T.DateType())]
)

AVAILABLE_NOW = {"availableNow": True}


def expand_velocity_stream(
    silver: DataFrame,
    window: str = VELOCITY_WINDOW,
    min_exclusive: int = VELOCITY_MIN_EXCLUSIVE,
    watermark: str = VELOCITY_WATERMARK,
    closed: str = "both",
) -> DataFrame:
    """R2 + R6 on a stream: HIGH_VELOCITY hits (``HIT_COLS``) in append mode."""
    d = interval_micros(window)
    timed = silver.withColumn("_et", event_time("transaction_time")).withWatermark("_et", watermark)
    windows = (
        timed.groupBy(F.col("user_id").alias("_v_user"), F.window("_et", window))
        .count()
        .filter(F.col("count") > F.lit(int(min_exclusive)))
        .withColumn("_v_start_us", F.unix_micros(F.col("window.start")))
        # window_time() = end - 1 µs and keeps the event-time watermark, so
        # the range below can drive state eviction on both join sides
        .withColumn("_v_time", F.window_time(F.col("window")))
    )
    b0 = bucket_micros(F.col("_et"), window)
    on_edge = F.unix_micros(F.col("_et")) == b0
    starts = F.array(b0)
    if closed == "both":
        starts = F.when(on_edge, F.array(b0, b0 - F.lit(d))).otherwise(F.array(b0))
    s = timed.withColumn("_s_start_us", F.explode(starts)).alias("s")
    v = windows.alias("v")
    v_time = F.col("v._v_time")
    if closed == "both":
        end_ok = F.col("s._et") <= v_time + F.expr("INTERVAL 1 MICROSECOND")
    else:
        end_ok = F.col("s._et") <= v_time
    cond = (
        (F.col("s.user_id") == F.col("v._v_user"))
        & (F.col("s._s_start_us") == F.col("v._v_start_us"))
        & (F.col("s._et") >= v_time - F.expr(f"INTERVAL {d - 1} MICROSECONDS"))
        & end_ok
    )
    cols = [F.col("v._v_user").alias("user_id") if c == "user_id" else F.col(f"s.{c}") for c in TXN_COLS]
    return s.join(v, cond, "inner").select(*cols, F.lit(RULE_HIGH_VELOCITY).alias("triggered_rule"))


def start_hit_streams(
    silver: DataFrame, hits_root: str, checkpoint: str, trigger: dict | None = None, **velocity_params
) -> list:
    """Two append queries writing standardised hits to their own tables,
    partitioned by ``event_date`` (of the transaction)."""
    silver = silver.select(*TXN_COLS)
    high = with_event_date(C.standardize_high_amount(R.high_amount(silver)))
    vel = with_event_date(expand_velocity_stream(silver, **velocity_params))
    return [
        write_stream(high, f"{checkpoint}/high_hits", f"{hits_root}/high_amount", trigger=trigger,
                     partition_by=[EVENT_DATE]),
        write_stream(vel, f"{checkpoint}/velocity_hits", f"{hits_root}/velocity", trigger=trigger,
                     partition_by=[EVENT_DATE]),
    ]


def regroup_dates(spark: SparkSession, hits_root: str, out_path: str, touched: DataFrame) -> None:
    """Rebuild the consolidated rows of the ``touched`` event dates.

    Dates come from event text, so their number has no bound: they stay a table,
    and a left-semi join on the partition column picks the hits of those days
    (with partition pruning at run time where Spark broadcasts the dates). The
    dynamic partition overwrite replaces exactly those days: re-running a
    micro-batch gives the same table.
    """
    dates = touched.select(EVENT_DATE).filter(F.col(EVENT_DATE).isNotNull()).distinct()
    # explicit schema: a hit sink that has not written a file yet reads as empty
    parts = [
        spark.read.schema(HIT_STREAM_SCHEMA).parquet(f"{hits_root}/{name}")
        .join(dates, EVENT_DATE, "left_semi").select(*HIT_COLS)
        for name in ("high_amount", "velocity")
    ]
    grouped = C.group_hits(C.union_hits(*parts))
    (
        with_event_date(grouped)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(EVENT_DATE)
        .parquet(out_path)
    )


def start_consolidation(
    spark: SparkSession, hits_root: str, out_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """R7 as a continuous job: each micro-batch of new hits regroups the
    dates it touched (``foreachBatch``; at-least-once, idempotent writes).

    The grouping reads hit *tables*, never a windowed aggregate downstream of
    the join, which would drop the late-emitted hits (G17).
    """
    new_hits = lake.read_parquet_stream(spark, f"{hits_root}/high_amount", HIT_STREAM_SCHEMA).unionByName(
        lake.read_parquet_stream(spark, f"{hits_root}/velocity", HIT_STREAM_SCHEMA)
    )

    def _regroup(batch: DataFrame, batch_id: int) -> None:
        regroup_dates(spark, hits_root, out_path, batch.select(EVENT_DATE))

    return (
        new_hits.select(EVENT_DATE).writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(_regroup)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def group_hit_tables(spark: SparkSession, hits_root: str) -> DataFrame:
    """Batch A2 over the streamed hit tables."""
    high = spark.read.schema(HIT_STREAM_SCHEMA).parquet(f"{hits_root}/high_amount").select(*HIT_COLS)
    vel = spark.read.schema(HIT_STREAM_SCHEMA).parquet(f"{hits_root}/velocity").select(*HIT_COLS)
    return C.group_hits(C.union_hits(high, vel))


def consolidate_stream(spark: SparkSession, silver: DataFrame, name: str = "consolidate") -> tuple[DataFrame, list]:
    """Drain both hit streams (availableNow) and group in batch."""
    root = work_dir(spark, "stream_consolidate", name, unique=True)
    with state_partitions(spark):
        queries = start_hit_streams(silver, f"{root}/hits", f"{root}/_ckpt", trigger=AVAILABLE_NOW)
    drain(queries)
    return group_hit_tables(spark, f"{root}/hits"), queries
