"""Late rows: routed to a table of their own, and the alerts they belong to repaired.

A windowed stream drops rows of windows that the watermark has closed, silently.
``start_routed`` keeps its own high-water mark beside the stream: the latest event
time of each micro-batch, one small row per batch. A row is late when the end of
its window is at or under the mark of the batches before it, which is when Spark's
watermark has closed the window. Every batch writes its rows once, under
``late=false`` or ``late=true``, and its mark; both are overwritten by batch id, so a
batch that runs again after a failure leaves the same tables.

``repaired`` recounts exactly the windows that late rows fall in, from all rows of
those windows, and replaces them in the alert table; no other window is touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txnguard.functions.columns import bucket_micros, event_time, interval_micros
from txnguard.operators import rules as R
from txnguard.schemas import FRAUD_TYPE_VELOCITY, SILVER_SCHEMA, TXN_COLS, VELOCITY_MIN_EXCLUSIVE, VELOCITY_WATERMARK, VELOCITY_WINDOW

MARKS = T.StructType([T.StructField("high_us", T.LongType()), T.StructField("batch_id", T.LongType())])
ROUTED = T.StructType([*SILVER_SCHEMA.fields, T.StructField("late", T.BooleanType()), T.StructField("batch_id", T.LongType())])


def _write(df: DataFrame, path: str, by: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def mark_before(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """The latest event time (microseconds) of all batches before ``batch_id``; one number from one row per batch."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/marks")
    if not fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
        return None
    return spark.read.schema(MARKS).parquet(f"{root}/marks").where(F.col("batch_id") < batch_id).agg(F.max("high_us")).first()[0]


def route(batch: DataFrame, batch_id: int, root: str, window: str = VELOCITY_WINDOW, delay: str = VELOCITY_WATERMARK) -> None:
    """One micro-batch: its rows, on time or late, and its mark. Rows without a time belong to no window and are on time."""
    high = mark_before(batch.sparkSession, root, batch_id)
    # Spark keeps watermarks in milliseconds
    passed = None if high is None else (high // 1000 - interval_micros(delay) // 1000) * 1000
    closes = bucket_micros(event_time("transaction_time"), window) + F.lit(interval_micros(window))
    late = F.lit(False) if passed is None else F.coalesce(closes <= F.lit(passed), F.lit(False))
    stamped = batch.select(*TXN_COLS).withColumns({"late": late, "batch_id": F.lit(batch_id).cast("long")})
    _write(stamped, f"{root}/rows", ["late", "batch_id"])
    mark = batch.agg(F.max(F.unix_micros(event_time("transaction_time"))).alias("high_us")).withColumn("batch_id", F.lit(batch_id).cast("long"))
    _write(mark, f"{root}/marks", ["batch_id"])


def start_routed(silver: DataFrame, root: str, checkpoint: str, window: str = VELOCITY_WINDOW, delay: str = VELOCITY_WATERMARK, trigger: dict | None = None) -> StreamingQuery:
    """Route a silver stream into ``root``/rows, partitioned by ``late`` and batch."""
    return (
        silver.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: route(batch, batch_id, root, window, delay))
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def routed(spark: SparkSession, root: str, late: bool | None = None) -> DataFrame:
    """The routed rows: all, or those on time or late alone (one partition is read)."""
    rows = spark.read.schema(ROUTED).parquet(f"{root}/rows")
    return (rows if late is None else rows.where(F.col("late") == late)).select(*TXN_COLS)


def repaired(
    alerts: DataFrame, rows: DataFrame, late: DataFrame, window: str = VELOCITY_WINDOW, min_exclusive: int = VELOCITY_MIN_EXCLUSIVE
) -> DataFrame:
    """The velocity ``alerts`` with the windows of ``late`` rows counted again over ``rows`` (all of them, late ones included).

    Three joins on (user, window): ``rows`` are cut to the touched windows before they are counted, and the alerts
    of those windows give way to the new counts. The keys are windows, so a hot user is spread over all of theirs.
    """
    start = lambda df: df.withColumn("_w", bucket_micros(event_time("transaction_time"), window)).withColumn("_u", F.struct("user_id"))
    touched = start(late).where("_w is not null").select("_u", "_w").distinct()
    again = start(rows).join(touched, ["_u", "_w"], "left_semi").drop("_u", "_w")
    counted = R.velocity(again, window=window, min_exclusive=min_exclusive, watermark=None).withColumn("fraud_type", F.lit(FRAUD_TYPE_VELOCITY))
    kept = alerts.withColumn("_w", F.unix_micros(F.col("window.start"))).withColumn("_u", F.struct("user_id")).join(touched, ["_u", "_w"], "left_anti")
    return kept.select("user_id", "window", "count", "fraud_type").unionByName(counted.select("user_id", "window", "count", "fraud_type"))
