"""Batch jobs over the lake (bronze → silver → gold → consolidated), K7/K11/K12.

Design for scale
* Tables are Parquet partitioned by ``event_date``; jobs take an optional
  list of dates, which becomes partition pruning on read and replaces exactly
  those days on write: a day that has no rows any more is cleared, and a run
  over all dates replaces the table. Reruns are idempotent, unlike the
  reference's append (which duplicated every earlier row on each run).
* Bronze is always read whole: an event may arrive any number of days late, and
  overwriting a day from a part of its rows would lose the others.
* Each stage writes its table before the next reads it, so lineage is cut
  at shared storage: a lost executor recomputes at most one stage.
* The alert expansion broadcasts the flagged windows only after counting
  them (Parquet footers, no data scan) and checking the estimate against a
  byte limit; above it the join is a shuffle on (user_id, window_start)
  with AQE skew splitting.
* Silver parsing writes valid and rejected rows in one pass, partitioned by
  ``_status``, so JSON is parsed once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.functions.columns import interval_micros
from txnguard.operators import consolidate as C
from txnguard.operators import ingest, rules
from txnguard.schemas import BRONZE_SCHEMA, EVENT_DATE, TXN_COLS, VELOCITY_WINDOW
from txnguard.session import checkpoint_root
from txnguard.sources import lake

# Bytes per flagged window row beside its user_id text (two timestamps, count, row and hash overhead).
WINDOW_ROW_BYTES = 128
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


# --- K7 / K11 / K12 ----------------------------------------------------------------


def _files(fs, pattern) -> dict[str, set[str]]:
    """Data files of the folders that match a Hadoop path pattern."""
    found = {}
    for folder in fs.globStatus(pattern) or []:
        names = {f.getPath().getName() for f in fs.listStatus(folder.getPath())}
        found[folder.getPath().toString()] = {n for n in names if not n.startswith(("_", "."))}
    return found


def _dated_files(spark: SparkSession, path: str, dates: list[str]) -> tuple[object, dict[str, set[str]]]:
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for d in dates:
        for level in ("", "/_status=*"):
            found |= _files(fs, jvm.org.apache.hadoop.fs.Path(f"{path}{level}/{EVENT_DATE}={d}"))
    return fs, found


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, dates: list[str] | None = None) -> None:
    """K7: Parquet write that replaces the table, or with ``dates`` exactly those
    event dates: their partitions that ``df`` has rows for are overwritten, their
    other ones removed afterwards."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dates else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if not dates:
        return w.parquet(path)
    spark = df.sparkSession
    _, before = _dated_files(spark, path, dates)
    w.parquet(path)
    fs, after = _dated_files(spark, path, dates)
    for folder, names in after.items():
        if names & before.get(folder, set()):  # not overwritten, so nothing of these days belongs here
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder), True)


def preview(df: DataFrame, n: int = 20) -> list:
    """First ``n`` rows (bounded ``take``, never a full collect)."""
    return df.take(n)


def assert_schema(df: DataFrame, expected: T.StructType, check_nullable: bool = False) -> None:
    """Schema as an assertion (names, order and types)."""
    got = [(f.name, f.dataType, f.nullable if check_nullable else None) for f in df.schema.fields]
    want = [(f.name, f.dataType, f.nullable if check_nullable else None) for f in expected.fields]
    if got != want:
        raise AssertionError(f"schema mismatch:\n got  {got}\n want {want}")


def is_stream_sink(spark: SparkSession, path: str) -> bool:
    """Whether a streaming sink writes the folder: its files are listed in the sink's log."""
    log = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/_spark_metadata")
    return log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log)


def compact_table(
    spark: SparkSession,
    path: str,
    dates: list[str] | None = None,
    target_file_bytes: int = 256 * 1024 * 1024,
) -> int:
    """Rewrite date partitions of a batch table into ~``target_file_bytes``
    files (frequent small writes leave many tiny files). Returns the number
    of files written per partition.

    Only for tables written by batch jobs. A streaming sink folder lists its
    files in ``_spark_metadata``; rewriting them in place breaks every reader
    of the folder, so sinks are sized with the trigger interval instead.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if is_stream_sink(spark, path):
        raise ValueError(f"{path} is a streaming sink folder; compaction would break its log")
    df = _dates_filter(spark.read.parquet(path), dates)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{EVENT_DATE}=*")) or []
    wanted = None if dates is None else {f"{EVENT_DATE}={d}" for d in dates}
    sizes = [fs.getContentSummary(f.getPath()).getLength() for f in found if wanted is None or f.getPath().getName() in wanted]
    n_parts = max(1, len(sizes))
    per_part = max(1, -(-sum(sizes) // n_parts // target_file_bytes))
    # materialise before overwriting the partitions it was read from
    checkpoint_root(spark)
    df = df.checkpoint(eager=True)
    (
        df.repartition(n_parts * per_part, EVENT_DATE, F.pmod(F.xxhash64(*df.columns), F.lit(per_part)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(EVENT_DATE)
        .parquet(path)
    )
    return per_part


# --- helpers -------------------------------------------------------------------------


def _dates_filter(df: DataFrame, dates: list[str] | None) -> DataFrame:
    if not dates:
        return df
    return df.filter(F.col(EVENT_DATE).isin([dt.date.fromisoformat(d) for d in dates]))


def _with_days_before(dates: list[str] | None, window: str) -> list[str] | None:
    """A transaction after midnight may belong to a window that started the day
    before (or more days before, for longer windows), so expansion of day d
    needs the windows of those days too."""
    if not dates:
        return None
    back = -(-interval_micros(window) // 86_400_000_000)
    days = {dt.date.fromisoformat(d) - dt.timedelta(days=i) for d in dates for i in range(back + 1)}
    return sorted(d.isoformat() for d in days)


def checked_broadcast(windows: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast ``windows`` only when their measured size is under ``max_bytes``: rows, and the bytes of the user ids,
    which may be of any length.

    ``windows`` must be a file scan (plus filters) so that reading one column of it is cheap.
    """
    n, text = windows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("user_id").cast("long")), F.lit(0))).first()
    if n * WINDOW_ROW_BYTES + text <= max_bytes:
        return F.broadcast(windows), True
    return windows, False


# --- stages --------------------------------------------------------------------------


def bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_root: str,
    dates: list[str] | None = None,
) -> tuple[str, str]:
    """Batch R4 with schema enforcement: returns (silver path, rejects path).

    One pass writes ``_status=valid`` and ``_status=rejected`` partitions;
    both are further partitioned by event date (ingestion date for rows
    whose time cannot be parsed).
    """
    bronze = spark.read.schema(BRONZE_SCHEMA).parquet(bronze_path)
    checked = ingest.with_event_date(ingest.to_silver_checked(bronze))
    out = checked.select(
        *TXN_COLS,
        F.col("_raw").alias("value"),
        F.col("_reject_reason").alias("reject_reason"),
        F.when(F.col("_reject_reason").isNull(), "valid").otherwise("rejected").alias("_status"),
        EVENT_DATE,
    )
    write_table(_dates_filter(out, dates), silver_root, ["_status", EVENT_DATE], dates)
    return f"{silver_root}/_status=valid", f"{silver_root}/_status=rejected"


def silver_to_gold(
    spark: SparkSession, silver_path: str, gold_root: str, dates: list[str] | None = None, **velocity_params
) -> None:
    """Batch R5: high-amount and velocity gold tables by event date."""
    silver = _dates_filter(lake.read_silver(spark, silver_path), dates)
    high = rules.high_amount_gold(silver)
    write_table(high, f"{gold_root}/high_amount_fraud", [EVENT_DATE], dates)
    vel = rules.velocity_gold(silver.select(*TXN_COLS), **velocity_params).withColumn(
        EVENT_DATE, F.to_date(F.col("window.start"))
    )
    write_table(vel, f"{gold_root}/velocity_fraud", [EVENT_DATE], dates)


def consolidate_gold(
    spark: SparkSession,
    silver_path: str,
    gold_root: str,
    dates: list[str] | None = None,
    method: str = "bucketed",
    broadcast_max_bytes: int = DEFAULT_BROADCAST_BYTES,
    closed: str = "both",
    window: str = VELOCITY_WINDOW,
) -> dict:
    """Batch R6 + R7 (S4–S6 → K7): the fraud_union table by event date.
    ``window``: the length that the velocity table's windows were made with."""
    silver = _dates_filter(lake.read_silver(spark, silver_path), dates).select(*TXN_COLS)
    high = _dates_filter(lake.read_high_amount(spark, f"{gold_root}/high_amount_fraud"), dates)
    windows = _dates_filter(lake.read_velocity(spark, f"{gold_root}/velocity_fraud"), _with_days_before(dates, window))
    windows = windows.select("user_id", "window", "count")
    windows, broadcast = checked_broadcast(windows, broadcast_max_bytes)
    out = C.consolidate(high, windows, silver, method=method, closed=closed, window=window)
    # rows without a time lie under their ingestion date, as in silver
    write_table(ingest.with_event_date(out), f"{gold_root}/fraud_union", [EVENT_DATE], dates)
    return {"broadcast_windows": broadcast}


def run_all(
    spark: SparkSession, bronze_path: str, lake_root: str, dates: list[str] | None = None
) -> dict:
    """bronze → silver (+ rejects) → gold → consolidated, stage by stage."""
    silver, rejects = bronze_to_silver(spark, bronze_path, f"{lake_root}/silver", dates)
    silver_to_gold(spark, silver, f"{lake_root}/gold", dates)
    info = consolidate_gold(spark, silver, f"{lake_root}/gold", dates)
    return {"silver": silver, "rejects": rejects, "gold": f"{lake_root}/gold", **info}
