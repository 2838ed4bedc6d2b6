"""Replay the driver tables through the streaming layers.

The ``events`` table is read as a file stream, mapped to transactions and
pushed through bronze → silver → gold with ``availableNow`` triggers; each
layer is a real Parquet sink with its own checkpoint under the shared
checkpoint folder, and the next layer streams from the previous one's
directory (its ``_spark_metadata`` log). Results are read back as batch
tables, so the lineage ends at the written files.

Stateful replays start with the cluster's default parallelism as their state
partition count (``state_partitions``), not the session's shuffle setting.

Append-mode velocity only emits a window once the watermark passes its end,
so the newest windows stay in state at the end of a bounded replay. A
**flush sentinel** — one silver row dated 2099-01-01 for a user outside the
data, in its own directory — moves the watermark past every real window; it
is filtered out of every result.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.operators import ingest, rules
from txnguard.schemas import HIT_COLS, SILVER_SCHEMA, TXN_COLS
from txnguard.session import work_dir
from txnguard.functions.columns import event_time
from txnguard.sources import lake
from txnguard.sources.tables import read_transactions, redelivered, transactions_from_events
from txnguard.streaming import changes, consolidate, late
from txnguard.streaming.jobs import detect, drain, start_bronze, state_partitions, write_stream

AVAILABLE_NOW = {"availableNow": True}

# Flush sentinel (fixed values): far-future event for a user outside the data.
SENTINEL_USER = "__flush_sentinel__"
SENTINEL_TIME = "2099-01-01T00:00:00.000000"

_lock = threading.Lock()
_silver_cache: dict[tuple[str, str], str] = {}


def _app_key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"))


def replay_silver(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> str:
    """events stream → bronze (wire JSON) → silver; returns the silver path.

    Memoised per (application, sf_dir) so several stream queries in one
    session share one replay.
    """
    key = _app_key(spark, sf_dir)
    with _lock:
        if key in _silver_cache:
            return _silver_cache[key]
        root = work_dir(spark, "replay", unique=True)
        events = lake.read_events_stream(spark, sf_dir, max_files_per_trigger)
        bronze = ingest.to_wire_json(transactions_from_events(events))
        drain([write_stream(bronze, f"{root}/_ckpt/bronze", f"{root}/bronze", trigger=AVAILABLE_NOW)])
        silver = ingest.to_silver(lake.read_bronze_stream(spark, f"{root}/bronze"))
        drain([write_stream(silver, f"{root}/_ckpt/silver", f"{root}/silver", trigger=AVAILABLE_NOW)])
        _silver_cache[key] = f"{root}/silver"
        return _silver_cache[key]


def forget() -> None:
    """Replay afresh from now on (for benchmarks)."""
    with _lock:
        _silver_cache.clear()


def _sentinel_dir(spark: SparkSession) -> str:
    path = work_dir(spark, "replay", "sentinel", unique=True)
    row = [(
        "sentinel", SENTINEL_USER, "none", 0.0, SENTINEL_TIME, "none", "none", False, None,
    )]
    (
        spark.createDataFrame(row, SILVER_SCHEMA)
        .withColumn("ingestion_time", F.to_timestamp(F.lit(SENTINEL_TIME)))
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(path)
    )
    return path


def silver_stream(spark: SparkSession, sf_dir: str, flush: bool = False) -> DataFrame:
    """Silver as a stream; with ``flush`` the sentinel is unioned in."""
    silver = lake.read_silver_stream(spark, replay_silver(spark, sf_dir))
    if flush:
        silver = silver.unionByName(lake.read_silver_stream(spark, _sentinel_dir(spark)))
    return silver


def _in_order(spark: SparkSession, path: str, start_ms: int) -> int:
    """Give the new files of ``path`` ascending modification times from ``start_ms`` on, in the order of their names:
    the file source delivers files by modification time. Returns the time after the last."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    for i, file in enumerate(files):
        fs.setTimes(file, start_ms + 1000 * i, -1)
    return start_ms + 1000 * len(files)


def delivered(spark: SparkSession, parts: list[tuple[DataFrame, int]], per_batch: int) -> DataFrame:
    """Silver tables as a stream, one after the other: each is range-partitioned by event time into its number of
    files by one shuffle, and a micro-batch takes ``per_batch`` files. The sentinel's file is the last."""
    root = work_dir(spark, "replay", "delivered", unique=True)
    at, streams = 1_700_000_000_000, f"{root}/all"
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    sentinel = spark.read.schema(SILVER_SCHEMA).parquet(_sentinel_dir(spark))
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(streams))
    for i, (rows, files) in enumerate([*parts, (sentinel, 1)]):
        path = f"{root}/{i}"
        time_us = F.unix_micros(event_time("transaction_time"))
        rows.select(*TXN_COLS).repartitionByRange(files, time_us).write.parquet(path)
        at = _in_order(spark, path, at)
        for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(path)):
            if f.getPath().getName().startswith("part-"):
                fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(f"{streams}/{i:04d}-{f.getPath().getName()}"))
    return lake.read_silver_stream(spark, streams, per_batch)


def silver_slices(spark: SparkSession, sf_dir: str, batches: int = 4, per_batch: int = 4, late: bool = False) -> DataFrame:
    """Silver as a stream of ``batches`` micro-batches in event-time order: state carries over batch borders as it
    does in production. ``late`` sends the first quarter of the time line once more after the last batch."""
    silver = spark.read.schema(SILVER_SCHEMA).parquet(replay_silver(spark, sf_dir))
    parts = [(silver, batches * per_batch)]
    if late:
        at = F.unix_micros(event_time("transaction_time"))
        low, high = silver.agg(F.min(at), F.max(at)).first()
        parts.append((silver.where(at < F.lit((low or 0) + ((high or 0) - (low or 0)) // 4)), per_batch))
    return delivered(spark, parts, per_batch)


def run_to_table(df: DataFrame, spark: SparkSession, name: str, mode: str = "append") -> DataFrame:
    """Drain a streaming DataFrame into a Parquet table and read it back."""
    root = work_dir(spark, "replay", name, unique=True)
    with state_partitions(spark):
        q = write_stream(df, f"{root}/_ckpt", f"{root}/data", mode=mode, trigger=AVAILABLE_NOW)
    drain([q])
    return spark.read.schema(df.schema).parquet(f"{root}/data")


def run_updates(df: DataFrame, spark: SparkSession, name: str, keys: list[str]) -> DataFrame:
    """K6 replay: update-mode output, one row per key holding its latest
    emitted value. Each micro-batch is appended with its batch id through
    ``foreachBatch``; the newest row per key wins (an aggregate, not a sort
    of a whole group)."""
    root = work_dir(spark, "replay", name, unique=True)
    out = f"{root}/data"

    def _append(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    with state_partitions(spark):
        q = (
            df.writeStream.outputMode("update")
            .option("checkpointLocation", f"{root}/_ckpt")
            .foreachBatch(_append)
            .trigger(availableNow=True)
            .start()
        )
    drain([q])
    values = [c for c in df.columns if c not in keys]
    hist = spark.read.parquet(out)
    latest = hist.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in values]), F.col("_batch_id")).alias("_v")
    )
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


# --- layer replays used by the query registry ------------------------------------


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(SILVER_SCHEMA).parquet(replay_silver(spark, sf_dir)).select(*TXN_COLS)


def stream_high_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_to_table(rules.high_amount_gold(silver_stream(spark, sf_dir)), spark, "high_amount")


def stream_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    vel = rules.velocity_gold(silver_stream(spark, sf_dir, flush=True))
    return run_to_table(vel, spark, "velocity").filter(F.col("user_id") != SENTINEL_USER)


def stream_velocity_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    vel = rules.velocity_gold(silver_stream(spark, sf_dir))
    return run_updates(vel, spark, "velocity_update", ["user_id", "window"])


def _text_files(spark: SparkSession, sf_dir: str) -> str:
    """The transactions' wire JSON as text files, one record per line, and the sentinel's after them."""
    path = work_dir(spark, "replay", "text", unique=True)
    for rows in (read_transactions(spark, sf_dir), spark.read.schema(SILVER_SCHEMA).parquet(_sentinel_dir(spark))):
        ingest.to_wire_json(rows).select("value").write.mode("append").text(path)
    return path


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "replay", "bronze", unique=True)
    raw = lake.read_text_stream(spark, _text_files(spark, sf_dir))
    drain([start_bronze(raw, f"{root}/bronze", f"{root}/_ckpt", trigger=AVAILABLE_NOW)])
    return spark.read.parquet(f"{root}/bronze").filter(~F.col("value").contains(SENTINEL_USER))


def stream_detect(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """R8 over text records: tagged high-amount hits and velocity windows, each drained to a table."""
    high, vel = detect(lake.read_text_stream(spark, _text_files(spark, sf_dir)))
    out = [run_to_table(df, spark, f"detect_{name}") for df, name in ((high, "high"), (vel, "velocity"))]
    return tuple(df.filter(F.col("user_id") != SENTINEL_USER) for df in out)


def stream_velocity_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    vel = rules.velocity_gold(silver_slices(spark, sf_dir, late=True).select(*TXN_COLS))
    return run_to_table(vel, spark, "velocity_late").filter(F.col("user_id") != SENTINEL_USER)


def delayed_stream(spark: SparkSession, sf_dir: str, per_batch: int = 4) -> DataFrame:
    """Silver as a stream in event-time order whose every seventh row (by transaction number) arrives after all others."""
    silver = spark.read.schema(SILVER_SCHEMA).parquet(replay_silver(spark, sf_dir))
    delayed = F.coalesce(F.regexp_extract("transaction_id", "[0-9]+", 0).try_cast("long") % 7 == 3, F.lit(False))
    return delivered(spark, [(silver.where(~delayed), 2 * per_batch), (silver.where(delayed), per_batch)], per_batch)


def late_and_alerts(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The routed rows of the delayed stream (their folder) and the velocity alerts that the stream itself gives."""
    root = work_dir(spark, "replay", "late", unique=True)
    source = delayed_stream(spark, sf_dir)
    alerts = run_to_table(rules.velocity_gold(source), spark, "velocity_delayed")
    drain([late.start_routed(source, root, f"{root}/_ckpt", trigger=AVAILABLE_NOW)])
    return root, alerts


def stream_consolidated_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both hit streams, drained to tables, then consolidated as a stream of changes of a few files per micro-batch."""
    root = work_dir(spark, "replay", "changes", unique=True)
    with state_partitions(spark):
        queries = consolidate.start_hit_streams(silver_stream(spark, sf_dir, flush=True), f"{root}/hits", f"{root}/_ckpt", trigger=AVAILABLE_NOW)
    drain(queries)
    hits = [lake.read_parquet_stream(spark, f"{root}/hits/{n}", consolidate.HIT_STREAM_SCHEMA, 4).select(*HIT_COLS) for n in ("high_amount", "velocity")]
    out = run_to_table(changes.rule_set_changes(hits[0].unionByName(hits[1]), keep=None), spark, "changes")
    return changes.latest(out).filter(F.col("user_id") != SENTINEL_USER)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "replay", "redelivered", unique=True)
    redelivered(read_transactions(spark, sf_dir)).write.parquet(path)
    return run_to_table(ingest.dedup_stream(lake.read_silver_stream(spark, path)), spark, "dedup")
