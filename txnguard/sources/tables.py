"""Driver test tables and the events → transactions mapping.

The driver tables hold no card transactions; ``transactions_from_events``
maps the ``events`` table onto the 9-column silver layout. Time is
compressed 1440× (one day → one minute) so the 60-second velocity window sees
realistic bursts. The mapping is a single projection: it streams through the
scan with no shuffle, and it works on a streaming ``events`` DataFrame too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.schemas import LOCATION_DOMAIN, MERCHANT_DOMAIN, TXN_COLS

# --- fixed values of the events → transactions mapping -------------------------
# merchant and location lists: MERCHANT_DOMAIN / LOCATION_DOMAIN in schemas.py
TIME_ORIGIN_MICROS = 1704067200000000      # 2024-01-01T00:00:00 UTC
TIME_COMPRESSION = 1440                    # one day of events → one minute
AMOUNT_SCALE = 100.0                       # event value → amount
INGESTION_DELAY = "INTERVAL 5 SECOND"      # ts + 5 s → ingestion_time
N_DEVICES = 50
TIME_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# --- end of fixed values ---------------------------------------------------------

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int") + 1)


def transactions_from_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, value, props) → silver transactions."""
    k = F.get_json_object("props", "$.k").cast("int")
    ts_us = F.unix_micros(F.col("ts").cast("timestamp"))
    compressed = F.timestamp_micros(
        F.lit(TIME_ORIGIN_MICROS) + F.floor((ts_us - F.lit(TIME_ORIGIN_MICROS)) / TIME_COMPRESSION)
    )
    return events.select(
        F.concat(F.lit("txn_"), F.col("event_id")).alias("transaction_id"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("user_id"),
        _pick(MERCHANT_DOMAIN, F.col("event_id") % 5).alias("merchant_id"),
        (F.col("value") * F.lit(AMOUNT_SCALE)).alias("transaction_amount"),
        F.date_format(compressed, TIME_TEXT_FORMAT).alias("transaction_time"),
        F.concat(F.lit("device_"), (k % N_DEVICES + 1)).alias("device_id"),
        _pick(LOCATION_DOMAIN, (F.col("event_id") / 7).cast("long") % 5).alias("location"),
        (k % 2 == 1).alias("is_international"),
        (F.col("ts") + F.expr(INGESTION_DELAY)).cast("timestamp").alias("ingestion_time"),
    )


def read_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver transactions derived from ``events`` (column-pruned scan)."""
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    return transactions_from_events(events).select(*TXN_COLS)


def noisy_bronze(txns: DataFrame, events: DataFrame) -> DataFrame:
    """A topic carrying mixed payloads, derived from the whole events table.

    Every event arrives three times: as the wire JSON of its transaction, as
    its raw ``props`` text (valid JSON without any event field) and as its
    bare ``event_type`` word (not JSON). Schema enforcement must keep the
    first and quarantine the other two.
    """
    ingest = (F.col("ts") + F.expr(INGESTION_DELAY)).cast("timestamp").alias("ingestion_time")
    wire = txns.select(
        F.to_json(F.struct(*[F.col(c) for c in TXN_COLS[:-1]])).alias("value"), "ingestion_time"
    )
    props = events.select(F.col("props").alias("value"), ingest)
    words = events.select(F.col("event_type").alias("value"), ingest)
    return wire.unionByName(props).unionByName(words)


def redelivered(txns: DataFrame, delay: str = "INTERVAL 1 MINUTE") -> DataFrame:
    """At-least-once delivery: every transaction delivered a second time,
    ``delay`` later (same payload, later ingestion_time)."""
    again = txns.withColumn("ingestion_time", F.col("ingestion_time") + F.expr(delay))
    return txns.unionByName(again)
