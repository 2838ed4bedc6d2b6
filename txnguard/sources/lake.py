"""Lake and stream sources.

* S1 ``read_kafka`` — Kafka topic as an unbounded stream of opaque records.
  The Kafka connector jar is not bundled with PySpark; on a cluster add
  ``org.apache.spark:spark-sql-kafka-0-10`` to ``spark.jars.packages``.
  ``read_text_stream`` yields the same ``value`` column from files and is
  what the tests drive.
* S2/S3 streaming Parquet scans of bronze / silver with explicit schemas.
* S4–S6 batch Parquet scans of gold velocity, silver and gold high-amount.

Batch reads of partitioned tables (``event_date=...``) prune partitions
when the caller filters on ``event_date``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.operators import rules
from txnguard.schemas import BRONZE_SCHEMA, EVENT_DATE, SILVER_SCHEMA

STATUS = "_status"  # partition column of a checked silver folder: valid or rejected

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def read_kafka(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = "transactions",
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """``key, value, topic, partition, offset, timestamp, ...`` stream.

    Default ``earliest``: bronze is meant to hold everything ever published
    (the reference used ``latest`` and lost what came before first start).
    ``maxOffsetsPerTrigger`` bounds a micro-batch after downtime;
    ``minPartitions`` splits large topic partitions over several tasks, so a
    hot partition does not become one long task.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "true")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stand-in for S1: one record per line in ``value`` (string)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def _parquet_stream(spark, schema, path, max_files_per_trigger, glob=None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def read_parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Any Parquet table (e.g. a partitioned hit table) as a stream."""
    return _parquet_stream(spark, schema, path, max_files_per_trigger)


def read_bronze_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Bronze directory as a stream (value string, ingestion_time)."""
    return _parquet_stream(spark, BRONZE_SCHEMA, path, max_files_per_trigger)


def read_silver_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: silver directory as a stream (9 columns, and the partition columns of
    the folder). Of a checked silver folder (``_status`` partitions) only the
    valid rows are read: rejected ones never reach a rule."""
    schema = T.StructType([*SILVER_SCHEMA.fields, T.StructField(STATUS, T.StringType())])
    rows = _parquet_stream(spark, schema, path, max_files_per_trigger)
    return rows.filter(F.col(STATUS).isNull() | (F.col(STATUS) == "valid")).drop(STATUS)


def read_events_stream(
    spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The driver ``events`` table as a file stream (one table picked out of
    the mixed directory by glob)."""
    return _parquet_stream(spark, EVENTS_SCHEMA, sf_dir, max_files_per_trigger, glob="events.parquet")


def read_velocity(spark: SparkSession, path: str) -> DataFrame:
    """Gold velocity table (batch); a table without a file reads as empty."""
    return spark.read.schema(_dated(rules.velocity_gold(_no_silver(spark)))).parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver table (batch)."""
    return spark.read.schema(_dated(_no_silver(spark))).parquet(path)


def read_high_amount(spark: SparkSession, path: str) -> DataFrame:
    """Gold high-amount table (batch)."""
    return spark.read.schema(_dated(rules.high_amount_gold(_no_silver(spark)))).parquet(path)


def _no_silver(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SILVER_SCHEMA)


def _dated(df: DataFrame) -> T.StructType:
    """The columns of a lake table that holds ``df``'s rows by event date."""
    return T.StructType([*df.schema.fields, T.StructField(EVENT_DATE, T.DateType())])
