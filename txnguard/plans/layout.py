"""Z-order layout of a batch table (K7/S5): files that one user's hour touches are few.

``zorder_table`` rewrites date partitions so that rows near each other in (user
hash, event time) lie in the same files: a row's place is the interleaved bits of
both, made from JVM bit expressions, and a range partition on it cuts files of even
size. ``user_hash`` and ``event_us`` stay in the table, and their Parquet minimum and
maximum let a reader skip files and row groups; ``read_user_time`` states the
predicates. Sorting by either column alone would serve one kind of filter only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.functions.columns import event_time, interval_micros
from txnguard.plans.jobs import _dates_filter, is_stream_sink
from txnguard.schemas import EVENT_DATE
from txnguard.session import checkpoint_root

BITS = 16
USER_HASH, EVENT_US = "user_hash", "event_us"


def user_hash(user: Column) -> Column:
    """A user's place, 0 to 65,535; NULL users are a user like any other."""
    return F.pmod(F.xxhash64(user), F.lit(1 << BITS)).cast("int")


def spread(x: Column, bits: int = BITS) -> Column:
    """The low bits of a number with a zero bit before each: every step halves the blocks that move."""
    x = x.cast("long")
    step = bits // 2
    while step:
        mask = sum(((1 << step) - 1) << (2 * step * k) for k in range(bits // step))
        x = x.bitwiseOR(F.shiftleft(x, step)).bitwiseAND(F.lit(mask).cast("long"))
        step //= 2
    return x


def zvalue(first: Column, second: Column, bits: int = BITS) -> Column:
    """Interleaved bits of two numbers of ``bits`` bits, the first one's leading."""
    return F.shiftleft(spread(first, bits), 1).bitwiseOR(spread(second, bits))


def placed(df: DataFrame, cell: str = "15 minutes") -> DataFrame:
    """Rows with ``user_hash``, ``event_us`` and ``_z``; a row without a time lies at the start."""
    at = F.unix_micros(event_time("transaction_time"))
    of_day = F.floor(F.coalesce(F.col(EVENT_US), F.lit(0)) / F.lit(interval_micros(cell)))
    both = df.withColumns({USER_HASH: user_hash(F.col("user_id")), EVENT_US: at})
    return both.withColumn("_z", zvalue(F.col(USER_HASH), F.pmod(of_day, F.lit(1 << BITS))))


def zorder_table(spark: SparkSession, path: str, dates: list[str] | None = None, rows_per_file: int = 4_000_000, cell: str = "15 minutes") -> int:
    """Rewrite date partitions in Z-order; returns the number of range partitions. Not for streaming sink folders.

    The rows are checkpointed first, as the partitions they come from are overwritten. ``rows_per_file`` sizes the range
    partitions; a partition that meets several dates writes a file for each.
    """
    if is_stream_sink(spark, path):
        raise ValueError(f"{path} is a streaming sink folder; a rewrite would break its log")
    df = _dates_filter(spark.read.parquet(path).drop(USER_HASH, EVENT_US), dates)
    checkpoint_root(spark)
    rows = placed(df, cell).checkpoint(eager=True)
    parts = max(1, -(-rows.count() // rows_per_file))
    by = ([EVENT_DATE] if EVENT_DATE in df.columns else []) + ["_z"]
    writer = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_z").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(EVENT_DATE) if EVENT_DATE in df.columns else writer).parquet(path)
    return parts


def read_user_time(spark: SparkSession, path: str, user: str | None, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """A user's rows in [start, end) of a Z-ordered table; the predicates on ``user_hash`` and ``event_us`` reach the scan."""
    place = spark.range(1).select(user_hash(F.lit(user).cast("string")).alias("h")).first()["h"]
    micros = lambda t: int(t.replace(tzinfo=t.tzinfo or dt.timezone.utc).timestamp() * 1_000_000)
    rows = spark.read.parquet(path).where((F.col(USER_HASH) == place) & (F.col(EVENT_US) >= micros(start)) & (F.col(EVENT_US) < micros(end)))
    return rows.where(F.col("user_id").eqNullSafe(F.lit(user)))
