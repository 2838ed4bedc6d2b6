"""Risk rules R1 (high amount & international) and R2 (velocity).

Both are ``DataFrame -> DataFrame`` and run unchanged on batch and streaming
inputs (``withWatermark`` is a no-op in batch).

Scale notes
* ``high_amount`` is a stateless filter written on source columns, so
  ``transaction_amount > t AND is_international`` reaches the Parquet scan as
  pushed filters; no shuffle.
* ``velocity`` groups by (user, 60 s window): a partial count runs map-side,
  so the shuffle carries at most one row per (user, window) per input task,
  and a hot user is spread over all its windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.columns import event_time
from txnguard.schemas import (
    FRAUD_TYPE_HIGH_AMOUNT,
    FRAUD_TYPE_VELOCITY,
    HIGH_AMOUNT_THRESHOLD,
    VELOCITY_MIN_EXCLUSIVE,
    VELOCITY_WATERMARK,
    VELOCITY_WINDOW,
)


def high_amount(df: DataFrame, threshold: float = HIGH_AMOUNT_THRESHOLD) -> DataFrame:
    """Keep transactions with amount > threshold that are international.

    Adds ``high_amount_flag``, ``intl_flag`` and ``is_fraud``; rows where
    ``is_fraud`` is false or NULL are dropped (NULL amount or flag → dropped).
    The filter is stated on the source columns so Catalyst can push it into
    the scan; it is equivalent to ``is_fraud = true``.
    """
    amount_hit = F.col("transaction_amount") > F.lit(float(threshold))
    intl_hit = F.col("is_international") == F.lit(True)
    return (
        df.filter(amount_hit & intl_hit)
        .withColumn("high_amount_flag", amount_hit)
        .withColumn("intl_flag", intl_hit)
        .withColumn("is_fraud", F.col("high_amount_flag") & F.col("intl_flag"))
    )


def velocity(
    df: DataFrame,
    window: str = VELOCITY_WINDOW,
    min_exclusive: int = VELOCITY_MIN_EXCLUSIVE,
    watermark: str | None = VELOCITY_WATERMARK,
    time_col: str = "transaction_time",
) -> DataFrame:
    """R2: (user, tumbling window) with more than ``min_exclusive`` events.

    Output: ``user_id, window struct<start,end>, count``. Rows whose time
    text does not parse get a NULL event time and are ignored by ``window``.
    NULL users form one group (GROUP BY semantics).
    """
    timed = df.select("user_id", event_time(time_col).alias("event_time"))
    if watermark:
        timed = timed.withWatermark("event_time", watermark)
    counts = timed.groupBy(F.col("user_id"), F.window(F.col("event_time"), window)).count()
    return counts.filter(F.col("count") > F.lit(int(min_exclusive)))


def tag(df: DataFrame, fraud_type: str) -> DataFrame:
    """Constant ``fraud_type`` column used by the gold tables."""
    return df.withColumn("fraud_type", F.lit(fraud_type))


def high_amount_gold(df: DataFrame, threshold: float = HIGH_AMOUNT_THRESHOLD) -> DataFrame:
    """Gold high-amount table layout: 9 silver columns + 3 flags + tag."""
    return tag(high_amount(df, threshold), FRAUD_TYPE_HIGH_AMOUNT)


def velocity_gold(df: DataFrame, **kwargs) -> DataFrame:
    """Gold velocity table layout: user_id, window, count, fraud_type."""
    return tag(velocity(df, **kwargs), FRAUD_TYPE_VELOCITY)


def tagged_union(high_tagged: DataFrame, velocity_tagged: DataFrame) -> DataFrame:
    """One table of both tagged rule outputs (13 and 4 columns); columns
    missing on a side are NULL. Stateless, so it also unions two streams."""
    return high_tagged.unionByName(velocity_tagged, allowMissingColumns=True)
