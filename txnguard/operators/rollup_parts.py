"""The fraud rollup kept up day by day (D11): partials with stored sketches.

``day_partials`` aggregates an ingestion day once, at the finest grain (ingestion
day, event date, location, merchant): counts, sums and a HyperLogLog sketch of the
users, of all rows and of the flagged ones. The partials are a small table
partitioned by ingestion day; a rerun day is replaced, other days are not read.
``rollup_of`` adds partials up to every level of the rollup: counts and sums are
exact, users come from merged sketches, whose estimate is that of one sketch over
all the rows. An event that arrives days late adds to its own event date without
touching what earlier days wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.functions.columns import event_time
from txnguard.operators.marts import ROLLUP_DIMS
from txnguard.schemas import EVENT_DATE, INGEST_DATE

SKETCH_BITS = 12  # relative error near 1.6 % (one standard deviation)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumns({INGEST_DATE: F.to_date("ingestion_time"), EVENT_DATE: F.to_date(event_time("transaction_time"))})


def _side(df: DataFrame, prefix: str) -> DataFrame:
    """Partial figures of one side, named for it, others NULL after the union."""
    return _dated(df).groupBy(INGEST_DATE, *ROLLUP_DIMS).agg(
        F.count(F.lit(1)).alias(f"{prefix}_n"), F.sum("transaction_amount").alias(f"{prefix}_amount"), F.hll_sketch_agg("user_id", SKETCH_BITS).alias(f"{prefix}_users")
    )


def day_partials(silver: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per ingestion day, event date, location and merchant. ``hits``: one row per flagged transaction."""
    return _side(silver, "all").unionByName(_side(hits, "flagged"), allowMissingColumns=True)


def write_days(partials: DataFrame, path: str) -> None:
    """Add or replace the ingestion days that ``partials`` holds."""
    partials.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(INGEST_DATE).parquet(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def rollup_of(partials: DataFrame) -> DataFrame:
    """The rollup's columns from partials: one aggregate over the small table."""
    users = lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = partials.rollup(*ROLLUP_DIMS).agg(
        F.grouping_id().alias("grouping_level"),
        count("all_n").alias("n_txn"), F.round(F.sum("all_amount"), 2).alias("total_amount"), users("all_users").alias("n_users"),
        count("flagged_n").alias("n_flagged"), F.round(F.coalesce(F.sum("flagged_amount"), F.lit(0.0)), 2).alias("flagged_amount"), users("flagged_users").alias("n_flagged_users"),
    )
    return out.withColumn("flag_rate", F.col("n_flagged") / F.col("n_txn"))
