"""Gold marts described in the reference prose.

Scale notes
* Every mart is an aggregate with partial aggregation map-side; no mart
  shuffles raw silver rows.
* D11 rolls up the totals (over silver) and the flagged figures (over the
  consolidated hits) separately and joins the two small rollup outputs on
  their grouping keys, instead of joining every silver row to the hits.
* Distinct counts default to HyperLogLog (``approx_count_distinct``: fixed
  size sketches merged across tasks). ``exact=True`` uses exact distinct
  counts, which Spark plans as an Expand + two-level aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.functions.columns import event_time, risk_score
from txnguard.schemas import EVENT_DATE, TXN_COLS

ROLLUP_DIMS = [EVENT_DATE, "location", "merchant_id"]


def _distinct(c: str, exact: bool) -> Column:
    return F.count_distinct(F.col(c)) if exact else F.approx_count_distinct(F.col(c))


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn(EVENT_DATE, F.to_date(event_time("transaction_time")))


def metrics_rollup(silver: DataFrame, hits: DataFrame, exact: bool = False) -> DataFrame:
    """Fraud metrics by rollup(event_date, location, merchant_id).

    ``hits`` is the consolidated table (one row per flagged transaction).
    Subtotal rows carry NULL in the rolled-up dimensions and their level in
    ``grouping_level`` (0 = finest, 7 = grand total).
    """
    total = (
        _dated(silver)
        .rollup(*ROLLUP_DIMS)
        .agg(
            F.grouping_id().alias("grouping_level"),
            F.count(F.lit(1)).alias("n_txn"),
            F.round(F.sum("transaction_amount"), 2).alias("total_amount"),
            _distinct("user_id", exact).alias("n_users"),
        )
    )
    flagged = (
        _dated(hits)
        .rollup(*ROLLUP_DIMS)
        .agg(
            F.grouping_id().alias("grouping_level"),
            F.count(F.lit(1)).alias("n_flagged"),
            F.round(F.sum("transaction_amount"), 2).alias("flagged_amount"),
            _distinct("user_id", exact).alias("n_flagged_users"),
        )
    )
    t, f = total.alias("t"), flagged.alias("f")
    cond = F.col("t.grouping_level") == F.col("f.grouping_level")
    for d in ROLLUP_DIMS:
        cond = cond & F.col(f"t.{d}").eqNullSafe(F.col(f"f.{d}"))
    return t.join(f, cond, "left").select(
        *[F.col(f"t.{d}") for d in ROLLUP_DIMS],
        F.col("t.grouping_level"),
        "n_txn",
        "total_amount",
        "n_users",
        F.coalesce("n_flagged", F.lit(0)).alias("n_flagged"),
        F.coalesce("flagged_amount", F.lit(0.0)).alias("flagged_amount"),
        F.coalesce("n_flagged_users", F.lit(0)).alias("n_flagged_users"),
        (F.coalesce("n_flagged", F.lit(0)) / F.col("n_txn")).alias("flag_rate"),
    )


def user_features(silver: DataFrame, hits: DataFrame, exact: bool = False) -> DataFrame:
    """One feature row per user (history totals, diversity, flags)."""
    et = event_time("transaction_time")
    base = silver.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_txn"),
        F.round(F.sum("transaction_amount"), 2).alias("total_amount"),
        F.round(F.avg("transaction_amount"), 2).alias("avg_amount"),
        F.max("transaction_amount").alias("max_amount"),
        _distinct("device_id", exact).alias("n_devices"),
        _distinct("location", exact).alias("n_locations"),
        _distinct("merchant_id", exact).alias("n_merchants"),
        F.count(F.when(F.col("is_international"), 1)).alias("n_international"),
        F.min(et).alias("first_seen"),
        F.max(et).alias("last_seen"),
    )
    per_user_hits = hits.groupBy(F.col("user_id").alias("_hu")).agg(F.count(F.lit(1)).alias("n_flagged"))
    # null-safe: the NULL-user group keeps its flagged count too
    joined = base.join(per_user_hits, base["user_id"].eqNullSafe(per_user_hits["_hu"]), "left")
    return joined.drop("_hu").withColumn("n_flagged", F.coalesce("n_flagged", F.lit(0)))


def report(consolidated: DataFrame) -> DataFrame:
    """Consolidated hits + score + ``event_date`` partition column."""
    return (
        _dated(consolidated)
        .withColumn("n_rules", F.size("triggered_rules"))
        .withColumn("risk_score", risk_score("n_rules"))
        .select(*TXN_COLS, "triggered_rules", "n_rules", "risk_score", EVENT_DATE)
    )


def _distinct_key(df: DataFrame, c: str) -> Column:
    """Value of ``c`` as text for distinct counting; -0.0 is folded into 0.0
    (typed DISTINCT treats them as one value)."""
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        col = F.when(col == 0, F.lit(0.0)).otherwise(col)
    return col.cast("string")


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, min, max.

    One aggregate pass gives a single wide row (NULL counts, typed min/max,
    and HyperLogLog distinct counts unless ``exact``), unpivoted to one row
    per column. Exact distinct counts come from a long form instead — one
    (column, value) row per cell, deduplicated by a partial aggregate
    map-side, then counted per column — which is cheaper than Spark's
    Expand-based plan for many distinct aggregates in one query.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in df.columns:
        aggs += [
            F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}__nulls"),
            F.min(c).cast("string").alias(f"{c}__min"),
            F.max(c).cast("string").alias(f"{c}__max"),
        ]
        if not exact:
            aggs.append(F.approx_count_distinct(F.col(c)).alias(f"{c}__distinct"))
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}__nulls").alias("n_null"),
            (F.lit(None).cast("long") if exact else F.col(f"{c}__distinct")).alias("n_distinct"),
            F.col(f"{c}__min").alias("min_value"),
            F.col(f"{c}__max").alias("max_value"),
        )
        for c in df.columns
    ]
    per_column = wide.select("n_rows", F.explode(F.array(*rows)).alias("_p")).select("_p.*", "n_rows")
    if not exact:
        return per_column
    cells = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), _distinct_key(df, c).alias("v")) for c in df.columns])
        ).alias("_c")
    ).select("_c.*")
    distinct = (
        cells.filter(F.col("v").isNotNull())
        .dropDuplicates(["column_name", "v"])
        .groupBy("column_name").agg(F.count(F.lit(1)).alias("_nd"))
    )
    # both sides have one row per column
    out = per_column.drop("n_distinct").join(F.broadcast(distinct), "column_name", "left")
    return out.select(
        "column_name", "n_null", F.coalesce("_nd", F.lit(0)).alias("n_distinct"), "min_value", "max_value", "n_rows"
    )
