"""Alert expansion (R6) and consolidation.

The velocity rule loses transaction detail (one row per user and window), so
its windows are joined back to silver to find the member transactions; the
result is unioned with the high-amount hits and collapsed to one row per
transaction with the set of rules it triggered.

Join forms (neither pairs whole groups: both join on equi keys)
* ``method="bucketed"`` (default): a pure equi-join on
  ``(user_id, window_start)``. Every transaction computes the start of the
  tumbling window it falls in; a transaction lying exactly on a window start
  also names the window before, because the reference joins with an
  inclusive ``BETWEEN start AND end``. The velocity side holds one row per
  key, so the join is many-to-one: no pair explosion, and a hot user is
  spread over all its windows instead of sitting on one sort-merge key.
  The length of the windows must be ``window``; a table with any other one
  fails instead of losing hits.
* ``method="range"``: the reference's literal predicate ``event_time BETWEEN
  start AND end`` on windows of any length. Windows name the minutes they
  touch, transactions the minute they fall in, and the predicate is a residual
  of the equi-join on (user, minute). (A join on ``user_id`` alone with that
  residual would pair every flagged window of a user with every transaction of
  the user before filtering; that form is deliberately not offered.)
* ``method="dyadic"``: the same predicate for windows of mixed and large lengths.
  A window is covered by O(log n) aligned cells of 1, 2, 4, ... base cells
  (``base``) instead of one per minute: 2,878 minutes are 22 cells. A transaction
  lies in one cell of each level and probes the levels that windows use, which
  are at most as many as the longest window has bits.

``closed="both"`` reproduces the reference (a transaction at exactly
``end`` is attached to the earlier window too); ``closed="left"`` attaches
transactions only to the window that counted them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.functions.columns import bucket_micros, event_time, interval_micros
from txnguard.schemas import (
    FRAUD_UNION_COLS,
    HIT_COLS,
    RULE_HIGH_AMOUNT,
    RULE_HIGH_VELOCITY,
    TXN_COLS,
    VELOCITY_WINDOW,
)


def flatten_windows(velocity_df: DataFrame) -> DataFrame:
    """``window`` struct → ``start``, ``end`` columns."""
    return (
        velocity_df.withColumn("start", F.col("window.start"))
        .withColumn("end", F.col("window.end"))
        .drop("window")
    )


def _candidates(silver: DataFrame, window: str, closed: str) -> DataFrame:
    """Silver rows with the start(s) of the window(s) they can belong to."""
    d = interval_micros(window)
    et = event_time(F.col("transaction_time"))
    b0 = bucket_micros(et, window)
    on_edge = F.unix_micros(et) == b0
    if closed == "both":
        starts = F.when(on_edge, F.array(b0, b0 - F.lit(d))).otherwise(F.array(b0))
    else:
        starts = F.array(b0)
    # NULL event time → NULL array → explode emits nothing (no range match).
    return silver.withColumn("_wstart_us", F.explode(starts))


def _checked_start(windows: DataFrame, window: str) -> Column:
    """Start of each window in microseconds; a window of another length than ``window`` fails the query.

    The check names the rule's count where there is one: a condition on the window alone would be pushed below
    the aggregate that made the windows and be evaluated for every transaction instead of every flagged window.
    """
    start, end = F.unix_micros(F.col("start")), F.unix_micros(F.col("end"))
    right = end - start == F.lit(interval_micros(window))
    if "count" in windows.columns:
        right = right & F.coalesce(F.col("count") >= 0, F.lit(True))
    wrong = F.raise_error(F.lit(f"a velocity window is not {window} long: pass the table's window length"))
    # rows without a time are not wrong, they have no key
    return F.when(start.isNull() | end.isNull(), F.lit(None)).when(right, start).otherwise(wrong.cast("long"))


def _by_bucket(windows: DataFrame, silver: DataFrame, window: str, closed: str) -> DataFrame:
    s = _candidates(silver, window, closed).alias("s")
    v = windows.withColumn("_wstart_us", _checked_start(windows, window)).alias("v")
    cond = (F.col("v.user_id") == F.col("s.user_id")) & (F.col("v._wstart_us") == F.col("s._wstart_us"))
    return v.join(s, cond, "inner")


def _by_range(windows: DataFrame, silver: DataFrame, closed: str) -> DataFrame:
    minute = F.lit(60_000_000)
    cell = lambda t: F.floor(F.unix_micros(t) / minute)
    v = windows.withColumn("_cell", F.explode(F.sequence(cell(F.col("start")), cell(F.col("end"))))).alias("v")
    s = silver.withColumn("_cell", cell(event_time(F.col("transaction_time")))).alias("s")
    et = event_time(F.col("s.transaction_time"))
    inside = et.between(F.col("v.start"), F.col("v.end")) if closed == "both" else (et >= F.col("v.start")) & (et < F.col("v.end"))
    return v.join(s, (F.col("v.user_id") == F.col("s.user_id")) & (F.col("v._cell") == F.col("s._cell")) & inside, "inner")


_LEVELS = 63  # bits of a cell number


def dyadic_cells(first: Column, last: Column) -> Column:
    """The fewest aligned cells (level, cell) that make up the base cells ``first`` to ``last`` and no other:
    two a level at most. Cell c of level l is the base cells c * 2^l up to (c + 1) * 2^l."""
    span = F.greatest(last - first, F.lit(0))
    top = F.least(F.floor(F.log2(span.cast("double") + 1)) + 1, F.lit(_LEVELS)).cast("int")

    def of_level(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        # what is left between the cells of smaller levels: [lo, hi) in cells of this one
        lo, hi = F.ceil(first / size).cast("long"), F.floor((last + 1) / size).cast("long")
        cell = lambda c: F.struct(level.alias("level"), c.alias("cell"))
        own = F.array(F.when((lo < hi) & (F.pmod(lo, F.lit(2)) == 1), cell(lo)), F.when((lo < hi) & (F.pmod(hi, F.lit(2)) == 1), cell(hi - 1)))
        # an odd lone cell is both the first and the last
        return F.array_distinct(F.array_compact(own))

    return F.flatten(F.transform(F.sequence(F.lit(0), top), of_level))


def windows_by_cell(windows: DataFrame, base: str) -> DataFrame:
    """One row per window and dyadic cell (``_level``, ``_cell``) of it."""
    size = F.lit(interval_micros(base))
    at = lambda t: F.floor(F.unix_micros(t) / size)
    cells = dyadic_cells(at(F.col("start")), at(F.col("end")))
    known = windows.where("start <= end")  # a window without a time, or that ends before it starts, holds nothing
    return known.withColumn("_c", F.explode(cells)).select(*windows.columns, F.col("_c.level").alias("_level"), F.col("_c.cell").alias("_cell"))


def _by_dyadic(windows: DataFrame, silver: DataFrame, closed: str, base: str) -> DataFrame:
    v = windows_by_cell(windows, base)
    # the levels in use: 63 numbers at most
    levels = sorted(r["_level"] for r in v.select("_level").distinct().collect())
    et = event_time(F.col("transaction_time"))
    cell = F.floor(F.unix_micros(et) / F.lit(interval_micros(base)))
    probes = F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright(cell, n).alias("cell")) for n in levels]) if levels else F.lit(None).cast("array<struct<level: int, cell: bigint>>")
    s = silver.where(et.isNotNull()).withColumn("_p", F.explode(probes))
    s = s.select(*silver.columns, F.col("_p.level").alias("_level"), F.col("_p.cell").alias("_cell"), et.alias("_et")).alias("s")
    v = v.alias("v")
    inside = F.col("s._et").between(F.col("v.start"), F.col("v.end")) if closed == "both" else (F.col("s._et") >= F.col("v.start")) & (F.col("s._et") < F.col("v.end"))
    keys = [F.col(f"v.{k}") == F.col(f"s.{k}") for k in ("user_id", "_level", "_cell")]
    return v.join(s, keys[0] & keys[1] & keys[2] & inside, "inner")


def expand_velocity(
    velocity_df: DataFrame,
    silver: DataFrame,
    method: str = "bucketed",
    window: str = VELOCITY_WINDOW,
    closed: str = "both",
    base: str = "1 minute",
) -> DataFrame:
    """Velocity windows × silver → one HIGH_VELOCITY hit per window and member row.

    Output layout is ``HIT_COLS`` (9 transaction columns + triggered_rule),
    with ``user_id`` taken from the window side as in the reference.
    """
    if closed not in ("both", "left"):
        raise ValueError("closed must be 'both' or 'left'")
    if method not in ("bucketed", "range", "dyadic"):
        raise ValueError(f"unknown method {method!r}")
    windows = flatten_windows(velocity_df).select("user_id", "start", "end", *(["count"] if "count" in velocity_df.columns else []))
    if method == "range":
        joined = _by_range(windows, silver, closed)
    elif method == "dyadic":
        joined = _by_dyadic(windows, silver, closed, base)
    else:
        joined = _by_bucket(windows, silver, window, closed)
    cols = [F.col("v.user_id") if c == "user_id" else F.col(f"s.{c}") for c in TXN_COLS]
    return joined.select(*cols, F.lit(RULE_HIGH_VELOCITY).alias("triggered_rule"))


def standardize_high_amount(high_df: DataFrame) -> DataFrame:
    """High-amount hits → ``HIT_COLS`` with triggered_rule tag."""
    return high_df.withColumn("triggered_rule", F.lit(RULE_HIGH_AMOUNT)).select(*HIT_COLS)


def union_hits(high_hits: DataFrame, velocity_hits: DataFrame) -> DataFrame:
    """UNION ALL by name, no dedup (grouping dedups afterwards)."""
    return high_hits.select(*HIT_COLS).unionByName(velocity_hits.select(*HIT_COLS))


def group_hits(hits: DataFrame) -> DataFrame:
    """A2: one row per distinct 9-column transaction with its rule set.

    ``collect_set`` order is undefined, so the set is sorted. Partial
    aggregation dedups rule names map-side; at most a handful of rules per
    key reach the shuffle, so a transaction delivered many times cannot grow
    a group.
    """
    return hits.groupBy(*TXN_COLS).agg(
        F.sort_array(F.collect_set("triggered_rule")).alias("triggered_rules")
    )


def consolidate(
    high_df: DataFrame,
    velocity_df: DataFrame,
    silver: DataFrame,
    method: str = "bucketed",
    window: str = VELOCITY_WINDOW,
    closed: str = "both",
) -> DataFrame:
    """Gold fraud_union = group(union(high hits, expanded velocity hits))."""
    hits = union_hits(
        standardize_high_amount(high_df),
        expand_velocity(velocity_df, silver, method=method, window=window, closed=closed),
    )
    return group_hits(hits).select(*FRAUD_UNION_COLS)
