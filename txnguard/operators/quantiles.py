"""Column quantiles from mergeable sketches (the second half of the column profile, D14).

``day_sketches`` makes one KLL sketch per column and day in a single pass with
partial aggregation: a task ships one sketch of bounded size per column and day,
whatever number of rows it read. Sketches are small rows of a table that can be
kept: a new day is added, a rerun day replaced, and any range of days is merged
(``merged``) without reading the transactions again. Merging loses nothing: the
error bound is the one of a single sketch over all the rows.

Every column has quantiles, of its *measure*: numbers are themselves, timestamps
their epoch seconds, booleans 0 and 1, texts their length. The event time text
counts as a timestamp. NULL and NaN measures have no rank and are only counted.

Rank error: the true rank of a returned value lies within ``rank_error(k)`` of
the one asked for, with 99 % probability for one quantile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.functions.columns import event_time
from txnguard.schemas import EVENT_DATE

DEFAULT_K = 400
DEFAULT_PROBS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
TIME_TEXT = "transaction_time"


def rank_error(k: int) -> float:
    """Single-sided normalised rank error of a KLL sketch (the published fit for its 99 % bound)."""
    return 2.296 / k**0.9723


def measure(df: DataFrame, column: str) -> Column:
    """The number that a column's quantiles are of; NULL where it has none."""
    c, kind = F.col(column), df.schema[column].dataType
    if column == TIME_TEXT and isinstance(kind, T.StringType):
        c, kind = event_time(column), T.TimestampType()
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        value = F.unix_micros(c.cast("timestamp")) / F.lit(1e6)
    elif isinstance(kind, T.NumericType):
        value = c.cast("double")
    elif isinstance(kind, T.BooleanType):
        value = c.cast("int").cast("double")
    else:
        value = F.length(c.cast("string")).cast("double")
    return F.when(~F.isnan(value), value)


def _dated(df: DataFrame) -> DataFrame:
    return df if EVENT_DATE in df.columns else df.withColumn(EVENT_DATE, F.to_date(event_time(TIME_TEXT)))


def day_sketches(df: DataFrame, columns: list[str] | None = None, k: int = DEFAULT_K) -> DataFrame:
    """(event_date, column_name, n_values, sketch) of every column and day; rows without a time lie under a NULL day."""
    columns = columns or [c for c in df.columns if c != EVENT_DATE]
    measured = _dated(df).select(EVENT_DATE, *[measure(df, c).alias(c) for c in columns])
    aggs = [x for c in columns for x in (F.count(c).alias(f"{c}__n"), F.kll_sketch_agg_double(c, k).alias(f"{c}__s"))]
    wide = measured.groupBy(EVENT_DATE).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("n_values"), F.col(f"{c}__s").alias("sketch")) for c in columns]
    return wide.select(EVENT_DATE, F.explode(F.array(*rows)).alias("_p")).select(EVENT_DATE, "_p.*")


def merged(sketches: DataFrame, by: list[str] | None = None, k: int = DEFAULT_K) -> DataFrame:
    """The sketches of each column, joined over the days (or of each value of ``by``)."""
    by = ["column_name"] if by is None else by
    return sketches.groupBy(*by).agg(F.sum("n_values").alias("n_values"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def _name(p: float) -> str:
    return f"q{round(p * 1000):03d}"


def quantiles(sketches: DataFrame, probs: tuple[float, ...] = DEFAULT_PROBS) -> DataFrame:
    """``sketch`` replaced by min_measure, max_measure (exact) and a column per quantile (q050 = 5 %); NULL without values."""
    at = lambda p: F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))))
    named = [at(0.0).alias("min_measure"), at(1.0).alias("max_measure"), *[at(p).alias(_name(p)) for p in probs]]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], *named)


def within_error(df: DataFrame, found: DataFrame, probs: tuple[float, ...] = DEFAULT_PROBS, tolerance: float = 2 * rank_error(DEFAULT_K)) -> DataFrame:
    """``found`` quantiles checked against the rows: each becomes a boolean, whether some rank that its value has among
    the column's values lies within ``tolerance`` of the one asked for.

    One more pass with partial aggregation: ``found`` holds one row per column, so it is broadcast, and every value of a
    row is compared with its column's quantiles.
    """
    columns = [r["column_name"] for r in found.select("column_name").collect()]  # one row per column of the table
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), measure(df, c).alias("v")) for c in columns])).alias("_c")).select("_c.*")
    cells = cells.where("v is not null").join(F.broadcast(found), "column_name")
    counts = [F.count(F.when(op, 1)).alias(f"{_name(p)}{end}") for p in probs for end, op in (("_lt", F.col("v") < F.col(_name(p))), ("_le", F.col("v") <= F.col(_name(p))))]
    ranks = cells.groupBy("column_name").agg(F.count(F.lit(1)).alias("_n"), *counts)
    checks = [
        ((F.col(f"{_name(p)}_lt") <= (p + tolerance) * F.col("_n")) & (F.col(f"{_name(p)}_le") >= (p - tolerance) * F.col("_n"))).alias(f"{_name(p)}_ok")
        for p in probs
    ]
    return found.drop(*[_name(p) for p in probs]).join(F.broadcast(ranks.select("column_name", *checks)), "column_name", "left")


def profile_quantiles(df: DataFrame, probs: tuple[float, ...] = DEFAULT_PROBS, columns: list[str] | None = None, k: int = DEFAULT_K) -> DataFrame:
    """One row per column: n_values, exact extremes and estimated quantiles of its measure over all days."""
    return quantiles(merged(day_sketches(df, columns, k), k=k), probs)
