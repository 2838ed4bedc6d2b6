"""Splitting hot groups by order: even parts and carries (a segmented prefix scan).

A running value over the ordered rows of a group needs the group in one place only
if it is computed in one go. Here a group of more than ``max_rows`` rows is cut into
parts of consecutive rows:

1. groups are counted (partial aggregation); only the hot ones go on;
2. each hot group gets splitters from a sample of its own order keys, chosen by
   hash, so they depend on the data alone and are the same when a task runs again.
   The sample's rate is fixed by the group's size, so it holds a bounded number of
   keys whatever the size;
3. a row's part is the number of splitters at or below its key.

Parts are in order, so a running value is the part's *carry*, a prefix over the
small table of part sums, plus the running value inside the part. Rows of groups that
are not hot have part 0 and cost one count more than without this.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 100_000  # rows that a window or sorting task gets on average

PART = "_part"
SAMPLES_PER_PART = 16  # sampled order keys from which one splitter is taken
MOST_PARTS = 4096


def tasks_for(rows: DataFrame) -> int:
    """Partitions for a pass over ``rows``, so that a task's rows do not grow with the input; at least the default parallelism.
    A shuffle setting, and adaptive coalescing down to the number of cores, would let them grow."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_PER_TASK))


def splitters(rows: DataFrame, keys: list[str], order: list[str], max_rows: int) -> DataFrame:
    """(keys, _cuts): ascending order keys that cut every group of more than ``max_rows`` rows into about even parts."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(int(max_rows)))
    sizes = sizes.withColumn("_parts", F.least(F.ceil(F.col("_n") / F.lit(int(max_rows))) + 1, F.lit(MOST_PARTS)))
    # keys are matched as one struct value: NULL users are a group like any other
    key = F.struct(*keys)
    hot = sizes.select(key.alias("_g"), "_parts", F.ceil(F.col("_n") / (F.col("_parts") * SAMPLES_PER_PART)).alias("_rate"))
    point = F.struct(*order)
    sampled = rows.select(key.alias("_g"), point.alias("_o"), F.xxhash64(*order, F.lit("part")).alias("_h")).join(hot, "_g")
    sampled = sampled.where(F.pmod(F.col("_h"), F.col("_rate")) == 0)
    found = sampled.groupBy("_g").agg(F.array_sort(F.collect_set("_o")).alias("_all"), F.first("_parts").alias("_parts"))
    step = F.greatest(F.lit(1), F.floor(F.size("_all") / F.col("_parts"))).cast("int")
    places = F.filter(F.sequence(step, F.greatest(step, F.size("_all") - 1), step), lambda i: i < F.size("_all"))
    return found.select("_g", F.transform(places, lambda i: F.get("_all", i)).alias("_cuts"))


def with_parts(rows: DataFrame, keys: list[str], order: list[str], max_rows: int, broadcast_groups: int = 10_000) -> DataFrame:
    """``rows`` with ``_part``: 0 in groups of up to ``max_rows`` rows, else the number of the row's part in its group.

    Rows whose ``order`` columns are equal share a part. The hot groups are counted before the join: up to
    ``broadcast_groups`` of them are broadcast, more are joined by a shuffle on the group.
    """
    from txnguard.session import checkpoint_root

    checkpoint_root(rows.sparkSession)
    cuts = splitters(rows, keys, order, max_rows).checkpoint(eager=True)
    n = cuts.count()
    if not n:
        return rows.withColumn(PART, F.lit(0))
    point = F.struct(*order)
    joined = rows.withColumn("_g", F.struct(*keys)).join(F.broadcast(cuts) if n <= broadcast_groups else cuts, "_g", "left")
    part = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= point)), F.lit(0))
    return joined.withColumn(PART, F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(part)).drop("_g", "_cuts")


def carried(totals: DataFrame, keys: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """The small table of part ``totals`` with a prefix for each sum: what all earlier parts of the same ``keys`` add up to.
    ``sums`` maps a column to the name of its prefix; parts are in ``order``."""
    from pyspark.sql import Window

    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.lit(0).cast(totals.schema[c].dataType)
    return totals.select(*keys, *order, *[F.coalesce(F.sum(c).over(before), zero(c)).alias(name) for c, name in sums.items()])


def last_of_part(rows: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """(keys, _part, _last): the last row's order key and ``values`` of every part, one row each."""
    whole: Column = F.struct(*order, *[v for v in values if v not in order])
    return rows.groupBy(*keys, PART).agg(F.max(whole).alias("_last"))
