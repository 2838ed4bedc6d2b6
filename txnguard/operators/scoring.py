"""Risk score (D6) and label (D7) over all rule hits.

Every rule yields standardised hits (9 transaction columns + rule name);
their union is grouped once per transaction (as in consolidation, A2) and
scored by the number of distinct rules: 1 → 0.30, 2 → 0.60, ≥3 → 0.90.
``is_fraud`` is 1 when the score reaches ``cutoff`` (the prose leaves the
cutoff open; default 0.6 = two independent rules).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.functions.columns import event_time, interval_micros, risk_score
from txnguard.operators import behaviour as B
from txnguard.operators import consolidate as C
from txnguard.operators import rules as R
from txnguard.operators.parts import tasks_for
from txnguard.schemas import HIGH_AMOUNT_THRESHOLD, HIT_COLS, RULE_HIGH_AMOUNT, RULE_HIGH_VELOCITY, TXN_COLS, VELOCITY_MIN_EXCLUSIVE


def all_hits(
    silver: DataFrame,
    max_gap: str = "5 minutes",
    max_age: str = "7 days",
    factor: float = 3.0,
) -> DataFrame:
    """Union of the standardised hits of every rule (UNION ALL, no dedup)."""
    parts = [
        C.standardize_high_amount(R.high_amount(silver)),
        C.expand_velocity(R.velocity(silver), silver),
        B.as_hits(B.amount_vs_history(silver, factor=factor), B.RULE_AMOUNT_VS_AVG),
        B.as_hits(B.location_jump(silver, max_gap=max_gap), B.RULE_LOCATION_JUMP),
        B.as_hits(B.new_device(silver), B.RULE_NEW_DEVICE),
        B.as_hits(B.young_account(silver, max_age=max_age), B.RULE_YOUNG_ACCOUNT),
    ]
    return reduce(lambda a, b: a.unionByName(b), [p.select(*HIT_COLS) for p in parts])


_MINUTE = 60_000_000


def fused_hits(
    silver: DataFrame,
    max_gap: str = "5 minutes",
    max_age: str = "7 days",
    factor: float = 3.0,
) -> DataFrame:
    """``all_hits`` in three scans instead of ten: R1, R2 with its expansion, D1,
    D3 and D5 in one pass over (user, time bucket), beside the small per-bucket
    table; D4 is one aggregate over (user, device).

    A bucket is a whole number of minutes, so the tumbling windows of R2 lie in
    one bucket each. Rows are copied where another bucket needs them: the last
    ``max_gap`` of a bucket into the next one (D3), and a row exactly on a minute
    into the minute before, whose inclusive end it is (J1). Both passes have as many
    partitions as the rows need, so a task's memory does not grow with the input.
    """
    tasks = tasks_for(silver)
    gap_us, age_us = interval_micros(max_gap), interval_micros(max_age)
    size = -(-max(10 * gap_us, _MINUTE) // _MINUTE) * _MINUTE
    us, amount = F.col("_us"), F.col("transaction_amount")
    rows = (
        silver.select(*TXN_COLS)
        .withColumn("_us", F.unix_micros(event_time("transaction_time")))
        .withColumn("_uk", F.coalesce(F.col("user_id"), F.lit("")))
        .withColumn("_un", F.col("user_id").isNull())
        # rows without a time take part in R1 alone; they are spread, not gathered in one bucket
        .withColumn("_b", F.coalesce(us - F.pmod(us, F.lit(size)), F.xxhash64("transaction_id")))
    )
    per_bucket = rows.filter(us.isNotNull()).groupBy("_uk", "_un", "_b").agg(
        F.sum(amount).alias("_bs"), F.count(amount).alias("_bn"), F.min("_us").alias("_bf")
    )
    user = Window.partitionBy("_uk", "_un")
    before = user.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_bucket.select(
        "_uk", "_un", "_b",
        F.coalesce(F.sum("_bs").over(before), F.lit(0.0)).alias("_ps"),
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_pn"),
        F.min("_bf").over(user).alias("_first"),
    )

    minute = us - F.pmod(us, F.lit(_MINUTE))
    last_minute = minute - F.lit(_MINUTE)
    place = lambda b, m, kind: F.struct(b.alias("b"), m.alias("m"), F.lit(kind).alias("kind"))
    places = F.array_compact(F.array(
        place(F.col("_b"), minute, 0),
        F.when(us >= F.col("_b") + F.lit(size - gap_us), place(F.col("_b") + F.lit(size), minute, 1)),
        F.when(us == minute, place(last_minute - F.pmod(last_minute, F.lit(size)), last_minute, 2)),
    ))
    placed = rows.withColumn("_at", F.explode(places)).withColumn("_b", F.col("_at.b"))
    placed = placed.withColumn("_m", F.col("_at.m")).withColumn("_kind", F.col("_at.kind")).drop("_at")
    placed = placed.repartition(tasks, "_uk", "_un", "_b")

    own, timed = F.col("_kind") == 0, us.isNotNull()
    bucket = Window.partitionBy("_uk", "_un", "_b")
    earlier = bucket.orderBy("_us", "transaction_id").rowsBetween(Window.unboundedPreceding, -1)
    own_amount = F.when(own, amount)
    seen = placed.join(prefix, ["_uk", "_un", "_b"], "left")
    seen = seen.withColumns({
        "_in_minute": F.sum(F.when(own & timed, 1).otherwise(0)).over(Window.partitionBy("_uk", "_un", "_b", "_m")),
        "_wn": F.count(own_amount).over(earlier),
        "_ws": F.sum(own_amount).over(earlier),
        "_prev": F.last(F.when(F.col("_kind") < 2, F.struct("_us", "location")), ignorenulls=True).over(earlier),
    }).filter(F.col("_kind") != 1)

    prior_n = F.coalesce("_pn", F.lit(0)) + F.col("_wn")
    prior_avg = (F.coalesce("_ps", F.lit(0.0)) + F.coalesce("_ws", F.lit(0.0))) / prior_n
    high = amount > F.lit(HIGH_AMOUNT_THRESHOLD)
    # each rule, and whether it looks at a row in its own place only
    rules = {
        RULE_HIGH_AMOUNT: own & high & F.col("is_international"),
        RULE_HIGH_VELOCITY: timed & ~F.col("_un") & (F.col("_in_minute") > F.lit(VELOCITY_MIN_EXCLUSIVE)),
        B.RULE_AMOUNT_VS_AVG: own & timed & (prior_n > 0) & (amount > F.lit(factor) * F.when(prior_n > 0, prior_avg)),
        B.RULE_LOCATION_JUMP: own & timed & (F.col("location") != F.col("_prev.location")) & (us - F.col("_prev._us") < F.lit(gap_us)),
        B.RULE_YOUNG_ACCOUNT: own & timed & high & (us - F.col("_first") < F.lit(age_us)),
    }
    fired = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    hits = seen.select(*TXN_COLS, F.explode(fired).alias("triggered_rule"))

    # the first sighting of a device; of its copies the one with the largest amount
    first = F.struct("_us", "transaction_id", (-amount).alias("_neg"), *[c for c in TXN_COLS if c != "transaction_id"])
    devices = rows.filter(timed).repartition(tasks, "user_id", "device_id").groupBy("user_id", "device_id").agg(F.min(first).alias("_r"))
    new = devices.select(*[F.col(f"_r.{c}") for c in TXN_COLS]).filter(high)
    return hits.unionByName(B.as_hits(new, B.RULE_NEW_DEVICE))


def score(grouped: DataFrame, cutoff: float = 0.6) -> DataFrame:
    """D6/D7 over grouped hits (``triggered_rules`` array)."""
    return (
        grouped.withColumn("n_rules", F.size("triggered_rules"))
        .withColumn("risk_score", risk_score("n_rules"))
        .withColumn("is_fraud", (F.col("risk_score") >= F.lit(cutoff)).cast("int"))
    )


def scored_transactions(silver: DataFrame, cutoff: float = 0.6, **rule_params) -> DataFrame:
    """One row per flagged transaction with rules, score and 0/1 label."""
    return score(C.group_hits(fused_hits(silver, **rule_params)), cutoff)
