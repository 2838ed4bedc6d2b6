"""Behavioural rules described in the reference prose (D1–D5), as Spark jobs.

The prose gives only a sentence per rule; the semantics chosen here:

* D1 ``amount_vs_history`` — amount > ``factor`` × the mean amount of the
  user's *earlier* transactions (order: event time, then transaction_id).
  A user's first transaction has no history and is never flagged.
* D2 ``rolling_velocity`` — more than ``min_exclusive`` transactions of the
  user in the trailing window ``(t - window, t]``, counted at each
  transaction (a sliding form of the tumbling R2).
* D3 ``location_jump`` — location differs from the user's previous
  transaction and the gap to it is below ``max_gap``.
* D4 ``new_device`` — first transaction of a (user, device) pair and amount
  above ``threshold``.
* D5 ``young_account`` — amount above ``threshold`` within ``max_age`` of the
  user's first transaction (account age from history; no age column exists).

Rows whose time text does not parse cannot be ordered and are ignored.

Skew. A user may hold a third of all rows, so no rule sorts a whole user in
one task:

* D1 splits the running mean into a prefix over per-(user, time bucket)
  partial sums — a small table, one row per bucket — plus a running sum
  inside the bucket, co-partitioned on (user, bucket) with the join.
* D2 and the trailing features add rows as they enter a window and subtract
  them as they leave it, so a busy (user, bucket) costs one sort.
* D2 and D3 only look back a bounded time. Rows are grouped by (user, time
  bucket); the last ``lookback`` of each bucket is also copied into the next
  bucket, so every row sees all the rows it needs with a window over
  (user, bucket). Only the tail is copied (``lookback / bucket`` of the data).
* D4 and D5 are aggregates (first sighting per pair / per user) with
  partial aggregation map-side, joined back to the few high-amount rows.
* Where even one (user, bucket) is too large for a task, ``max_group`` cuts it
  into parts of consecutive rows (``parts.py``): part sums are scanned into
  carries in a small table, and rows add the carry of their part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnguard.functions.columns import event_time, interval_micros
from txnguard.operators.parts import PART, carried, last_of_part, tasks_for, with_parts
from txnguard.schemas import HIGH_AMOUNT_THRESHOLD, TXN_COLS, VELOCITY_MIN_EXCLUSIVE, VELOCITY_WINDOW

RULE_AMOUNT_VS_AVG = "AMOUNT_VS_AVG"
RULE_ROLLING_VELOCITY = "ROLLING_VELOCITY"
RULE_LOCATION_JUMP = "LOCATION_JUMP"
RULE_NEW_DEVICE = "NEW_DEVICE"
RULE_YOUNG_ACCOUNT = "YOUNG_ACCOUNT"

_US = "_us"      # event time as epoch microseconds
_B = "_bucket"   # bucket start, microseconds
_OWN = "_own"    # row belongs to this bucket (False: copied tail of the previous one)


def timed(silver: DataFrame, time_col: str = "transaction_time") -> DataFrame:
    """Silver rows with a parseable time, plus ``_us`` (epoch micros)."""
    return silver.withColumn(_US, F.unix_micros(event_time(time_col))).filter(F.col(_US).isNotNull())


def _bucket_of(us: Column, bucket_us: int) -> Column:
    return us - F.pmod(us, F.lit(bucket_us))


def with_carried_tail(rows: DataFrame, bucket: str, lookback: str) -> DataFrame:
    """Assign rows to (bucket) and copy each bucket's last ``lookback`` into
    the next bucket, in one pass (explode of a 1- or 2-element array)."""
    b_us, l_us = interval_micros(bucket), interval_micros(lookback)
    if l_us > b_us:
        raise ValueError("bucket must be at least as long as the lookback")
    us = F.col(_US)
    own_b = _bucket_of(us, b_us)
    in_tail = us >= own_b + F.lit(b_us - l_us)
    targets = F.when(in_tail, F.array(own_b, own_b + F.lit(b_us))).otherwise(F.array(own_b))
    return (
        rows.withColumn(_B, F.explode(targets))
        .withColumn(_OWN, F.col(_B) == own_b)
    )


_T = "_t"        # place on the time line: a row's own time, or the time it leaves a trailing window
_ROW = "_row"    # the row itself; NULL where it leaves


def _with_leaving(rows: DataFrame, w_us: int, keep: list[str], enter: dict[str, Column], leave: dict[str, Column]) -> DataFrame:
    """Two entries per row: ``enter`` values at its time and ``leave`` values ``w_us`` later.

    A trailing sum over ``(t - w, t]`` is then a running sum over the entries up
    to ``t``, peers included, which Spark computes incrementally. (A sliding RANGE
    frame goes through its whole buffer for every row, which is quadratic for a
    busy user.) A leaving entry carries no row, only its key.
    """
    names = [c for c in rows.columns if c not in keep]
    row = F.struct(*names)
    entry = F.struct(F.col(_US).alias(_T), *[v.alias(k) for k, v in enter.items()], row.alias(_ROW))
    gone = F.struct((F.col(_US) + F.lit(w_us)).alias(_T), *[v.alias(k) for k, v in leave.items()], F.when(F.lit(False), row).alias(_ROW))
    return rows.select(*keep, F.inline(F.array(entry, gone)))


# --- D1 ---------------------------------------------------------------------------


def amount_vs_history(
    silver: DataFrame, factor: float = 3.0, bucket: str = "1 minute", keep_all: bool = False, max_group: int | None = None
) -> DataFrame:
    """D1. Adds ``prior_n`` (earlier non-NULL amounts), ``prior_avg`` and
    ``amount_vs_avg`` (flag); returns flagged rows unless ``keep_all``.
    ``max_group`` splits (user, bucket) groups of more rows."""
    # NULL users form one group, as in GROUP BY / window partitioning; the
    # (text, is-null) key pair keeps them apart from any real id and, unlike a
    # null-safe join condition, stays a plain hash key shared by join and window
    rows = (
        timed(silver)
        .withColumn(_B, _bucket_of(F.col(_US), interval_micros(bucket)))
        .withColumn("_uk", F.coalesce(F.col("user_id"), F.lit("")))
        .withColumn("_un", F.col("user_id").isNull())
    )
    amount = F.col("transaction_amount")
    at = [_B]
    if max_group is not None:
        rows, at = with_parts(rows, ["_uk", "_un", _B], [_US, "transaction_id"], max_group), [_B, PART]

    sums = rows.groupBy("_uk", "_un", *at).agg(F.sum(amount).alias("_bs"), F.count(amount).alias("_bn"))
    prefix = carried(sums, ["_uk", "_un"], at, {"_bs": "_ps", "_bn": "_pn"})

    inside = (
        Window.partitionBy("_uk", "_un", *at)
        .orderBy(_US, "transaction_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = rows.join(prefix, ["_uk", "_un", *at], "inner")
    prior_sum = F.col("_ps") + F.coalesce(F.sum(amount).over(inside), F.lit(0.0))
    prior_n = F.col("_pn") + F.coalesce(F.count(amount).over(inside), F.lit(0))
    out = (
        joined.withColumn("prior_n", prior_n)
        .withColumn("prior_avg", F.when(F.col("prior_n") > 0, prior_sum / F.col("prior_n")))
        .withColumn("amount_vs_avg", F.coalesce(amount > F.lit(factor) * F.col("prior_avg"), F.lit(False)))
        .select(*silver.columns, "prior_n", "prior_avg", "amount_vs_avg")
    )
    return out if keep_all else out.filter("amount_vs_avg")


# --- D2 ---------------------------------------------------------------------------


def rolling_velocity(
    silver: DataFrame,
    window: str = VELOCITY_WINDOW,
    min_exclusive: int = VELOCITY_MIN_EXCLUSIVE,
    bucket: str | None = None,
    keep_all: bool = False,
    max_group: int | None = None,
) -> DataFrame:
    """D2. Adds ``rolling_count`` = the user's transactions in (t - window, t].
    ``max_group`` splits (user, bucket) groups of more entries, two a row; rows of one microsecond stay together."""
    w_us = interval_micros(window)
    bucket = bucket or f"{10 * w_us} microseconds"
    rows = with_carried_tail(timed(silver), bucket, window)
    entries = _with_leaving(rows, w_us, ["user_id", _B], {"_d": F.lit(1)}, {"_d": F.lit(-1)})
    group, carry = ["user_id", _B], F.lit(0)
    if max_group is not None:
        entries = with_parts(entries.withColumn("_un", F.col("user_id").isNull()), group, [_T], max_group)
        sums = entries.withColumn("_uk", F.coalesce("user_id", F.lit(""))).groupBy("_uk", "_un", _B, PART).agg(F.sum("_d").alias("_s"))
        prefix = carried(sums, ["_uk", "_un", _B], [PART], {"_s": "_carry"})
        entries = entries.withColumn("_uk", F.coalesce("user_id", F.lit(""))).join(prefix, ["_uk", "_un", _B, PART], "inner")
        group, carry = ["_uk", "_un", _B, PART], F.col("_carry")
    so_far = Window.partitionBy(*group).orderBy(_T).rangeBetween(Window.unboundedPreceding, 0)
    out = (
        entries.withColumn("rolling_count", F.sum("_d").over(so_far) + carry)
        .filter(F.col(f"{_ROW}.{_OWN}"))
        .select(*[F.col(c if c == "user_id" else f"{_ROW}.{c}") for c in silver.columns], "rolling_count")
        .withColumn("rolling_velocity", F.col("rolling_count") > F.lit(int(min_exclusive)))
    )
    return out if keep_all else out.filter("rolling_velocity")


# --- D3 ---------------------------------------------------------------------------


def _previous(rows: DataFrame, group: list[str]) -> DataFrame:
    """``rows`` with ``_before``: time and location of the row before, in ``group``."""
    order = Window.partitionBy(*group).orderBy(_US, "transaction_id")
    return rows.withColumn("_before", F.lag(F.struct(_US, "location")).over(order))


def _previous_over_parts(rows: DataFrame, max_group: int) -> DataFrame:
    """As ``_previous``, with hot (user, bucket) groups in parts: the first row of a part looks at the last one of the part before."""
    rows = with_parts(rows, ["user_id", _B], [_US, "transaction_id"], max_group)
    rows = rows.withColumns({"_uk": F.coalesce("user_id", F.lit("")), "_un": F.col("user_id").isNull()})
    key = ["_uk", "_un", _B]
    last = last_of_part(rows, key, [_US, "transaction_id"], ["location"])
    before = F.lag("_last").over(Window.partitionBy(*key).orderBy(PART))
    carry = last.select(*key, PART, F.struct(before[_US].alias(_US), before["location"].alias("location")).alias("_carry"), before.isNotNull().alias("_has"))
    inside = _previous(rows.join(carry, [*key, PART], "inner"), [*key, PART])
    return inside.withColumn("_before", F.when(F.col("_before").isNotNull(), F.col("_before")).when(F.col("_has"), F.col("_carry")))


def location_jump(
    silver: DataFrame, max_gap: str = "5 minutes", bucket: str | None = None, keep_all: bool = False, max_group: int | None = None
) -> DataFrame:
    """D3. Adds ``prev_location`` and ``gap_seconds`` to the previous row.
    ``max_group`` splits (user, bucket) groups of more rows."""
    g_us = interval_micros(max_gap)
    bucket = bucket or f"{max(10 * g_us, 60_000_000)} microseconds"
    rows = with_carried_tail(timed(silver), bucket, max_gap)
    rows = _previous(rows, ["user_id", _B]) if max_group is None else _previous_over_parts(rows, max_group)
    out = (
        rows.withColumn("prev_location", F.col("_before.location"))
        .withColumn("_gap_us", F.col(_US) - F.col(f"_before.{_US}"))
        .filter(F.col(_OWN))
        .withColumn(
            "location_jump",
            F.coalesce(
                (F.col("location") != F.col("prev_location")) & (F.col("_gap_us") < F.lit(g_us)),
                F.lit(False),
            ),
        )
        # the previous row is only known when it lies within the gap
        .withColumn("prev_location", F.when(F.col("_gap_us") < F.lit(g_us), F.col("prev_location")))
        .withColumn("gap_seconds", F.when(F.col("_gap_us") < F.lit(g_us), F.col("_gap_us") / 1e6))
        .select(*silver.columns, "prev_location", "gap_seconds", "location_jump")
    )
    return out if keep_all else out.filter("location_jump")


# --- D4 / D5 ----------------------------------------------------------------------


def new_device(silver: DataFrame, threshold: float = HIGH_AMOUNT_THRESHOLD) -> DataFrame:
    """D4. First (user, device) sighting whose amount is above threshold.
    A first sighting delivered more than once is flagged once; a NULL
    transaction_id is an id like any other and comes first."""
    rows = timed(silver)
    firsts = rows.groupBy("user_id", "device_id").agg(
        F.min(F.struct(F.col(_US), F.col("transaction_id"))).alias("_first")
    )
    high = rows.filter(F.col("transaction_amount") > F.lit(float(threshold))).alias("h")
    f = firsts.alias("f")
    cond = (
        F.col("h.user_id").eqNullSafe(F.col("f.user_id"))
        & F.col("h.device_id").eqNullSafe(F.col("f.device_id"))
        & (F.col(f"h.{_US}") == F.col("f._first._us"))
        & F.col("h.transaction_id").eqNullSafe(F.col("f._first.transaction_id"))
    )
    # only flagged rows are left here: one of each pair's copies, the smallest
    row = F.struct(*[F.col(c) for c in rows.columns])
    found = high.join(f, cond, "left_semi").groupBy("user_id", "device_id").agg(F.min(row).alias("_r"))
    return found.select(*[F.col(f"_r.{c}").alias(c) for c in silver.columns])


def young_account(
    silver: DataFrame, max_age: str = "7 days", threshold: float = HIGH_AMOUNT_THRESHOLD
) -> DataFrame:
    """D5. Amount above threshold within ``max_age`` of the user's first
    transaction; adds ``account_age_seconds``."""
    rows = timed(silver)
    first_seen = rows.groupBy("user_id").agg(F.min(_US).alias("_first_us")).alias("f")
    high = rows.filter(F.col("transaction_amount") > F.lit(float(threshold))).alias("h")
    joined = high.join(first_seen, F.col("h.user_id").eqNullSafe(F.col("f.user_id")), "inner")
    age = F.col(f"h.{_US}") - F.col("f._first_us")
    return (
        joined.filter(age < F.lit(interval_micros(max_age)))
        .select("h.*", (age / 1e6).alias("account_age_seconds"))
        .drop(_US)
    )


def as_hits(flagged: DataFrame, rule: str) -> DataFrame:
    """Standardise any rule's flagged rows to ``HIT_COLS``."""
    return flagged.select(*TXN_COLS, F.lit(rule).alias("triggered_rule"))


# --- D12 (per transaction) ----------------------------------------------------------


def transaction_features(
    silver: DataFrame, trailing: str = "10 minutes", bucket: str | None = None, tasks: int | None = None
) -> DataFrame:
    """Per-transaction features in one pass over (user, time bucket).

    * ``trailing_count`` / ``trailing_amount`` / ``trailing_devices``: the
      user's transactions, summed amount and distinct devices in
      ``(t - trailing, t]`` (this row included);
    * ``prior_n`` / ``prior_sum`` / ``prior_avg``: count, sum and mean of all
      the user's earlier amounts (lifetime, as in D1);
    * ``seconds_since_prev``: gap to the user's previous transaction when it
      lies within ``trailing`` (NULL otherwise).

    Rows are grouped by (user, bucket) with the previous bucket's last
    ``trailing`` copied in (D2/D3 pattern) and joined to the per-bucket
    lifetime prefix (D1 pattern) on the same key, so the big side is
    shuffled once for all features, into ``tasks`` partitions (default: by the
    number of rows, so that a task's memory does not grow with the input).
    """
    w_us = interval_micros(trailing)
    bucket = bucket or f"{10 * w_us} microseconds"
    amount = F.col("transaction_amount")
    rows = with_carried_tail(timed(silver), bucket, trailing)
    rows = rows.withColumn("_uk", F.coalesce(F.col("user_id"), F.lit(""))).withColumn(
        "_un", F.col("user_id").isNull()
    )

    own = rows.filter(F.col(_OWN))
    per_bucket = own.groupBy("_uk", "_un", _B).agg(F.sum(amount).alias("_bs"), F.count(amount).alias("_bn"))
    before = Window.partitionBy("_uk", "_un").orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_bucket.select(
        "_uk", "_un", _B,
        F.coalesce(F.sum("_bs").over(before), F.lit(0.0)).alias("_ps"),
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_pn"),
    )
    part = Window.partitionBy("_uk", "_un", _B)
    ordered = part.orderBy(_US, "transaction_id")
    earlier_own = ordered.rowsBetween(Window.unboundedPreceding, -1)
    own_amount = F.when(F.col(_OWN), amount)
    gap = F.col(_US) - F.lag(_US).over(ordered)
    # a device is in the window from a sighting that finds it gone until the window has passed a sighting
    # that no other follows in time: those two entries count it once however often it is seen
    same = Window.partitionBy("_uk", "_un", _B, "device_id").orderBy(_US)
    known = F.col("device_id").isNotNull()
    comes = known & F.coalesce(F.lag(_US).over(same) + F.lit(w_us) <= F.col(_US), F.lit(True))
    goes = known & F.coalesce(F.lead(_US).over(same) >= F.col(_US) + F.lit(w_us), F.lit(True))
    rows = (
        rows.repartition(tasks or tasks_for(silver), "_uk", "_un", _B)
        .join(prefix, ["_uk", "_un", _B], "left")
        .withColumn("_wn", F.count(own_amount).over(earlier_own))
        .withColumn("_ws", F.sum(own_amount).over(earlier_own))
        .withColumn("_gap", gap)
        .withColumn("_comes", comes.cast("long"))
        .withColumn("_goes", goes.cast("long"))
    )
    value, valued = F.coalesce(amount, F.lit(0.0)), amount.isNotNull().cast("long")
    entries = _with_leaving(
        rows, w_us, ["_uk", "_un", _B],
        {"_d": F.lit(1), "_a": value, "_n": valued, "_v": F.col("_comes")}, {"_d": F.lit(-1), "_a": -value, "_n": -valued, "_v": -F.col("_goes")},
    )
    so_far = part.orderBy(_T).rangeBetween(Window.unboundedPreceding, 0)
    out = (
        entries.withColumn("trailing_count", F.sum("_d").over(so_far))
        .withColumn("trailing_amount", F.when(F.sum("_n").over(so_far) > 0, F.sum("_a").over(so_far)))
        .withColumn("trailing_devices", F.sum("_v").over(so_far))
        .filter(F.col(f"{_ROW}.{_OWN}"))
        .select(f"{_ROW}.*", "trailing_count", "trailing_amount", "trailing_devices")
        .withColumn("prior_n", F.coalesce("_pn", F.lit(0)) + F.col("_wn"))
        .withColumn("prior_sum", F.coalesce("_ps", F.lit(0.0)) + F.coalesce("_ws", F.lit(0.0)))
        .withColumn("prior_avg", F.when(F.col("prior_n") > 0, F.col("prior_sum") / F.col("prior_n")))
        .withColumn("seconds_since_prev", F.when(F.col("_gap") < F.lit(w_us), F.col("_gap") / 1e6))
    )
    return out.select(
        *silver.columns, "trailing_count", "trailing_amount", "trailing_devices", "prior_n", "prior_sum",
        "prior_avg", "seconds_since_prev",
    )


def bucket_load(silver: DataFrame, bucket: str = "1 minute", top: int = 20) -> DataFrame:
    """The ``top`` largest (user, time bucket) groups for a bucket size, with
    their share of all rows: the task size the D1–D3 window stages will see.

    A partial aggregate (one row per group per input task) plus a top-k
    report; use it to pick a bucket small enough that the largest group fits
    comfortably in one task.
    """
    rows = timed(silver).withColumn(_B, _bucket_of(F.col(_US), interval_micros(bucket)))
    total = max(rows.count(), 1)   # one number from a distributed count
    groups = rows.groupBy("user_id", _B).agg(F.count(F.lit(1)).alias("rows"))
    return (
        groups.orderBy(F.col("rows").desc(), "user_id", _B)
        .limit(top)
        .select(
            "user_id",
            F.timestamp_micros(_B).alias("bucket_start"),
            "rows",
            (F.col("rows") / F.lit(total)).alias("share"),
        )
    )
