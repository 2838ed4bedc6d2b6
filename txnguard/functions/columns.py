"""Column-expression helpers. Everything here is a built-in Spark expression,
so it stays inside whole-stage codegen; no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnguard.schemas import RISK_SCORE_BY_RULES


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(c: str | Column = "transaction_time") -> Column:
    """ISO text → timestamp; bad text gives NULL instead of failing the query.

    The reference ran on Spark 3.5 where ``to_timestamp('bad')`` is NULL; on
    4.x with ANSI on it raises, so ``try_to_timestamp`` keeps the old result.
    Zone-less text is read in the session time zone (UTC, see session.py).
    """
    return F.try_to_timestamp(col_of(c))


def interval_micros(duration: str) -> int:
    """'60 seconds' / '2 minutes' / '1 hour' / '1 day' → microseconds."""
    amount, unit = duration.strip().split(None, 1)
    unit = unit.lower().rstrip("s")
    scale = {
        "microsecond": 1,
        "millisecond": 1_000,
        "second": 1_000_000,
        "minute": 60_000_000,
        "hour": 3_600_000_000,
        "day": 86_400_000_000,
        "week": 7 * 86_400_000_000,
    }[unit]
    return int(float(amount) * scale)


def bucket_micros(ts: str | Column, duration: str) -> Column:
    """Epoch-aligned bucket start of a timestamp, as microseconds (long).

    Same alignment as ``F.window(ts, duration)`` for tumbling windows:
    ``us - pmod(us, d)`` is a floor that is also right before 1970.
    """
    d = interval_micros(duration)
    us = F.unix_micros(col_of(ts))
    return us - F.pmod(us, F.lit(d))


def bucket_start(ts: str | Column, duration: str) -> Column:
    """Epoch-aligned bucket start as a timestamp (== window(ts, d).start)."""
    return F.timestamp_micros(bucket_micros(ts, duration))


def rules_array(*pairs: tuple[Column, str]) -> Column:
    """array of rule names whose condition is true, NULL conditions skipped."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in pairs]))


def risk_score(n_rules: str | Column) -> Column:
    """Score from the number of distinct triggered rules (0 → 0.0)."""
    n = col_of(n_rules)
    expr = F.lit(0.0)
    for k, score in RISK_SCORE_BY_RULES:
        expr = F.when(n >= k, F.lit(score)).otherwise(expr)
    return expr


def to_ntz(c: str | Column) -> Column:
    """Session-zone timestamp → timestamp_ntz (wall clock in UTC)."""
    return col_of(c).cast("timestamp_ntz")
