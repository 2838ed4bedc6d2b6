"""The one-pass rule evaluation equals the union of the single rules."""

from __future__ import annotations

import random

import pytest

from conftest import SF_SMALL, silver_df, txn
from txnguard.operators import scoring as SC
from txnguard.plans import inspect as P
from txnguard.schemas import HIT_COLS
from txnguard.sources.tables import read_transactions


def _hits(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*HIT_COLS).collect())))


@pytest.mark.parametrize("seed", [1, 2])
def test_fused_hits_equal_the_single_rules(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(500):
        minute, second = rng.randrange(60), rng.choice([0, 0, rng.randrange(60)])
        when = rng.choice([f"2024-01-01T10:{minute:02d}:{second:02d}", f"2024-01-01T23:59:{second:02d}", "2024-01-02T00:00:00", "bad"])
        rows.append(txn(f"t{i}", user=rng.choice(["a", "b", None, f"u{rng.randrange(20)}"]), amount=rng.choice([None, 10.0, 50.0, 25000.0]), time=when,
                        device=rng.choice(["d1", "d2", None, "d3"]), location=rng.choice(["USA", "UK", None]), intl=rng.random() < 0.5))
    silver = silver_df(spark, rows)
    for gap in ("10 seconds", "5 minutes"):
        params = {"max_gap": gap, "max_age": "20 minutes"}
        assert _hits(SC.fused_hits(silver, **params)) == _hits(SC.all_hits(silver, **params))


def test_fused_hits_scan_silver_three_times(spark):
    plan = P.formatted_plan(SC.scored_transactions(read_transactions(spark, SF_SMALL)))
    assert plan.count("Location: ") <= 3
