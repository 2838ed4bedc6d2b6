"""Driver contract: entry(), queries(), oracle_sql(); every query against its
DuckDB twin on sf0.001 (the driver repeats this at sf0.01)."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL
from __spark_entry__ import entry, oracle_sql, queries

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import _rows  # noqa: E402

from txnguard.plans import registry  # noqa: E402
from txnguard.sources.tables import TABLES, table_path  # noqa: E402


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() == 93
    assert "triggered_rules" in df.columns


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) & set(registry.queries())))
def test_query_matches_oracle(spark, duck, name):
    got_cols, got = _rows(queries()[name](spark, SF_SMALL).toPandas())
    want_cols, want = _rows(duck.execute(oracle_sql()[name]).df())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want


# registered here; the optional text subpackage has its own tests
OWN = set(registry.queries())
NO_ORACLE = {"fraud_model", "fraud_model_temporal", "metrics_rollup_approx", "user_features_approx"}


def test_only_models_and_estimates_lack_an_oracle():
    assert OWN - set(oracle_sql()) == NO_ORACLE


@pytest.mark.parametrize("name, keys, estimates", [
    ("metrics_rollup", ["event_date", "location", "merchant_id", "grouping_level"], ["n_users", "n_flagged_users"]),
    ("user_features", ["user_id"], ["n_devices", "n_locations", "n_merchants"]),
])
def test_estimated_distinct_counts_are_near_the_exact_ones(spark, name, keys, estimates):
    exact = queries()[name](spark, SF_SMALL).toPandas().set_index(keys).sort_index()
    near = queries()[f"{name}_approx"](spark, SF_SMALL).toPandas().set_index(keys).sort_index()
    assert len(exact) == len(near)
    for c in estimates:
        assert ((exact[c] - near[c]).abs() <= 1 + 0.2 * exact[c]).all()


# stream queries read replayed tables; fraud_model reads its checkpointed
# training set (lineage cut on purpose), both derived from events by Spark
@pytest.mark.parametrize("name", sorted(k for k in OWN if not k.startswith("stream_") and k not in ("fraud_model", "lake_fraud_union")))
def test_registered_query_scans_the_events_table(spark, name):
    from txnguard.plans import inspect as P

    assert "events.parquet" in P.formatted_plan(queries()[name](spark, SF_SMALL))
