"""Plan checks: pushdown, pruning, equi-joins, JVM-only."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from __spark_entry__ import queries
from txnguard.operators import behaviour as B
from txnguard.operators import consolidate as C
from txnguard.operators import ingest as I
from txnguard.operators import rules as R
from txnguard.plans import inspect as P
from txnguard.plans import registry
from txnguard.sources.tables import read_transactions

# the optional text subpackage has plan tests of its own
BATCH_QUERIES = [k for k in registry.queries() if not k.startswith("stream_")]


@pytest.fixture(scope="module")
def silver_table(spark, tmp_path_factory):
    from txnguard.session import work_dir

    path = work_dir(spark, "tests", "silver_table", unique=True)
    read_transactions(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_high_amount_filter_reaches_the_scan(silver_table):
    pushed = " ".join(P.pushed_filters(R.high_amount(silver_table)))
    assert "GreaterThan(transaction_amount,20000.0)" in pushed
    assert "EqualTo(is_international,true)" in pushed


def test_velocity_reads_two_columns(silver_table):
    schemas = P.read_schemas(R.velocity(silver_table))
    assert schemas == ["struct<user_id:string,transaction_time:string>"]


def test_velocity_aggregates_before_shuffle(silver_table):
    plan = P.executed_plan(R.velocity(silver_table))
    assert "partial_count" in plan and P.exchange_count(R.velocity(silver_table)) == 1


def test_consolidation_has_no_nested_loops(silver_table):
    out = C.consolidate(R.high_amount(silver_table), R.velocity(silver_table), silver_table)
    assert P.nested_loops(out) == []


def test_behaviour_rules_partition_by_user_and_bucket(silver_table):
    plan = P.executed_plan(B.rolling_velocity(silver_table))
    assert "hashpartitioning(user_id" in plan and "_bucket" in plan
    plan = P.executed_plan(B.location_jump(silver_table))
    assert "_bucket" in plan


def test_dedup_is_an_aggregate_not_a_window(silver_table):
    plan = P.executed_plan(I.dedup_earliest(silver_table))
    assert "Window" not in plan and "partial_min_by" in plan


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_registered_queries_stay_in_the_jvm(spark, name):
    df = queries()[name](spark, SF_SMALL)
    assert P.python_nodes(df) == []
    assert P.nested_loops(df) == []
