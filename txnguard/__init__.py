"""txnguard: PySpark-native transaction-risk engine.

Layers (medallion):

* ``sources``    — readers for Kafka / text / Parquet lake tables and the
                   driver test tables (events → transactions mapping).
* ``functions``  — small column-expression helpers (event time, buckets,
                   rule arrays); all built-in Spark expressions.
* ``operators``  — ``DataFrame -> DataFrame`` building blocks: bronze and
                   silver transforms, risk rules, alert expansion and
                   consolidation, behavioural rules, scores and marts.
* ``plans``      — batch jobs that chain the operators and write tables,
                   the query registry and plan-inspection helpers.
* ``streaming``  — Structured Streaming runners for the same operators.

Every rule is a plain function that runs unchanged on a batch DataFrame
and on a streaming DataFrame.
"""

from txnguard.session import build_session, configure, work_dir

__all__ = ["build_session", "configure", "work_dir"]
