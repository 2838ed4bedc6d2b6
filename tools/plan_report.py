"""Write PLANS.md: the physical plan facts of every registered batch query.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

For each query: shuffle exchanges, join strategies, aggregates, windows,
Python nodes, and the pushed filters / read schemas of its scans — taken from
the executed (pre-AQE) plan, so they show the plan Catalyst chose before run
time re-planning.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def facts(df):
    from txnguard.plans import inspect as P

    plan = P.executed_plan(df)
    fmt = P.formatted_plan(df)
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                  r"BroadcastNestedLoopJoin|CartesianProduct)", plan)))
    exchanges = re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning|SinglePartition)", plan)
    keys = sorted({re.sub(r"#\d+L?", "", e).replace("hashpartitioning", "hash") for e in exchanges})
    return {
        "exchanges": len(exchanges),
        "keys": keys,
        "joins": joins,
        "broadcasts": plan.count("BroadcastExchange"),
        "windows": plan.count("Window ["),
        "aggregates": len(re.findall(r"HashAggregate|ObjectHashAggregate|SortAggregate", plan)),
        "python": P.python_nodes(df),
        "pushed": sorted({p for p in P.pushed_filters(df) if p}),
        "schemas": sorted(set(P.read_schemas(df))),
        "_": fmt,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from txnguard.plans.registry import queries
    from txnguard.session import build_session

    spark = build_session()
    print("# PLANS\n")
    print(f"Physical plans of the registered batch queries on `{sf_dir}` (local, 8 shuffle partitions),")
    print("generated by `tools/plan_report.py`. Counts are from the plan before AQE re-planning;")
    print("at scale, joins shown as broadcast here become sort-merge joins unless a size check allows")
    print("the broadcast (see README, Designing for 100 TB).\n")
    print("| query | exchanges (keys) | joins | aggregates | windows | Python nodes |")
    print("| --- | --- | --- | --- | --- | --- |")
    details = []
    for name, fn in queries().items():
        if name.startswith("stream_") or name in ("fraud_model", "lake_fraud_union"):
            continue
        f = facts(fn(spark, sf_dir))
        keys = "; ".join(f["keys"]) or "-"
        print(f"| {name} | {f['exchanges']} ({keys}) | {', '.join(f['joins']) or '-'} | "
              f"{f['aggregates']} | {f['windows']} | {', '.join(f['python']) or 'none'} |")
        details.append((name, f))
    print("\n## Scans\n")
    for name, f in details:
        print(f"- **{name}**: read {', '.join('`' + s + '`' for s in f['schemas'])}; "
              f"pushed {', '.join('`' + p + '`' for p in f['pushed']) or 'nothing'}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
