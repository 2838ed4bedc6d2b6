"""Command-line apps, one per pipeline stage: ``python -m txnguard <command>``,
or on a cluster ``spark-submit --py-files txnguard.zip txnguard/__main__.py
<command>``:

  ingest       Kafka topic (or a folder of JSON lines) → bronze      (stream)
  silver       bronze → silver [--checked: with quarantine]           (stream)
  gold         silver → gold high-amount and velocity tables          (stream)
  detect       Kafka / JSON lines → both rules → console, no lake      (stream)
  hits         silver → standardised rule hits by event date          (stream)
  regroup      hits → consolidated fraud_union, touched dates only    (stream)
  consolidate  silver + gold → fraud_union [--dates d1,d2]            (batch)
  lake         bronze → silver → gold → fraud_union [--dates ...]     (batch)

Streaming commands run until a query fails or is stopped; ``--once`` drains
what is available (``availableNow``) and exits. Checkpoints belong on shared
storage; by default they go under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from txnguard.session import configure, work_dir


def _trigger(args) -> dict | None:
    if args.once:
        return {"availableNow": True}
    if args.trigger:
        return {"processingTime": args.trigger}
    return None


def _source(spark, args):
    from txnguard.sources import lake

    if args.kafka:
        return lake.read_kafka(spark, args.kafka, args.topic, args.starting_offsets,
                               max_offsets_per_trigger=args.max_offsets, min_partitions=args.min_partitions)
    return lake.read_text_stream(spark, args.text)


def _ckpt(spark, args, name):
    return args.checkpoint or work_dir(spark, "apps", name)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="txnguard", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)

    def stream_opts(sp):
        sp.add_argument("--checkpoint", help="checkpoint folder (default under spark.checkpoint.dir)")
        sp.add_argument("--trigger", help="processing-time trigger, e.g. '30 seconds'")
        sp.add_argument("--once", action="store_true", help="drain available input and exit")

    def source_opts(sp):
        g = sp.add_mutually_exclusive_group(required=True)
        g.add_argument("--kafka", help="bootstrap servers")
        g.add_argument("--text", help="folder of JSON-lines files (stand-in for Kafka)")
        sp.add_argument("--topic", default="transactions")
        sp.add_argument("--starting-offsets", default="earliest")
        sp.add_argument("--max-offsets", type=int)
        sp.add_argument("--min-partitions", type=int)

    sp = sub.add_parser("ingest")
    source_opts(sp)
    sp.add_argument("--bronze", required=True)
    stream_opts(sp)

    sp = sub.add_parser("silver")
    sp.add_argument("--bronze", required=True)
    sp.add_argument("--silver", required=True)
    sp.add_argument("--checked", action="store_true", help="quarantine rejects (partition _status)")
    stream_opts(sp)

    sp = sub.add_parser("gold")
    sp.add_argument("--silver", required=True)
    sp.add_argument("--gold", required=True)
    sp.add_argument("--console", action="store_true", help="also print rule output (debug)")
    stream_opts(sp)

    sp = sub.add_parser("detect")
    source_opts(sp)
    stream_opts(sp)

    sp = sub.add_parser("hits")
    sp.add_argument("--silver", required=True)
    sp.add_argument("--hits", required=True)
    stream_opts(sp)

    sp = sub.add_parser("regroup")
    sp.add_argument("--hits", required=True)
    sp.add_argument("--out", required=True)
    stream_opts(sp)

    sp = sub.add_parser("consolidate")
    sp.add_argument("--silver", required=True)
    sp.add_argument("--gold", required=True)
    sp.add_argument("--dates", help="comma-separated event dates to (re)build")
    sp.add_argument("--method", default="bucketed", choices=["bucketed", "range"])

    sp = sub.add_parser("lake")
    sp.add_argument("--bronze", required=True)
    sp.add_argument("--root", required=True)
    sp.add_argument("--dates", help="comma-separated event dates to (re)build")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = build_parser().parse_args(argv)
    if spark is None:
        # master, resources and spark.checkpoint.dir come from spark-submit
        spark = SparkSession.getActiveSession() or SparkSession.builder.appName("txnguard").getOrCreate()
    configure(spark)
    from txnguard.plans import jobs
    from txnguard.streaming import consolidate as sc
    from txnguard.streaming import jobs as sj

    cmd = args.command
    dates = args.dates.split(",") if getattr(args, "dates", None) else None
    if cmd == "consolidate":
        return jobs.consolidate_gold(spark, args.silver, args.gold, dates=dates, method=args.method)
    if cmd == "lake":
        return jobs.run_all(spark, args.bronze, args.root, dates=dates)

    trig = _trigger(args)
    if cmd == "ingest":
        queries = [sj.start_bronze(_source(spark, args), args.bronze, _ckpt(spark, args, "ingest"), trig)]
    elif cmd == "silver":
        start = sj.start_silver_checked if args.checked else sj.start_silver
        queries = [start(spark, args.bronze, args.silver, _ckpt(spark, args, "silver"), trig)]
    elif cmd == "gold":
        queries = sj.start_gold(spark, args.silver, args.gold, _ckpt(spark, args, "gold"), trig,
                                debug_console=args.console)
    elif cmd == "detect":
        high, vel = sj.detect(_source(spark, args))
        ck = _ckpt(spark, args, "detect")
        queries = [sj.console(high, f"{ck}/high_amount", "append", trig),
                   sj.console(vel, f"{ck}/velocity", "append", trig)]
    elif cmd == "hits":
        from txnguard.sources import lake

        silver = lake.read_silver_stream(spark, args.silver)
        queries = sc.start_hit_streams(silver, args.hits, _ckpt(spark, args, "hits"), trig)
    elif cmd == "regroup":
        queries = [sc.start_consolidation(spark, args.hits, args.out, _ckpt(spark, args, "regroup"), trig)]
    else:  # pragma: no cover - argparse rejects unknown commands
        raise SystemExit(f"unknown command {cmd}")

    if args.once:
        sj.drain(queries)
    else:
        sj.await_any(spark, queries)
    return {"queries": [q.id for q in queries]}


if __name__ == "__main__":
    main(sys.argv[1:])
