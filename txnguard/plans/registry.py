"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each reading the whole driver tables.

Outputs are shaped for comparison with the DuckDB oracle: timestamps as
``timestamp_ntz`` (naive UTC), the ``window`` struct flattened, rule sets as
sorted comma-joined text. The library functions themselves return the
reference layouts (struct window, ``array<string>`` rule sets).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.functions.columns import to_ntz
from txnguard.operators import behaviour as B
from txnguard.operators import consolidate as C
from txnguard.operators import scoring as SC
from txnguard.operators import ingest as I
from txnguard.operators import marts as M
from txnguard.operators import quantiles as QU
from txnguard.operators import rollup_parts as PARTS
from txnguard.operators import rules as R
from txnguard.operators import seen as SEEN
from txnguard.plans import jobs
from txnguard.plans import layout as LAYOUT
from txnguard.schemas import FRAUD_UNION_COLS, HIT_COLS, TXN_COLS
from txnguard.session import configure, work_dir
from txnguard.streaming import consolidate as SCON
from txnguard.streaming import late as LATE
from txnguard.streaming import panes as PANES
from txnguard.streaming import replay as S
from txnguard.streaming import stateful as STATE
from txnguard.sources.tables import noisy_bronze, read_table, read_transactions, redelivered

Query = Callable[[SparkSession, str], DataFrame]


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, to_ntz(c))
    return df


def _flat_window(df: DataFrame) -> DataFrame:
    out = df.withColumn("window_start", to_ntz("window.start")).withColumn(
        "window_end", to_ntz("window.end")
    )
    return out.drop("window")


def _rules_text(df: DataFrame, col: str = "triggered_rules") -> DataFrame:
    return df.withColumn(col, F.concat_ws(",", F.col(col)))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return read_transactions(spark, sf_dir)


# --- reference operators ---------------------------------------------------------


def q_transactions(spark, sf_dir):
    return _ntz(_silver(spark, sf_dir), "ingestion_time")


def q_high_amount(spark, sf_dir):
    return _ntz(R.high_amount_gold(_silver(spark, sf_dir)), "ingestion_time")


def q_velocity(spark, sf_dir):
    return _velocity_out(R.velocity_gold(_silver(spark, sf_dir)))


def q_velocity_expanded(spark, sf_dir, method="bucketed"):
    silver = _silver(spark, sf_dir)
    hits = C.expand_velocity(R.velocity(silver), silver, method=method)
    return _ntz(hits, "ingestion_time")


def q_velocity_expanded_range(spark, sf_dir):
    return q_velocity_expanded(spark, sf_dir, method="range")


def q_velocity_expanded_bucketed(spark, sf_dir):
    return q_velocity_expanded(spark, sf_dir, method="bucketed")


def q_fraud_union(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    hits = C.union_hits(
        C.standardize_high_amount(R.high_amount(silver)),
        C.expand_velocity(R.velocity(silver), silver),
    )
    return _ntz(hits.select(*HIT_COLS), "ingestion_time")


def q_fraud_consolidated(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    out = C.consolidate(R.high_amount(silver), R.velocity(silver), silver)
    return _rules_text(_ntz(out, "ingestion_time"))


# --- JSON wire path ----------------------------------------------------------------


def q_bronze_raw(spark, sf_dir):
    return _ntz(I.to_wire_json(_silver(spark, sf_dir)), "ingestion_time")


def q_silver_flat(spark, sf_dir):
    bronze = I.to_wire_json(_silver(spark, sf_dir))
    return _ntz(I.to_silver(bronze), "ingestion_time")


def _noisy(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    return noisy_bronze(silver, read_table(spark, sf_dir, "events"))


def q_silver_quarantine(spark, sf_dir):
    _, rejects = I.split_valid(I.to_silver_checked(_noisy(spark, sf_dir)))
    return _ntz(rejects, "ingestion_time")


def q_silver_valid(spark, sf_dir):
    valid, _ = I.split_valid(I.to_silver_checked(_noisy(spark, sf_dir)))
    return _ntz(valid, "ingestion_time")


def q_silver_dedup(spark, sf_dir):
    return _ntz(I.dedup_earliest(redelivered(_silver(spark, sf_dir))), "ingestion_time")


def q_silver_normalized(spark, sf_dir):
    return _ntz(I.normalize(_silver(spark, sf_dir)), "ingestion_time")


# --- behavioural rules, score, label ---------------------------------------------
# The driver events are time-compressed 1440x (one day -> one minute), so the
# prose's "5 minutes" gap and "7 days" account age are scaled to the data.
FIXTURE_RULE_PARAMS = {"max_gap": "10 seconds", "max_age": "7 minutes"}
FIXTURE_TRAILING = "60 seconds"


def _txn_out(df: DataFrame, *extra: str) -> DataFrame:
    return _ntz(df.select(*TXN_COLS, *extra), "ingestion_time")


def q_rule_amount_vs_avg(spark, sf_dir):
    return _txn_out(B.amount_vs_history(_silver(spark, sf_dir)), "prior_n")


def q_velocity_rolling(spark, sf_dir):
    return _txn_out(B.rolling_velocity(_silver(spark, sf_dir)), "rolling_count")


def q_rule_location_jump(spark, sf_dir):
    out = B.location_jump(_silver(spark, sf_dir), max_gap=FIXTURE_RULE_PARAMS["max_gap"])
    return _txn_out(out, "prev_location", "gap_seconds")


SPLIT_ROWS = 4  # small enough that most users' buckets are cut


def q_rule_amount_vs_avg_split(spark, sf_dir):
    """D1 with every larger (user, minute) cut into parts."""
    return _txn_out(B.amount_vs_history(_silver(spark, sf_dir), max_group=SPLIT_ROWS), "prior_n")


def q_velocity_rolling_split(spark, sf_dir):
    """D2 with every larger (user, bucket) cut into parts."""
    return _txn_out(B.rolling_velocity(_silver(spark, sf_dir), max_group=2 * SPLIT_ROWS), "rolling_count")


def q_rule_location_jump_split(spark, sf_dir):
    """D3 with every larger (user, bucket) cut into parts."""
    out = B.location_jump(_silver(spark, sf_dir), max_gap=FIXTURE_RULE_PARAMS["max_gap"], max_group=SPLIT_ROWS)
    return _txn_out(out, "prev_location", "gap_seconds")


def q_rule_new_device(spark, sf_dir):
    return _txn_out(B.new_device(_silver(spark, sf_dir)))


def q_rule_young_account(spark, sf_dir):
    out = B.young_account(_silver(spark, sf_dir), max_age=FIXTURE_RULE_PARAMS["max_age"])
    return _txn_out(out, "account_age_seconds")


def q_transaction_features(spark, sf_dir):
    out = B.transaction_features(_silver(spark, sf_dir), trailing=FIXTURE_TRAILING)
    # sums of near-integer amounts round stably; means (k/40 = x.xx5 ...) do not,
    # so the comparison uses the prior sum and leaves the mean to the library
    out = out.withColumn("trailing_amount", F.round("trailing_amount", 2)).withColumn(
        "prior_sum", F.round("prior_sum", 2))
    return _txn_out(out, "trailing_count", "trailing_amount", "trailing_devices", "prior_n", "prior_sum",
                    "seconds_since_prev")


def _scored(spark, sf_dir):
    return SC.scored_transactions(_silver(spark, sf_dir), **FIXTURE_RULE_PARAMS)


def q_risk_score(spark, sf_dir):
    out = _scored(spark, sf_dir).select(*TXN_COLS, "triggered_rules", "n_rules", "risk_score")
    return _rules_text(_ntz(out, "ingestion_time"))


def q_risk_label(spark, sf_dir):
    out = _scored(spark, sf_dir).select("transaction_id", "ingestion_time", "risk_score", "is_fraud")
    return _ntz(out, "ingestion_time")


# --- marts -----------------------------------------------------------------------


def _consolidated(silver: DataFrame) -> DataFrame:
    return C.consolidate(R.high_amount(silver), R.velocity(silver), silver)


def _date_text(df: DataFrame, col: str = "event_date") -> DataFrame:
    return df.withColumn(col, F.date_format(col, "yyyy-MM-dd"))


def q_metrics_rollup(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    return _date_text(M.metrics_rollup(silver, _consolidated(silver), exact=True))


def q_user_features(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    out = M.user_features(silver, _consolidated(silver), exact=True)
    return _ntz(out, "first_seen", "last_seen")


def q_report(spark, sf_dir):
    out = M.report(_consolidated(_silver(spark, sf_dir)))
    return _date_text(_rules_text(_ntz(out, "ingestion_time")))


def q_profile(spark, sf_dir):
    return M.profile(_silver(spark, sf_dir), exact=True)


def q_profile_quantiles(spark, sf_dir):
    """D14's quantiles, from sketches of every day merged; each is reported as the outcome of its exact rank check."""
    silver = _silver(spark, sf_dir)
    return QU.within_error(silver, QU.profile_quantiles(silver))


def q_fraud_model(spark, sf_dir):
    """D15 (no SQL twin): per-user probability from a logistic regression
    trained on the user features with rule-derived labels."""
    from txnguard.operators import model as ML

    silver = _silver(spark, sf_dir)
    feats = M.user_features(silver, _consolidated(silver))
    labels = ML.user_labels(SC.scored_transactions(silver, **FIXTURE_RULE_PARAMS))
    return ML.fit_and_score(ML.training_set(feats, labels))


# --- streaming replays (availableNow through real Parquet sinks) -------------------


def q_stream_silver(spark, sf_dir):
    configure(spark)
    return _ntz(S.stream_silver(spark, sf_dir), "ingestion_time")


def q_stream_high_amount(spark, sf_dir):
    configure(spark)
    return _ntz(S.stream_high_amount(spark, sf_dir), "ingestion_time")


def _velocity_out(v: DataFrame) -> DataFrame:
    return _flat_window(v).select("user_id", "window_start", "window_end", "count", "fraud_type")


def q_stream_velocity(spark, sf_dir):
    configure(spark)
    return _velocity_out(S.stream_velocity(spark, sf_dir))


def q_stream_velocity_update(spark, sf_dir):
    configure(spark)
    return _velocity_out(S.stream_velocity_update(spark, sf_dir))


def q_stream_velocity_expanded(spark, sf_dir):
    configure(spark)
    hits = S.run_to_table(SCON.expand_velocity_stream(S.silver_stream(spark, sf_dir, flush=True)),
                          spark, "velocity_expanded")
    return _ntz(hits.filter(F.col("user_id") != S.SENTINEL_USER), "ingestion_time")


def q_stream_consolidated(spark, sf_dir):
    configure(spark)
    out, _ = SCON.consolidate_stream(spark, S.silver_stream(spark, sf_dir, flush=True))
    out = out.filter(F.col("user_id") != S.SENTINEL_USER)
    return _rules_text(_ntz(out, "ingestion_time"))


def q_stream_location_jump(spark, sf_dir):
    configure(spark)
    rule = STATE.location_jump_stream(S.silver_slices(spark, sf_dir),
                                      max_gap=FIXTURE_RULE_PARAMS["max_gap"])
    out = S.run_to_table(rule, spark, "location_jump").filter(F.col("user_id") != S.SENTINEL_USER)
    return _txn_out(out, "prev_location", "gap_seconds")


def q_stream_amount_vs_avg(spark, sf_dir):
    configure(spark)
    rule = STATE.amount_vs_history_stream(S.silver_slices(spark, sf_dir))
    out = S.run_to_table(rule, spark, "amount_vs_avg").filter(F.col("user_id") != S.SENTINEL_USER)
    return _txn_out(out, "prior_n")


def q_stream_new_device(spark, sf_dir):
    configure(spark)
    rule = STATE.new_device_stream(S.silver_slices(spark, sf_dir))
    out = S.run_to_table(rule, spark, "new_device").filter(F.col("user_id") != S.SENTINEL_USER)
    return _txn_out(out)


def q_stream_velocity_rolling(spark, sf_dir):
    configure(spark)
    rule = STATE.rolling_velocity_stream(S.silver_slices(spark, sf_dir))
    out = S.run_to_table(rule, spark, "velocity_rolling").filter(F.col("user_id") != S.SENTINEL_USER)
    return _txn_out(out, "rolling_count")


def q_stream_young_account(spark, sf_dir):
    configure(spark)
    rule = STATE.young_account_stream(S.silver_slices(spark, sf_dir),
                                      max_age=FIXTURE_RULE_PARAMS["max_age"])
    out = S.run_to_table(rule, spark, "young_account").filter(F.col("user_id") != S.SENTINEL_USER)
    return _txn_out(out, "account_age_seconds")


# --- whole paths: lake jobs, one-hop detection, ingestion, late and repeated rows ------


def q_velocity_expanded_5min(spark, sf_dir):
    """J1 with another window length: 5-minute alerts and their members."""
    silver = _silver(spark, sf_dir)
    hits = C.expand_velocity(R.velocity(silver, window="5 minutes"), silver, window="5 minutes")
    return _ntz(hits, "ingestion_time")


def q_velocity_expanded_dyadic(spark, sf_dir):
    """J1 over alerts of mixed lengths at once: a minute, an hour and a day."""
    silver = _silver(spark, sf_dir)
    alerts = [R.velocity(silver, window=w) for w in ("60 seconds", "1 hour", "24 hours")]
    hits = C.expand_velocity(alerts[0].unionByName(alerts[1]).unionByName(alerts[2]), silver, method="dyadic")
    return _ntz(hits, "ingestion_time")


def q_tagged_union(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    out = R.tagged_union(R.high_amount_gold(silver), R.velocity_gold(silver))
    # half of the cells are NULL: flags as text and the count as a double compare alike everywhere
    flags = ("is_international", "high_amount_flag", "intl_flag", "is_fraud")
    out = out.withColumns({c: F.col(c).cast("string") for c in flags} | {"count": F.col("count").cast("double")})
    return _flat_window(_ntz(out, "ingestion_time"))


def q_lake_fraud_union(spark, sf_dir):
    """Bronze, silver and gold tables on disk, consolidated, then every stage once more for one date."""
    root = work_dir(spark, "lake", unique=True)
    I.to_wire_json(_silver(spark, sf_dir)).write.parquet(f"{root}/bronze")
    info = jobs.run_all(spark, f"{root}/bronze", f"{root}/lake")
    first = spark.read.parquet(info["silver"]).agg(F.min("event_date")).first()[0]
    if first is not None:
        jobs.run_all(spark, f"{root}/bronze", f"{root}/lake", [first.isoformat()])
    out = spark.read.parquet(f"{info['gold']}/fraud_union").select(*FRAUD_UNION_COLS)
    return _rules_text(_ntz(out, "ingestion_time"))


def q_stream_bronze(spark, sf_dir):
    """Text records as they arrive, stamped; the stamp itself is the arrival's."""
    configure(spark)
    out = S.stream_bronze(spark, sf_dir)
    return out.select("value", F.col("ingestion_time").isNotNull().alias("stamped"))


def q_stream_detect_high_amount(spark, sf_dir):
    configure(spark)
    return S.stream_detect(spark, sf_dir)[0]


def q_stream_detect_velocity(spark, sf_dir):
    configure(spark)
    return _velocity_out(S.stream_detect(spark, sf_dir)[1])


def q_stream_velocity_late(spark, sf_dir):
    """Rows that arrive after the watermark has passed them change nothing."""
    configure(spark)
    return _velocity_out(S.stream_velocity_late(spark, sf_dir))


def q_stream_late_rows(spark, sf_dir):
    """The rows that came too late for their window, from the routed stream's side table."""
    configure(spark)
    root, _ = S.late_and_alerts(spark, sf_dir)
    return _ntz(LATE.routed(spark, root, late=True), "ingestion_time")


def q_velocity_repaired(spark, sf_dir):
    """The stream's alerts with the windows of late rows counted again."""
    configure(spark)
    root, alerts = S.late_and_alerts(spark, sf_dir)
    out = LATE.repaired(alerts, LATE.routed(spark, root), LATE.routed(spark, root, late=True))
    return _velocity_out(out.filter(F.col("user_id") != S.SENTINEL_USER))


def q_stream_consolidated_changes(spark, sf_dir):
    """R7 as changes of rule sets, merged by key and version."""
    configure(spark)
    return _rules_text(_ntz(S.stream_consolidated_changes(spark, sf_dir), "ingestion_time"))


def q_stream_velocity_sliding(spark, sf_dir):
    """D2's sliding form on a stream, by panes."""
    configure(spark)
    out = S.run_to_table(PANES.sliding_velocity_stream(S.silver_slices(spark, sf_dir)), spark, "velocity_sliding")
    return _flat_window(out.filter(F.col("user_id") != S.SENTINEL_USER))


def q_velocity_sliding(spark, sf_dir):
    return _flat_window(PANES.sliding_velocity(_silver(spark, sf_dir)))


def q_stream_dedup(spark, sf_dir):
    """D9 on a stream that delivers every row twice; which copy stays is the arrival order's, so no ingestion time."""
    configure(spark)
    return S.stream_dedup(spark, sf_dir).select(*[c for c in TXN_COLS if c != "ingestion_time"])


def q_fraud_model_training(spark, sf_dir):
    """D15's training table: user features and the rule-derived label."""
    from txnguard.operators import model as ML

    silver = _silver(spark, sf_dir)
    feats = M.user_features(silver, _consolidated(silver), exact=True)
    return ML.training_set(feats, ML.user_labels(SC.scored_transactions(silver, **FIXTURE_RULE_PARAMS)))


def _temporal(spark, sf_dir):
    from txnguard.operators import model as ML

    silver = _silver(spark, sf_dir)
    flagged = SC.scored_transactions(silver, **FIXTURE_RULE_PARAMS).where("is_fraud = 1")
    return ML.temporal_training(silver, flagged, horizon="2 minutes", trailing=FIXTURE_TRAILING)


def q_fraud_model_temporal_training(spark, sf_dir):
    """D15 in time: features at a transaction, label after it, split by time."""
    return _temporal(spark, sf_dir).withColumns({c: F.round(c, 2) for c in ("trailing_amount", "prior_sum")})


def q_fraud_model_temporal(spark, sf_dir):
    """D15 in time (no SQL twin): probabilities of the later, held-out period."""
    from txnguard.operators import model as ML

    return ML.fit_temporal(_temporal(spark, sf_dir))


def q_silver_dedup_incremental(spark, sf_dir):
    """D9 against history: half of the rows as one delivery, then all of them redelivered with the other half."""
    silver = _silver(spark, sf_dir)
    first = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 0
    index = SEEN.SeenIds(spark, work_dir(spark, "seen", unique=True), buckets=16, segments=2)
    one, _ = SEEN.dedup_delivery(silver.where(first), index, "d1")
    two, _ = SEEN.dedup_delivery(redelivered(silver.where(~first)).unionByName(silver.where(first)), index, "d2")
    return _ntz(one.unionByName(two), "ingestion_time")


def q_metrics_rollup_incremental(spark, sf_dir):
    """D11 from stored day partials after one day ran again; users are sketch estimates, reported as within 5 % of the exact ones."""
    silver = _silver(spark, sf_dir)
    hits = _consolidated(silver)
    path = work_dir(spark, "rollup_days", unique=True)
    PARTS.write_days(PARTS.day_partials(silver, hits), path)
    day = F.to_date("ingestion_time") == silver.agg(F.min(F.to_date("ingestion_time"))).first()[0]
    PARTS.write_days(PARTS.day_partials(silver.where(day), hits.where(day)), path)
    rollup = PARTS.rollup_of(PARTS.read_days(spark, path)).alias("p")
    exact = M.metrics_rollup(silver, hits, exact=True).alias("e")
    same = F.col("p.grouping_level") == F.col("e.grouping_level")
    for d in M.ROLLUP_DIMS:
        same = same & F.col(f"p.{d}").eqNullSafe(F.col(f"e.{d}"))
    close = lambda c: (F.abs(F.col(f"p.{c}") - F.col(f"e.{c}")) <= 1 + 0.05 * F.col(f"e.{c}")).alias(f"{c}_close")
    figures = ["grouping_level", "n_txn", "total_amount", "n_flagged", "flagged_amount", "flag_rate"]
    out = rollup.join(exact, same).select(*[F.col(f"p.{c}") for c in [*M.ROLLUP_DIMS, *figures]], close("n_users"), close("n_flagged_users"))
    return _date_text(out)


def q_lake_zorder(spark, sf_dir):
    """A table rewritten in Z-order, read whole again."""
    path = work_dir(spark, "zorder", unique=True)
    _silver(spark, sf_dir).write.parquet(path)
    LAYOUT.zorder_table(spark, path, rows_per_file=2000)
    return _ntz(spark.read.parquet(path).select(*TXN_COLS), "ingestion_time")


def q_metrics_rollup_approx(spark, sf_dir):
    """The default rollup, whose distinct users are HyperLogLog estimates."""
    silver = _silver(spark, sf_dir)
    return _date_text(M.metrics_rollup(silver, _consolidated(silver)))


def q_user_features_approx(spark, sf_dir):
    """The default features, whose distinct counts are HyperLogLog estimates."""
    silver = _silver(spark, sf_dir)
    return _ntz(M.user_features(silver, _consolidated(silver)), "first_seen", "last_seen")


def queries() -> dict[str, Query]:
    return {
        "transactions": q_transactions,
        "high_amount": q_high_amount,
        "velocity": q_velocity,
        "velocity_expanded": q_velocity_expanded,
        "velocity_expanded_range": q_velocity_expanded_range,
        "velocity_expanded_bucketed": q_velocity_expanded_bucketed,
        "velocity_expanded_5min": q_velocity_expanded_5min,
        "velocity_expanded_dyadic": q_velocity_expanded_dyadic,
        "profile_quantiles": q_profile_quantiles,
        "tagged_union": q_tagged_union,
        "lake_fraud_union": q_lake_fraud_union,
        "fraud_model_training": q_fraud_model_training,
        "fraud_model_temporal_training": q_fraud_model_temporal_training,
        "fraud_model_temporal": q_fraud_model_temporal,
        "silver_dedup_incremental": q_silver_dedup_incremental,
        "metrics_rollup_incremental": q_metrics_rollup_incremental,
        "lake_zorder": q_lake_zorder,
        "metrics_rollup_approx": q_metrics_rollup_approx,
        "user_features_approx": q_user_features_approx,
        "fraud_union": q_fraud_union,
        "fraud_consolidated": q_fraud_consolidated,
        "bronze_raw": q_bronze_raw,
        "silver_flat": q_silver_flat,
        "silver_quarantine": q_silver_quarantine,
        "silver_valid": q_silver_valid,
        "silver_dedup": q_silver_dedup,
        "silver_normalized": q_silver_normalized,
        "rule_amount_vs_avg": q_rule_amount_vs_avg,
        "velocity_rolling": q_velocity_rolling,
        "rule_location_jump": q_rule_location_jump,
        "rule_amount_vs_avg_split": q_rule_amount_vs_avg_split,
        "velocity_rolling_split": q_velocity_rolling_split,
        "rule_location_jump_split": q_rule_location_jump_split,
        "rule_new_device": q_rule_new_device,
        "rule_young_account": q_rule_young_account,
        "risk_score": q_risk_score,
        "risk_label": q_risk_label,
        "metrics_rollup": q_metrics_rollup,
        "user_features": q_user_features,
        "transaction_features": q_transaction_features,
        "report": q_report,
        "profile": q_profile,
        "fraud_model": q_fraud_model,
        "stream_bronze": q_stream_bronze,
        "stream_detect_high_amount": q_stream_detect_high_amount,
        "stream_detect_velocity": q_stream_detect_velocity,
        "stream_velocity_late": q_stream_velocity_late,
        "stream_late_rows": q_stream_late_rows,
        "velocity_repaired": q_velocity_repaired,
        "stream_consolidated_changes": q_stream_consolidated_changes,
        "stream_velocity_sliding": q_stream_velocity_sliding,
        "velocity_sliding": q_velocity_sliding,
        "stream_dedup": q_stream_dedup,
        "stream_silver": q_stream_silver,
        "stream_high_amount": q_stream_high_amount,
        "stream_velocity": q_stream_velocity,
        "stream_velocity_update": q_stream_velocity_update,
        "stream_velocity_expanded": q_stream_velocity_expanded,
        "stream_consolidated": q_stream_consolidated,
        "stream_location_jump": q_stream_location_jump,
        "stream_amount_vs_avg": q_stream_amount_vs_avg,
        "stream_new_device": q_stream_new_device,
        "stream_young_account": q_stream_young_account,
        "stream_velocity_rolling": q_stream_velocity_rolling,
    }

