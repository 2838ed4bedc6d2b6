"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on DuckDB with the driver tables registered as views
(``events`` etc.). Column names and output types follow the Spark query:
timestamps as naive UTC, windows flattened to ``window_start`` /
``window_end``, rule sets as sorted comma-joined text.
"""

from __future__ import annotations

# events → transactions, the FIXTURES mapping (DuckDB dialect).
TXN_CTE = """
txn AS (
  SELECT 'txn_' || event_id AS transaction_id,
         'user_' || user_id AS user_id,
         (['amazon','walmart','target','bestbuy','flipkart'])[(event_id % 5) + 1] AS merchant_id,
         value * 100.0 AS transaction_amount,
         strftime(make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 1440),
                  '%Y-%m-%dT%H:%M:%S.%f') AS transaction_time,
         'device_' || (CAST(json_extract(props, '$.k') AS INT) % 50 + 1) AS device_id,
         (['India','USA','Canada','UK','Germany'])[(event_id // 7) % 5 + 1] AS location,
         CAST(json_extract(props, '$.k') AS INT) % 2 = 1 AS is_international,
         ts + INTERVAL 5 SECOND AS ingestion_time
  FROM events
)"""

TXN_COLS_SQL = (
    "transaction_id, user_id, merchant_id, transaction_amount, transaction_time, "
    "device_id, location, is_international, ingestion_time"
)

TIMED_CTE = """
timed AS (
  SELECT *, TRY_CAST(transaction_time AS TIMESTAMP) AS event_time FROM txn
)"""

VEL_CTE = """
vel AS (
  SELECT user_id,
         time_bucket(INTERVAL '60 seconds', event_time) AS window_start,
         time_bucket(INTERVAL '60 seconds', event_time) + INTERVAL 60 SECOND AS window_end,
         count(*) AS "count"
  FROM timed
  WHERE event_time IS NOT NULL
  GROUP BY 1, 2, 3
  HAVING count(*) > 5
)"""

HIGH_CTE = f"""
high AS (
  SELECT {TXN_COLS_SQL}, 'HIGH_AMOUNT' AS triggered_rule
  FROM txn WHERE transaction_amount > 20000 AND is_international = true
)"""

VEL_HITS_CTE = """
vel_hits AS (
  SELECT s.transaction_id, v.user_id, s.merchant_id, s.transaction_amount, s.transaction_time,
         s.device_id, s.location, s.is_international, s.ingestion_time,
         'HIGH_VELOCITY' AS triggered_rule
  FROM vel v JOIN timed s
    ON v.user_id = s.user_id AND s.event_time BETWEEN v.window_start AND v.window_end
)"""


TIMED_OK = "(SELECT * FROM timed WHERE event_time IS NOT NULL)"

D1_CTE = f"""
d1 AS (
  SELECT * FROM (
    SELECT *, count(transaction_amount) OVER w AS prior_n, avg(transaction_amount) OVER w AS prior_avg
    FROM {TIMED_OK}
    WINDOW w AS (PARTITION BY user_id ORDER BY event_time, transaction_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  ) WHERE transaction_amount > 3 * prior_avg
)"""

D2_CTE = f"""
d2 AS (
  SELECT * FROM (
    SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(event_time)
                             RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS rolling_count
    FROM {TIMED_OK}
  ) WHERE rolling_count > 5
)"""

D3_CTE = f"""
d3 AS (
  SELECT *, gap_us / 1e6 AS gap_seconds FROM (
    SELECT *, lag(location) OVER w AS prev_location,
           epoch_us(event_time) - lag(epoch_us(event_time)) OVER w AS gap_us
    FROM {TIMED_OK}
    WINDOW w AS (PARTITION BY user_id ORDER BY event_time, transaction_id)
  ) WHERE location <> prev_location AND gap_us < 10000000
)"""

D4_CTE = f"""
d4 AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, device_id
                                 ORDER BY event_time, transaction_id) AS rn
    FROM {TIMED_OK}
  ) WHERE rn = 1 AND transaction_amount > 20000
)"""

D5_CTE = f"""
d5 AS (
  SELECT * FROM (
    SELECT *, (epoch_us(event_time) - min(epoch_us(event_time)) OVER (PARTITION BY user_id)) / 1e6
              AS account_age_seconds
    FROM {TIMED_OK}
  ) WHERE transaction_amount > 20000 AND account_age_seconds < 420
)"""

ALL_HITS_CTE = f"""
all_hits AS (
  SELECT * FROM high
  UNION ALL SELECT * FROM vel_hits
  UNION ALL SELECT {TXN_COLS_SQL}, 'AMOUNT_VS_AVG' FROM d1
  UNION ALL SELECT {TXN_COLS_SQL}, 'LOCATION_JUMP' FROM d3
  UNION ALL SELECT {TXN_COLS_SQL}, 'NEW_DEVICE' FROM d4
  UNION ALL SELECT {TXN_COLS_SQL}, 'YOUNG_ACCOUNT' FROM d5
)"""

SCORED_CTE = f"""
scored AS (
  SELECT *, CASE WHEN risk_score >= 0.6 THEN 1 ELSE 0 END AS is_fraud FROM (
    SELECT {TXN_COLS_SQL},
           array_to_string(list_sort(list(DISTINCT triggered_rule)), ',') AS triggered_rules,
           CAST(count(DISTINCT triggered_rule) AS INTEGER) AS n_rules,
           CAST(CASE WHEN count(DISTINCT triggered_rule) >= 3 THEN 0.9
                     WHEN count(DISTINCT triggered_rule) >= 2 THEN 0.6
                     WHEN count(DISTINCT triggered_rule) >= 1 THEN 0.3 ELSE 0.0 END AS DOUBLE) AS risk_score
    FROM all_hits GROUP BY ALL
  )
)"""


CONS_CTE = f"""
cons AS (
  SELECT {TXN_COLS_SQL},
         list_sort(list(DISTINCT triggered_rule)) AS rules
  FROM (SELECT * FROM high UNION ALL SELECT * FROM vel_hits)
  GROUP BY ALL
)"""


def _rollup_side(src: str, n: str, amt: str, users: str) -> str:
    return f"""
  SELECT strftime(CAST(TRY_CAST(transaction_time AS TIMESTAMP) AS DATE), '%Y-%m-%d') AS event_date,
         location, merchant_id,
         CAST(GROUPING(event_date, location, merchant_id) AS BIGINT) AS grouping_level,
         count(*) AS {n}, round(sum(transaction_amount), 2) AS {amt},
         count(DISTINCT user_id) AS {users}
  FROM {src}
  GROUP BY ROLLUP (event_date, location, merchant_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _base() -> list[str]:
    return [TXN_CTE, TIMED_CTE, VEL_CTE, HIGH_CTE, VEL_HITS_CTE]


def _consolidated_sql() -> str:
    return _with(*_base()) + f"""
SELECT {TXN_COLS_SQL},
       array_to_string(list_sort(list(DISTINCT triggered_rule)), ',') AS triggered_rules
FROM (SELECT * FROM high UNION ALL SELECT * FROM vel_hits)
GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["transactions"] = _with(TXN_CTE) + f"SELECT {TXN_COLS_SQL} FROM txn"
    q["high_amount"] = _with(TXN_CTE) + f"""
SELECT {TXN_COLS_SQL}, true AS high_amount_flag, true AS intl_flag, true AS is_fraud,
       'high_amount' AS fraud_type
FROM txn WHERE transaction_amount > 20000 AND is_international = true"""
    q["velocity"] = _with(TXN_CTE, TIMED_CTE, VEL_CTE) + """
SELECT user_id, window_start, window_end, "count", 'velocity' AS fraud_type FROM vel"""
    q["velocity_expanded"] = _with(*_base()) + "SELECT * FROM vel_hits"
    q["velocity_expanded_range"] = q["velocity_expanded"]
    q["velocity_expanded_bucketed"] = q["velocity_expanded"]
    q["fraud_union"] = _with(*_base()) + "SELECT * FROM high UNION ALL SELECT * FROM vel_hits"
    q["fraud_consolidated"] = _consolidated_sql()
    q["bronze_raw"] = _with(TXN_CTE) + """
SELECT to_json(struct_pack(transaction_id := transaction_id, user_id := user_id,
         merchant_id := merchant_id, transaction_amount := transaction_amount,
         transaction_time := transaction_time, device_id := device_id, location := location,
         is_international := is_international)) AS value,
       ingestion_time
FROM txn"""
    q["velocity_expanded_5min"] = q["velocity_expanded"].replace("60 seconds", "5 minutes").replace("INTERVAL 60 SECOND", "INTERVAL 5 MINUTE")
    q["velocity_expanded_dyadic"] = " UNION ALL ".join(
        f"SELECT * FROM ({q['velocity_expanded'].replace('60 seconds', w).replace('INTERVAL 60 SECOND', n)})"
        for w, n in (("60 seconds", "INTERVAL 60 SECOND"), ("1 hour", "INTERVAL 1 HOUR"), ("24 hours", "INTERVAL 24 HOUR"))
    )
    q["profile_quantiles"] = _with(TXN_CTE) + _quantiles_sql()
    q["tagged_union"] = f"""
SELECT * REPLACE (CAST(is_international AS VARCHAR) AS is_international, CAST(high_amount_flag AS VARCHAR) AS high_amount_flag,
  CAST(intl_flag AS VARCHAR) AS intl_flag, CAST(is_fraud AS VARCHAR) AS is_fraud, CAST("count" AS DOUBLE) AS "count") FROM (
SELECT {TXN_COLS_SQL}, high_amount_flag, intl_flag, is_fraud, fraud_type,
       NULL::TIMESTAMP AS window_start, NULL::TIMESTAMP AS window_end, NULL::BIGINT AS "count"
FROM ({q['high_amount']})
UNION ALL BY NAME SELECT * FROM ({q['velocity']}))"""
    q["lake_fraud_union"] = q["fraud_consolidated"]
    q["stream_bronze"] = f"SELECT value, true AS stamped FROM ({q['bronze_raw']})"
    q["stream_detect_high_amount"] = f"SELECT * EXCLUDE (ingestion_time) FROM ({q['high_amount']})"
    q["stream_detect_velocity"] = q["velocity"]
    q["stream_velocity_late"] = q["velocity"]
    q["stream_dedup"] = f"SELECT * EXCLUDE (ingestion_time) FROM ({q['transactions']})"
    q["stream_late_rows"] = _with(TXN_CTE, TIMED_CTE) + f"""
SELECT {TXN_COLS_SQL} FROM timed
WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 7 = 3
  AND time_bucket(INTERVAL '60 seconds', event_time) + INTERVAL 60 SECOND <= (
    SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 2 MINUTE FROM timed WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 7 <> 3)"""
    q["velocity_repaired"] = q["velocity"]
    q["stream_consolidated_changes"] = q["fraud_consolidated"]
    q["velocity_sliding"] = _with(TXN_CTE, TIMED_CTE) + """
SELECT user_id, window_start, window_start + INTERVAL 60 SECOND AS window_end, count(*) AS "count" FROM (
  SELECT user_id, time_bucket(INTERVAL '10 seconds', event_time) - to_seconds(10 * unnest(range(6))) AS window_start
  FROM timed WHERE event_time IS NOT NULL)
GROUP BY ALL HAVING count(*) > 5"""
    q["stream_velocity_sliding"] = q["velocity_sliding"]
    q["silver_flat"] = q["transactions"]
    q["stream_silver"] = q["transactions"]
    q["stream_high_amount"] = q["high_amount"]
    q["stream_velocity"] = q["velocity"]
    q["stream_velocity_update"] = q["velocity"]
    q["stream_velocity_expanded"] = q["velocity_expanded"]
    q["stream_consolidated"] = q["fraud_consolidated"]
    q["silver_valid"] = q["transactions"]
    q["silver_dedup"] = q["transactions"]
    q["silver_quarantine"] = f"""
WITH raw AS (
  SELECT props AS value, ts + INTERVAL 5 SECOND AS ingestion_time FROM events
  UNION ALL
  SELECT event_type AS value, ts + INTERVAL 5 SECOND AS ingestion_time FROM events
),
checked AS (
  SELECT value, ingestion_time,
    CASE WHEN value IS NULL OR trim(value) = '' THEN 'empty'
         WHEN NOT json_valid(value) THEN 'malformed_json'
         {_missing_checks()}
    END AS reject_reason
  FROM raw
)
SELECT * FROM checked WHERE reject_reason IS NOT NULL"""
    q["silver_normalized"] = _with(TXN_CTE) + """
SELECT trim(transaction_id) AS transaction_id,
       lower(trim(user_id)) AS user_id,
       lower(trim(merchant_id)) AS merchant_id,
       round(transaction_amount, 2) AS transaction_amount,
       coalesce(strftime(TRY_CAST(trim(transaction_time) AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%f'),
                transaction_time) AS transaction_time,
       lower(trim(device_id)) AS device_id,
       coalesce(CASE lower(trim(location)) WHEN 'india' THEN 'India' WHEN 'usa' THEN 'USA'
                  WHEN 'canada' THEN 'Canada' WHEN 'uk' THEN 'UK' WHEN 'germany' THEN 'Germany' END,
                trim(location)) AS location,
       is_international,
       ingestion_time,
       lower(trim(merchant_id)) IN ('amazon','walmart','target','bestbuy','flipkart') AS merchant_known,
       lower(trim(location)) IN ('india','usa','canada','uk','germany') AS location_known
FROM txn"""
    t = [TXN_CTE, TIMED_CTE]
    q["rule_amount_vs_avg"] = _with(*t, D1_CTE) + f"SELECT {TXN_COLS_SQL}, prior_n FROM d1"
    q["velocity_rolling"] = _with(*t, D2_CTE) + f"SELECT {TXN_COLS_SQL}, rolling_count FROM d2"
    q["rule_location_jump"] = _with(*t, D3_CTE) + (
        f"SELECT {TXN_COLS_SQL}, prev_location, gap_seconds FROM d3")
    q["rule_new_device"] = _with(*t, D4_CTE) + f"SELECT {TXN_COLS_SQL} FROM d4"
    q["rule_young_account"] = _with(*t, D5_CTE) + (
        f"SELECT {TXN_COLS_SQL}, account_age_seconds FROM d5")
    scored = _with(*_base(), D1_CTE, D3_CTE, D4_CTE, D5_CTE, ALL_HITS_CTE, SCORED_CTE)
    for name in ("rule_amount_vs_avg", "velocity_rolling", "rule_location_jump"):
        q[f"{name}_split"] = q[name]
    q["stream_location_jump"] = q["rule_location_jump"]
    q["stream_amount_vs_avg"] = q["rule_amount_vs_avg"]
    q["stream_new_device"] = q["rule_new_device"]
    q["stream_young_account"] = q["rule_young_account"]
    q["stream_velocity_rolling"] = q["velocity_rolling"]
    q["risk_score"] = scored + (
        f"SELECT {TXN_COLS_SQL}, triggered_rules, n_rules, risk_score FROM scored")
    q["risk_label"] = scored + "SELECT transaction_id, ingestion_time, risk_score, is_fraud FROM scored"
    q["metrics_rollup"] = _with(*_base(), CONS_CTE) + f"""
SELECT t.event_date, t.location, t.merchant_id, t.grouping_level, n_txn, total_amount, n_users,
       coalesce(n_flagged, 0) AS n_flagged, coalesce(flagged_amount, 0.0) AS flagged_amount,
       coalesce(n_flagged_users, 0) AS n_flagged_users,
       coalesce(n_flagged, 0) / n_txn AS flag_rate
FROM ({_rollup_side('txn', 'n_txn', 'total_amount', 'n_users')}) t
LEFT JOIN ({_rollup_side('cons', 'n_flagged', 'flagged_amount', 'n_flagged_users')}) f
  ON t.grouping_level = f.grouping_level AND t.event_date IS NOT DISTINCT FROM f.event_date
 AND t.location IS NOT DISTINCT FROM f.location AND t.merchant_id IS NOT DISTINCT FROM f.merchant_id"""
    q["user_features"] = _with(*_base(), CONS_CTE) + """
SELECT b.*, coalesce(h.n_flagged, 0) AS n_flagged FROM (
  SELECT user_id, count(*) AS n_txn, round(sum(transaction_amount), 2) AS total_amount,
         round(avg(transaction_amount), 2) AS avg_amount, max(transaction_amount) AS max_amount,
         count(DISTINCT device_id) AS n_devices, count(DISTINCT location) AS n_locations,
         count(DISTINCT merchant_id) AS n_merchants,
         count(CASE WHEN is_international THEN 1 END) AS n_international,
         min(event_time) AS first_seen, max(event_time) AS last_seen
  FROM timed GROUP BY user_id
) b LEFT JOIN (SELECT user_id AS hu, count(*) AS n_flagged FROM cons GROUP BY user_id) h
  ON b.user_id IS NOT DISTINCT FROM h.hu"""
    q["fraud_model_training"] = f"""
SELECT f.user_id, CAST(n_txn AS DOUBLE) AS n_txn, total_amount, avg_amount, max_amount,
       CAST(n_devices AS DOUBLE) AS n_devices, CAST(n_locations AS DOUBLE) AS n_locations,
       CAST(n_merchants AS DOUBLE) AS n_merchants, CAST(n_international AS DOUBLE) AS n_international,
       CAST(coalesce(l.label, 0) AS DOUBLE) AS label
FROM ({q['user_features']}) f
LEFT JOIN (SELECT user_id, max(is_fraud) AS label FROM ({scored} SELECT * FROM scored) GROUP BY user_id) l
  ON f.user_id IS NOT DISTINCT FROM l.user_id"""
    q["transaction_features"] = _with(TXN_CTE, TIMED_CTE) + f"""
SELECT {TXN_COLS_SQL},
       count(*) OVER wr AS trailing_count,
       round(sum(transaction_amount) OVER wr, 2) AS trailing_amount,
       count(DISTINCT device_id) OVER wr AS trailing_devices,
       count(transaction_amount) OVER wp AS prior_n,
       round(coalesce(sum(transaction_amount) OVER wp, 0.0), 2) AS prior_sum,
       CASE WHEN gap_us < 60000000 THEN gap_us / 1e6 END AS seconds_since_prev
FROM (
  SELECT *, epoch_us(event_time) AS us,
         epoch_us(event_time) - lag(epoch_us(event_time)) OVER (
           PARTITION BY user_id ORDER BY event_time, transaction_id) AS gap_us
  FROM timed WHERE event_time IS NOT NULL
)
WINDOW wr AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW),
       wp AS (PARTITION BY user_id ORDER BY event_time, transaction_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
    q["silver_dedup_incremental"] = q["transactions"]
    q["lake_zorder"] = q["transactions"]
    q["metrics_rollup_incremental"] = f"""
SELECT event_date, location, merchant_id, grouping_level, n_txn, total_amount, n_flagged, flagged_amount, flag_rate,
       true AS n_users_close, true AS n_flagged_users_close FROM ({q['metrics_rollup']})"""
    q["fraud_model_temporal_training"] = f"""
WITH f AS (SELECT *, epoch_us(TRY_CAST(transaction_time AS TIMESTAMP)) AS us FROM ({q['transaction_features']})),
bad AS (SELECT user_id, epoch_us(TRY_CAST(transaction_time AS TIMESTAMP)) AS us FROM ({scored} SELECT * FROM scored WHERE is_fraud = 1)),
ends AS (SELECT min(us) AS low, max(us) AS high, min(us) + CAST(floor((max(us) - min(us)) * CAST(0.7 AS DOUBLE)) AS BIGINT) AS cut FROM f)
SELECT transaction_id, user_id, coalesce(transaction_amount, 0.0) AS transaction_amount, coalesce(CAST(CAST(is_international AS INTEGER) AS DOUBLE), 0.0) AS international,
       CAST(trailing_count AS DOUBLE) AS trailing_count, coalesce(trailing_amount, 0.0) AS trailing_amount, CAST(trailing_devices AS DOUBLE) AS trailing_devices,
       CAST(prior_n AS DOUBLE) AS prior_n, prior_sum, coalesce(seconds_since_prev, 60.0) AS since_prev,
       CASE WHEN EXISTS (SELECT 1 FROM bad b WHERE b.user_id = f.user_id AND b.us > f.us AND b.us <= f.us + 120000000) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
       CASE WHEN us + 120000000 <= cut THEN 'train' ELSE 'test' END AS split
FROM f, ends WHERE us + 120000000 <= cut OR (us > cut AND us + 120000000 <= high)"""
    q["report"] = _with(*_base(), CONS_CTE) + f"""
SELECT {TXN_COLS_SQL}, array_to_string(rules, ',') AS triggered_rules,
       CAST(len(rules) AS INTEGER) AS n_rules,
       CAST(CASE WHEN len(rules) >= 3 THEN 0.9 WHEN len(rules) >= 2 THEN 0.6
                 WHEN len(rules) >= 1 THEN 0.3 ELSE 0.0 END AS DOUBLE) AS risk_score,
       strftime(CAST(TRY_CAST(transaction_time AS TIMESTAMP) AS DATE), '%Y-%m-%d') AS event_date
FROM cons"""
    q["profile"] = _with(TXN_CTE) + _profile_sql()
    return q


def _profile_sql() -> str:
    fields = ["transaction_id", "user_id", "merchant_id", "transaction_amount",
              "transaction_time", "device_id", "location", "is_international", "ingestion_time"]
    parts = [
        f"SELECT '{f}' AS column_name, count(*) - count({f}) AS n_null, "
        f"count(DISTINCT {f}) AS n_distinct, CAST(min({f}) AS VARCHAR) AS min_value, "
        f"CAST(max({f}) AS VARCHAR) AS max_value, count(*) AS n_rows FROM txn"
        for f in fields
    ]
    return "\nUNION ALL ".join(parts)


def _quantiles_sql() -> str:
    """Every quantile's rank lies within the error, so the checks are all true; extremes and counts are exact."""
    texts = ["transaction_id", "user_id", "merchant_id", "device_id", "location"]
    measures = {f: f"CAST(length({f}) AS DOUBLE)" for f in texts} | {
        "transaction_amount": "transaction_amount",
        "transaction_time": "epoch_us(TRY_CAST(transaction_time AS TIMESTAMP)) / 1e6",
        "ingestion_time": "epoch_us(ingestion_time) / 1e6",
        "is_international": "CAST(CAST(is_international AS INTEGER) AS DOUBLE)",
    }
    checks = ", ".join(f"true AS q{p:03d}_ok" for p in (10, 50, 250, 500, 750, 950, 990))
    return "\nUNION ALL ".join(
        f"SELECT '{f}' AS column_name, count({m}) AS n_values, min({m}) AS min_measure, max({m}) AS max_measure, {checks} FROM txn" for f, m in measures.items()
    )


def _missing_checks() -> str:
    fields = ["transaction_id", "user_id", "merchant_id", "transaction_amount",
              "transaction_time", "device_id", "location", "is_international"]
    return "\n         ".join(
        f"WHEN json_extract(value, '$.{f}') IS NULL OR json_type(json_extract(value, '$.{f}')) = 'NULL' "
        f"THEN 'missing_{f}'"
        for f in fields
    )
