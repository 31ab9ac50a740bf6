"""The same results in DuckDB SQL, keyed like the queries."""

from __future__ import annotations

TRANSFERS = """
transfers AS (
  SELECT CAST(e.user_id AS varchar) AS payer_id,
         CAST(s.s_suppkey AS varchar) AS payee_id,
         e.event_type AS tx_type,
         e.value AS amount,
         c.c_acctbal AS payer_balance_before,
         c.c_acctbal - e.value AS payer_balance_after,
         s.s_acctbal AS payee_balance_before,
         s.s_acctbal + e.value AS payee_balance_after,
         e.ts AS event_time,
         CAST(CAST(e.event_type = 'error' AS int) AS double) AS is_fraud
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN supplier s ON s.s_suppkey = e.event_id % (SELECT count(*) FROM supplier)
),
keyed AS (
  SELECT sha256(concat_ws('||', payer_id, payee_id, tx_type, CAST(event_time AS varchar),
                          CAST(amount AS varchar))) AS transaction_id, *
  FROM transfers
)"""


def _features(rows: str) -> str:
    return f"""
features AS (
  SELECT *,
         CAST(hour(event_time) AS int) AS hour_of_day,
         CAST(dayofweek(event_time) + 1 AS int) AS day_of_week,
         dayofweek(event_time) BETWEEN 1 AND 5 AS is_weekday,
         hour(event_time) >= 22 OR hour(event_time) < 6 AS is_night,
         CASE WHEN coalesce(payer_balance_before, 0) = 0 THEN 0.0
              ELSE payer_balance_after / payer_balance_before END AS residual_balance_ratio,
         CASE WHEN coalesce(payee_balance_before, 0) = 0 THEN 0.0
              ELSE amount / payee_balance_before END AS payee_amount_ratio
  FROM {rows}
)"""


def _scored(calibrated: str = "true") -> str:
    """Scored rows under thresholds of the feature rows that ``calibrated`` selects."""
    return f"""
limits AS (
  SELECT quantile_disc(amount, 0.95) AS p95_amount,
         quantile_disc(residual_balance_ratio, 0.95) AS p95_residual_balance_ratio,
         quantile_disc(payee_amount_ratio, 0.95) AS p95_payee_amount_ratio
  FROM features WHERE {calibrated}
),
flagged AS (
  SELECT features.*,
         CAST(is_night AS int) AS flag_night,
         CAST(is_night AND amount > p95_amount AS int) AS flag_night_high_amount,
         CAST(amount > p95_amount AS int) AS flag_high_amount,
         CAST(residual_balance_ratio > p95_residual_balance_ratio AS int) AS flag_residual_balance,
         CAST(payee_amount_ratio > p95_payee_amount_ratio AS int) AS flag_payee_ratio
  FROM features, limits
),
counted AS (
  SELECT *, CAST(flag_night + flag_night_high_amount + flag_high_amount
                 + flag_residual_balance + flag_payee_ratio AS int) AS risk_score
  FROM flagged
),
scored AS (
  SELECT *, CASE WHEN risk_score >= 4 THEN 'CRITICAL' WHEN risk_score = 3 THEN 'HIGH'
                 WHEN risk_score = 2 THEN 'MEDIUM' WHEN risk_score = 1 THEN 'LOW'
                 ELSE 'NORMAL' END AS risk_level
  FROM counted
)"""


# What Bronze holds after the second batch: one day's labels are turned around.
BATCHES = """
stored AS (
  SELECT * EXCLUDE (is_fraud),
         CASE WHEN CAST(event_time AS date) = DATE '2024-01-15' THEN 1 - is_fraud
              ELSE is_fraud END AS is_fraud
  FROM keyed
),
passed AS (SELECT * FROM stored WHERE amount > 0)"""

WITH_FEATURES = f"WITH {TRANSFERS}, {_features('keyed')}"
WITH_SCORED = f"{WITH_FEATURES}, {_scored()}"
FIRST_BATCH = "event_time < TIMESTAMP '2024-01-16 00:00:00'"
WITH_STORED_SCORED = f"WITH {TRANSFERS}, {BATCHES}, {_features('stored')}, {_scored(FIRST_BATCH)}"
# The gate refuses amounts that are not above zero; Silver and what follows lack them.
WITH_PASSED_SCORED = f"WITH {TRANSFERS}, {BATCHES}, {_features('passed')}, {_scored(FIRST_BATCH)}"

TOTALS = """CAST(count(*) AS bigint) AS tx_count, CAST(sum(is_fraud) AS bigint) AS fraud_count,
       round(sum(amount), 2) AS amount_sum"""

BRONZE_COLUMNS = """transaction_id, payer_id, payee_id, tx_type, amount,
       payer_balance_before, payer_balance_after, payee_balance_before, payee_balance_after,
       event_time, is_fraud, 'day=' || CAST(CAST(event_time AS date) AS varchar) AS source_file,
       TIMESTAMP '2024-06-01 12:30:00' AS ingested_at, DATE '2024-06-01' AS ingested_date"""

METRICS = """
metrics AS (
  SELECT (SELECT count(*) FROM transfers) AS bronze_count,
         count(*) AS silver_count,
         count(*) FILTER (is_fraud IS NULL) AS null_fraud,
         count(*) FILTER (amount <= 0) AS nonpositive_amount,
         count(*) FILTER (is_fraud NOT IN (0, 1)) AS fraud_out_of_domain,
         count(*) FILTER (risk_score IS NULL) AS missing_score,
         coalesce(avg(CAST(is_fraud AS double)), 0.0) AS fraud_rate,
         coalesce(avg(CAST(risk_level = 'CRITICAL' AS double)), 0.0) AS critical_rate
  FROM scored
)"""

FILE_LOG = """
log AS (
  SELECT 'day=' || CAST(day AS varchar) AS source_file,
         CASE WHEN day = DATE '2024-01-20' THEN 'FAILED' ELSE 'SUCCESS' END AS status
  FROM (SELECT DISTINCT CAST(ts AS date) AS day FROM events)
  WHERE day <= DATE '2024-01-15' OR day = DATE '2024-01-20'
),
new_days AS (
  SELECT DISTINCT 'day=' || CAST(CAST(ts AS date) AS varchar) AS source_file FROM events
  EXCEPT SELECT source_file FROM log WHERE status = 'SUCCESS'
)"""

HISTORY = """
weeks AS (
  SELECT CAST(date_trunc('week', event_time) AS timestamp) AS week, max(amount) AS p95_amount,
         max(residual_balance_ratio) AS p95_residual_balance_ratio,
         max(payee_amount_ratio) AS p95_payee_amount_ratio
  FROM features GROUP BY 1
),
history AS (
  SELECT strftime(week, '%Y%m%d') AS threshold_version, p95_amount,
         p95_residual_balance_ratio, p95_payee_amount_ratio, week AS valid_from,
         CASE WHEN week < (SELECT max(week) FROM weeks)
              THEN week + INTERVAL 7 DAY END AS valid_to
  FROM weeks
)"""

UPSERT = """
target AS (SELECT * FROM keyed WHERE event_time < TIMESTAMP '2024-01-20 00:00:00'),
source AS (
  SELECT * EXCLUDE (is_fraud), 1 - is_fraud AS is_fraud
  FROM keyed WHERE event_time >= TIMESTAMP '2024-01-10 00:00:00'
)"""

MARKS = """
stored AS (
  SELECT event_type AS layer_name, max(ts) AS mark FROM events
  WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1
),
newer AS (
  SELECT event_type AS layer_name, max(ts) AS mark FROM events
  WHERE event_type <> 'view' GROUP BY 1
)"""

ORACLES = {
    "list_files": """
        SELECT CAST(ts AS date) AS day, CAST(1 AS bigint) AS file_count, CAST(count(*) AS bigint) AS row_count,
               min(ts) AS first_at, max(ts) AS last_at
        FROM events GROUP BY 1""",
    "scan_with_path": f"""WITH {TRANSFERS}
        SELECT payer_id, event_time, amount, is_fraud,
               CASE WHEN second(event_time) % 2 = 0 THEN 'double' ELSE 'decimal' END AS kind
        FROM transfers""",
    "processed_files": f"WITH {FILE_LOG} SELECT source_file FROM log WHERE status = 'SUCCESS'",
    "new_files": f"WITH {FILE_LOG} SELECT source_file FROM new_days",
    "file_log_rows": f"""WITH {FILE_LOG}
        SELECT source_file, TIMESTAMP '2024-06-01 12:30:00' AS processed_at, 'SUCCESS' AS status
        FROM new_days""",
    "transaction_id": f"""WITH {TRANSFERS}
        SELECT transaction_id, payer_id, payee_id, tx_type, event_time, amount FROM keyed""",
    "key_days": f"""WITH {TRANSFERS}
        SELECT transaction_id, CAST(CAST(event_time AS date) AS varchar) AS key_day FROM keyed""",
    "ingest_metadata": f"""WITH {TRANSFERS}
        SELECT payer_id, event_time, source_file, ingested_at, ingested_date
        FROM (SELECT {BRONZE_COLUMNS} FROM keyed)""",
    "bronze_rows": f"WITH {TRANSFERS} SELECT {BRONZE_COLUMNS} FROM keyed",
    "time_features": f"""{WITH_FEATURES}
        SELECT payer_id, event_time, hour_of_day, day_of_week, is_weekday, is_night FROM features""",
    "balance_ratios": f"""{WITH_FEATURES}
        SELECT payer_id, event_time, residual_balance_ratio, payee_amount_ratio FROM features""",
    "rule_flags": f"""{WITH_SCORED}
        SELECT transaction_id, flag_night, flag_night_high_amount, flag_high_amount,
               flag_residual_balance, flag_payee_ratio FROM scored""",
    "score_level": f"{WITH_SCORED} SELECT transaction_id, risk_score, risk_level FROM scored",
    "silver_rows": f"""{WITH_SCORED}
        SELECT {BRONZE_COLUMNS}, hour_of_day, day_of_week, is_weekday, is_night,
               residual_balance_ratio, payee_amount_ratio, flag_night, flag_night_high_amount,
               flag_high_amount, flag_residual_balance, flag_payee_ratio, risk_score, risk_level,
               'exact' AS threshold_version
        FROM scored""",
    "thresholds_exact": f"{WITH_SCORED} SELECT * FROM limits",
    "thresholds_approx_bound": f"""WITH {TRANSFERS}
        SELECT unnest(['p95_amount', 'p95_residual_balance_ratio', 'p95_payee_amount_ratio']) AS metric,
               CAST(count(*) AS bigint) AS value_count, true AS within_bound FROM transfers""",
    "active_threshold": f"""{WITH_FEATURES}, {HISTORY}
        SELECT * FROM history WHERE valid_to IS NULL""",
    "publish_thresholds": f"""{WITH_SCORED}, {HISTORY}
        SELECT * REPLACE (coalesce(valid_to, TIMESTAMP '2024-02-01 03:00:00') AS valid_to) FROM history
        UNION ALL
        SELECT 'new', p95_amount, p95_residual_balance_ratio, p95_payee_amount_ratio,
               TIMESTAMP '2024-02-01 03:00:00', NULL FROM limits""",
    "quality_metrics": f"""{WITH_SCORED}, {METRICS}
        SELECT *, bronze_count = silver_count AS counts_match FROM metrics""",
    "quality_gate": f"""{WITH_SCORED}, {METRICS}, checks AS (
          SELECT unnest(['count_mismatch', 'null_fraud', 'nonpositive_amount', 'fraud_out_of_domain',
                         'missing_score', 'fraud_rate', 'critical_rate']) AS check_name,
                 unnest([CAST(abs(bronze_count - silver_count) AS double), null_fraud, nonpositive_amount,
                         fraud_out_of_domain, missing_score, fraud_rate, critical_rate]) AS observed
          FROM metrics)
        SELECT check_name, observed, check_name NOT LIKE '%_rate' AS blocking,
               check_name LIKE '%_rate' OR observed = 0 AS passed FROM checks""",
    "risk_effectiveness": f"{WITH_SCORED} SELECT risk_level, {TOTALS} FROM scored GROUP BY risk_level",
    "operational": f"""{WITH_SCORED}
        SELECT is_weekday, is_night, {TOTALS} FROM scored GROUP BY is_weekday, is_night""",
    "alerts": f"""{WITH_SCORED}
        SELECT transaction_id, event_time, payer_id, payee_id, amount, risk_score, risk_level,
               'exact' AS threshold_version
        FROM scored WHERE risk_score >= 3""",
    "batch_bounds": """
        SELECT CAST(count(*) AS bigint) AS batch_rows, max(ts) AS max_ingested_at
        FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'""",
    "incremental_read": f"""WITH {TRANSFERS}
        SELECT transaction_id, event_time, amount, CAST(date_trunc('day', event_time) AS timestamp) AS ingested_at
        FROM keyed WHERE event_time >= TIMESTAMP '2024-01-21 00:00:00'""",
    "empty_batch": """
        SELECT 'before' AS mark, CAST(count(*) AS bigint) AS batch_rows, count(*) = 0 AS is_empty
        FROM events WHERE ts >= TIMESTAMP '2024-01-21 00:00:00'
        UNION ALL SELECT 'after', 0, true""",
    "watermark_latest": """
        SELECT event_type AS layer_name, max(ts) AS last_ingestion_timestamp FROM events GROUP BY event_type""",
    "set_watermark": f"""WITH {MARKS}
        SELECT layer_name, coalesce(n.mark, s.mark) AS last_ingestion_timestamp
        FROM stored s FULL JOIN newer n USING (layer_name)""",
    "upsert": f"""WITH {TRANSFERS}, {UPSERT}
        SELECT CAST(CAST(event_time AS date) AS varchar) AS key_day, transaction_id, event_time, amount,
               coalesce(s.is_fraud, t.is_fraud) AS is_fraud
        FROM target t FULL JOIN source s USING (transaction_id, event_time, amount)""",
    "upsert_matches": f"""WITH {TRANSFERS}, {UPSERT}
        SELECT CAST(CAST(t.event_time AS date) AS varchar) AS key_day,
               CAST(count(*) AS bigint) AS rows_hit, CAST(1 AS bigint) AS most_copies
        FROM target t JOIN source s USING (transaction_id) GROUP BY 1""",
    "upsert_keep_last": f"""WITH {TRANSFERS}, {UPSERT}
        SELECT CAST(CAST(event_time AS date) AS varchar) AS key_day, transaction_id, event_time, amount,
               CASE WHEN s.is_fraud IS NOT NULL THEN CAST(1 AS double) ELSE t.is_fraud END AS is_fraud
        FROM target t FULL JOIN source s USING (transaction_id, event_time, amount)""",
    "calibration_guard": f"""{WITH_FEATURES}, measures AS (
          SELECT 'whole' AS history, amount, residual_balance_ratio, payee_amount_ratio FROM features
          UNION ALL SELECT 'no amounts', NULL, residual_balance_ratio,
                 CASE WHEN coalesce(payee_balance_before, 0) = 0 THEN 0.0 END FROM features
          UNION ALL SELECT 'no payer balances', amount,
                 CASE WHEN coalesce(payer_balance_before, 0) = 0 THEN 0.0 END, payee_amount_ratio FROM features
        ), counted AS (
          SELECT history, unnest(['p95_amount', 'p95_residual_balance_ratio', 'p95_payee_amount_ratio']) AS metric,
                 unnest([count(amount), count(residual_balance_ratio), count(payee_amount_ratio)]) AS value_count
          FROM measures GROUP BY history
          UNION ALL SELECT 'before the first event',
                 unnest(['p95_amount', 'p95_residual_balance_ratio', 'p95_payee_amount_ratio']), 0
        )
        SELECT history, metric, CAST(value_count AS bigint) AS value_count, value_count = 0 AS refused FROM counted""",
    "refused_batch": """
        WITH batch AS (SELECT hour(ts) AS h, value FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'),
        failed AS (
          SELECT 'nonpositive_amount' AS check_name, count(*) AS observed FROM batch WHERE h = 4 OR value <= 0
          UNION ALL SELECT 'fraud_out_of_domain', count(*) FROM batch WHERE h = 3
        )
        SELECT check_name, CAST(observed AS bigint) AS observed,
               (SELECT CAST(count(*) AS bigint) FROM events
                WHERE ts < TIMESTAMP '2024-01-16 00:00:00' AND value > 0) AS silver_rows
        FROM failed WHERE observed > 0""",
    "gate_results": """
        WITH batch AS (SELECT hour(ts) AS h, value FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'),
        checks AS (
          SELECT 1 AS batch, unnest(['count_mismatch', 'null_fraud', 'nonpositive_amount',
                                     'fraud_out_of_domain', 'missing_score']) AS check_name, 0 AS observed
          UNION ALL SELECT 2, unnest(['count_mismatch', 'null_fraud', 'missing_score']), 0
          UNION ALL SELECT 2, 'nonpositive_amount', count(*) FROM batch WHERE h = 4 OR value <= 0
          UNION ALL SELECT 2, 'fraud_out_of_domain', count(*) FROM batch WHERE h = 3
        )
        SELECT CAST(batch AS int) AS batch, check_name, CAST(observed AS double) AS observed,
               observed = 0 AS passed FROM checks""",
    "ingest_job": f"""WITH {TRANSFERS}, {BATCHES}
        SELECT transaction_id, event_time, amount, is_fraud FROM stored""",
    "changed_file": f"""WITH {TRANSFERS}
        SELECT transaction_id, event_time, amount,
               CASE WHEN CAST(event_time AS date) = DATE '2024-01-05' THEN 1 - is_fraud ELSE is_fraud END AS is_fraud
        FROM keyed
        WHERE {FIRST_BATCH} AND amount > 0
          AND (CAST(event_time AS date) <> DATE '2024-01-05' OR CAST(floor(second(event_time)) AS int) % 2 = 1)""",
    "bootstrap_job": f"{WITH_STORED_SCORED} SELECT *, true AS is_active FROM limits",
    "window_thresholds": f"""WITH {TRANSFERS}, {_features('keyed')}, days AS (
        SELECT *, CAST(event_time AS date) AS day FROM features),
        ends AS (
          SELECT max(day) AS last, true AS is_active FROM days
          UNION ALL SELECT max(day), false FROM days WHERE {FIRST_BATCH})
        SELECT quantile_disc(amount, 0.95) AS p95_amount,
               quantile_disc(residual_balance_ratio, 0.95) AS p95_residual_balance_ratio,
               quantile_disc(payee_amount_ratio, 0.95) AS p95_payee_amount_ratio, is_active
        FROM days JOIN ends ON day > last - 7 AND day <= last GROUP BY is_active""",
    "day_sketches": f"""WITH {TRANSFERS}
        SELECT CAST(CAST(event_time AS date) AS varchar) AS key_day, count(amount) AS amount_count,
               CAST(0 AS bigint) AS amount_nan, quantile_disc(amount, 0.95) AS p95_amount
        FROM transfers GROUP BY ALL""",
    # a day of n transfers has as many leading digits as leave a bucket 50 of them
    "corrected_bucket": f"""WITH {TRANSFERS}, days AS (
          SELECT CAST(event_time AS date) AS day, count(*) AS n FROM transfers GROUP BY day),
        buckets AS (
          SELECT transaction_id, is_fraud, day, day = DATE '2024-01-15' AND transaction_id LIKE 'a%' AS resent,
                 CASE WHEN n > 12800 THEN 3 WHEN n > 800 THEN 2 WHEN n > 50 THEN 1 ELSE 0 END AS digits
          FROM keyed JOIN days ON day = CAST(event_time AS date))
        SELECT transaction_id, CASE WHEN resent THEN 1 - is_fraud ELSE is_fraud END AS is_fraud,
               bool_or(resent) OVER (PARTITION BY day, transaction_id[1:digits]) AS rewritten
        FROM buckets""",
    "compacted_days": f"""WITH {TRANSFERS}
        SELECT CAST(CAST(event_time AS date) AS varchar) AS key_day, count(*) AS row_count, true AS few_files
        FROM transfers GROUP BY ALL""",
    "recalibrate_job": f"""{WITH_STORED_SCORED}
        SELECT *, false AS is_active FROM limits
        UNION ALL
        SELECT quantile_disc(amount, 0.95), quantile_disc(residual_balance_ratio, 0.95),
               quantile_disc(payee_amount_ratio, 0.95), true FROM features""",
    "score_job": f"""{WITH_PASSED_SCORED}
        SELECT transaction_id, amount, is_fraud, risk_score, risk_level FROM scored""",
    "gold_job_risk": f"{WITH_PASSED_SCORED} SELECT risk_level, {TOTALS} FROM scored GROUP BY risk_level",
    "gold_job_operational": f"""{WITH_PASSED_SCORED}
        SELECT is_weekday, is_night, {TOTALS} FROM scored GROUP BY is_weekday, is_night""",
    "daily_jobs_alerts": f"""{WITH_PASSED_SCORED}
        SELECT transaction_id, event_time, payer_id, payee_id, amount, risk_score, risk_level
        FROM scored WHERE risk_score >= 3""",
}
ORACLES["stream_ingest"] = ORACLES["ingest_job"]
ORACLES["thresholds_exact_narrowed"] = ORACLES["thresholds_exact"]
ORACLES["bootstrap_job_approximate"] = ORACLES["thresholds_approx_bound"]
ORACLES["risk_effectiveness_from_base"] = ORACLES["risk_effectiveness"]
ORACLES["operational_from_base"] = ORACLES["operational"]
