"""The same results in SQL, over the same tables."""

from __future__ import annotations

VIEWS = {
    "tx": """
        SELECT *, CASE WHEN tx_fraud_scenario > 0 THEN 1 ELSE 0 END AS tx_fraud FROM (
          SELECT *, CASE WHEN tx_amount > 150 THEN 1
                         WHEN terminal_id % 20 = 0 AND event_type = 'purchase' THEN 2
                         WHEN event_type = 'error' AND customer_id % 10 = 0 THEN 3
                         ELSE 0 END AS tx_fraud_scenario
          FROM (
            SELECT event_id AS transaction_id, date_trunc('second', ts) AS tx_datetime,
                   user_id AS customer_id,
                   CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS terminal_id,
                   value AS tx_amount,
                   CAST((day(ts) - 1) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts)
                        AS BIGINT) AS tx_time_seconds,
                   CAST(day(ts) - 1 AS BIGINT) AS tx_time_days, event_type
            FROM events))""",
    "raw_fields": """
        SELECT CASE WHEN f = 1 THEN 'abc' ELSE CAST(transaction_id AS VARCHAR) END AS transaction_id,
               CASE WHEN f = 3 THEN '2019-13-45 00:00:00'
                    ELSE strftime(tx_datetime, '%Y-%m-%d %H:%M:%S') END AS tx_datetime,
               CASE WHEN f = 6 THEN NULL ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
               CAST(terminal_id AS VARCHAR) AS terminal_id,
               CASE WHEN f = 2 THEN '-5.0' ELSE CAST(amount AS VARCHAR) END AS tx_amount,
               CASE WHEN f = 7 THEN '-1' ELSE CAST(tx_time_seconds AS VARCHAR) END AS tx_time_seconds,
               CAST(tx_time_days AS VARCHAR) AS tx_time_days,
               CASE WHEN f = 4 THEN '2' WHEN f = 5 THEN '1' ELSE CAST(tx_fraud AS VARCHAR) END
                 AS tx_fraud,
               CASE WHEN f = 5 THEN '0' ELSE CAST(tx_fraud_scenario AS VARCHAR) END
                 AS tx_fraud_scenario
        FROM (SELECT *, transaction_id % 101 AS f, tx_amount AS amount FROM tx
              UNION ALL
              SELECT *, transaction_id % 101 AS f, round(tx_amount + 1, 2) AS amount FROM tx
              WHERE transaction_id % 103 = 0)""",
    "profiled": """
        SELECT TRY_CAST(transaction_id AS BIGINT) AS transaction_id, tx_datetime,
               TRY_CAST(customer_id AS BIGINT) AS customer_id,
               TRY_CAST(terminal_id AS BIGINT) AS terminal_id,
               TRY_CAST(tx_amount AS DOUBLE) AS tx_amount,
               TRY_CAST(tx_time_seconds AS BIGINT) AS tx_time_seconds,
               TRY_CAST(tx_time_days AS BIGINT) AS tx_time_days,
               TRY_CAST(tx_fraud AS INTEGER) AS tx_fraud,
               TRY_CAST(tx_fraud_scenario AS INTEGER) AS tx_fraud_scenario
        FROM raw_fields""",
    "typed": """
        SELECT * REPLACE (try_strptime(tx_datetime, '%Y-%m-%d %H:%M:%S') AS tx_datetime)
        FROM profiled""",
    "staged": """
        SELECT *, CASE
          WHEN transaction_id IS NULL OR tx_datetime IS NULL OR customer_id IS NULL
            OR terminal_id IS NULL OR tx_amount IS NULL OR tx_time_seconds IS NULL
            OR tx_time_days IS NULL OR tx_fraud IS NULL OR tx_fraud_scenario IS NULL THEN 'type'
          WHEN NOT (tx_amount > 0 AND tx_time_seconds >= 0 AND tx_time_days >= 0
            AND transaction_id >= 0 AND customer_id >= 0 AND terminal_id >= 0
            AND tx_fraud IN (0, 1) AND tx_fraud_scenario >= 0) THEN 'range'
          WHEN NOT (tx_fraud = 0 OR tx_fraud_scenario >= 1) THEN 'scenario'
          ELSE 'kept' END AS outcome
        FROM typed""",
    "cleaned": """
        SELECT * EXCLUDE (outcome, place) FROM (
          SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY tx_datetime,
            customer_id, terminal_id, tx_amount, tx_time_seconds, tx_time_days, tx_fraud,
            tx_fraud_scenario) AS place
          FROM staged WHERE outcome = 'kept') WHERE place = 1""",
    "stats_day": """
        SELECT user_id AS driver_id, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS event_timestamp,
               CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE) / count(*) AS conv_rate,
               CAST(count(*) FILTER (event_type <> 'error') AS DOUBLE) / count(*) AS acc_rate,
               count(*) AS avg_daily_trips
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "driver_stats": """
        SELECT driver_id, event_timestamp, event_timestamp AS created, conv_rate, acc_rate,
               avg_daily_trips FROM stats_day
        UNION ALL
        SELECT driver_id, event_timestamp, event_timestamp + INTERVAL 1 HOUR, conv_rate + 0.1,
               acc_rate, avg_daily_trips FROM stats_day WHERE driver_id % 7 = 0""",
    "stats": """
        SELECT * FROM driver_stats
        QUALIFY row_number() OVER (PARTITION BY driver_id, event_timestamp
                                   ORDER BY created DESC) = 1""",
    "latest": """
        SELECT * FROM driver_stats
        QUALIFY row_number() OVER (PARTITION BY driver_id
                                   ORDER BY event_timestamp DESC, created DESC) = 1""",
    "entities": """
        SELECT event_id, user_id AS driver_id, ts AS event_timestamp, value AS label,
               CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS val_to_add,
               10 * CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS val_to_add_2
        FROM events WHERE event_type = 'purchase'""",
    "requests": """
        SELECT event_id, CASE WHEN event_id % 50 = 0 THEN -driver_id ELSE driver_id END
                 AS driver_id, val_to_add, val_to_add_2 FROM entities""",
    "known": """
        SELECT e.*, s.event_timestamp AS seen_at, s.conv_rate, s.acc_rate, s.avg_daily_trips
        FROM entities e ASOF LEFT JOIN stats s
          ON e.driver_id = s.driver_id AND e.event_timestamp >= s.event_timestamp""",
    "fresh": """
        SELECT * EXCLUDE (seen_at, conv_rate, acc_rate, avg_daily_trips),
          CASE WHEN event_timestamp <= seen_at + INTERVAL 1 DAY THEN conv_rate END AS conv_rate,
          CASE WHEN event_timestamp <= seen_at + INTERVAL 1 DAY THEN acc_rate END AS acc_rate,
          CASE WHEN event_timestamp <= seen_at + INTERVAL 1 DAY THEN avg_daily_trips END
            AS avg_daily_trips
        FROM known""",
    "served": """
        SELECT r.*, l.conv_rate, l.acc_rate, l.avg_daily_trips
        FROM requests r LEFT JOIN latest l ON r.driver_id = l.driver_id""",
    "scored": """
        SELECT *, CASE WHEN score_a > 150 THEN 1 ELSE 0 END AS pred_a,
                  CASE WHEN score_b > 150 THEN 1 ELSE 0 END AS pred_b
        FROM (SELECT *, tx_amount AS score_a,
                     tx_amount + CASE WHEN terminal_id % 20 = 0 THEN 40.0 ELSE 0.0 END AS score_b
              FROM tx)""",
    "cells": """
        SELECT CAST(count(*) FILTER (tx_fraud = 1 AND pred_b = 1) AS DOUBLE) AS tp,
               CAST(count(*) FILTER (tx_fraud = 0 AND pred_b = 1) AS DOUBLE) AS fp,
               CAST(count(*) FILTER (tx_fraud = 1 AND pred_b = 0) AS DOUBLE) AS fn,
               CAST(count(*) FILTER (tx_fraud = 0 AND pred_b = 0) AS DOUBLE) AS tn
        FROM scored""",
    "sides": """
        SELECT 'a' AS model, score_a AS score, pred_a AS called, tx_fraud, tx_time_seconds FROM scored
        UNION ALL
        SELECT 'b', score_b, pred_b, tx_fraud, tx_time_seconds FROM scored""",
    "side_auc": """
        SELECT model, CAST(sum(p * (below + n / 2.0)) AS DOUBLE) / (sum(p) * sum(n)) AS auc
        FROM (SELECT *, coalesce(sum(n) OVER (PARTITION BY model ORDER BY score
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
              FROM (SELECT model, score, count(*) FILTER (tx_fraud = 1) AS p,
                           count(*) FILTER (tx_fraud = 0) AS n
                    FROM sides GROUP BY model, score))
        GROUP BY model""",
    "side_cells": """
        SELECT model, count(*) AS total,
               CAST(count(*) FILTER (tx_fraud = 1 AND called = 1) AS DOUBLE) AS tp,
               CAST(count(*) FILTER (tx_fraud = 0 AND called = 1) AS DOUBLE) AS fp,
               CAST(count(*) FILTER (tx_fraud = 1 AND called = 0) AS DOUBLE) AS fn,
               CAST(count(*) FILTER (tx_fraud = 0 AND called = 0) AS DOUBLE) AS tn
        FROM sides GROUP BY model""",
    "comparison": """
        SELECT max(auc) FILTER (model = 'a') AS champion_auc,
               max(f1) FILTER (model = 'a') AS champion_f1,
               max(acc) FILTER (model = 'a') AS champion_accuracy,
               max(auc) FILTER (model = 'b') AS challenger_auc,
               max(f1) FILTER (model = 'b') AS challenger_f1,
               max(acc) FILTER (model = 'b') AS challenger_accuracy,
               max(total) AS test_set_size
        FROM (SELECT model, auc, total, (tp + tn) / total AS acc,
                     (2 * tp / (2 * tp + fp + fn) * (tp + fn)
                      + 2 * tn / (2 * tn + fp + fn) * (fp + tn)) / total AS f1
              FROM side_cells JOIN side_auc USING (model))""",
    "samples": """
        SELECT max(f1) FILTER (model = 'a') AS f1_a, max(f1) FILTER (model = 'b') AS f1_b
        FROM (SELECT hour, model,
                     CASE WHEN 2 * tp + wrong > 0 THEN 2.0 * tp / (2 * tp + wrong) ELSE 0.0 END AS f1
              FROM (SELECT tx_time_seconds // 3600 AS hour, model,
                           count(*) FILTER (tx_fraud = 1 AND called = 1) AS tp,
                           count(*) FILTER (tx_fraud <> called) AS wrong
                    FROM sides GROUP BY ALL)) GROUP BY hour""",
    "welch": """
        SELECT *, (mb - ma) / sqrt(va / n + vb / n) AS t,
               (va / n + vb / n) ** 2 / ((va / n) ** 2 / (n - 1) + (vb / n) ** 2 / (n - 1)) AS df
        FROM (SELECT count(*) AS n, avg(f1_a) AS ma, avg(f1_b) AS mb, stddev_pop(f1_a) AS sa,
                     stddev_pop(f1_b) AS sb, var_samp(f1_a) AS va, var_samp(f1_b) AS vb,
                     quantile_cont(f1_b - f1_a, 0.025) AS low,
                     quantile_cont(f1_b - f1_a, 0.975) AS high FROM samples)""",
    "tested": """
        SELECT w.*, tail / body AS p FROM welch w, (
          SELECT sum(weight * greatest(cos(start + (top - start) * i / 2000), 0) ** (df - 1))
                   * (top - start) AS tail,
                 sum(weight * greatest(cos(top * i / 2000), 0) ** (df - 1)) * top AS body
          FROM (SELECT *, least(atan(abs(t) / sqrt(df)), top) AS start
                FROM (SELECT *, least(pi() / 2, 12 / sqrt(df)) AS top FROM welch)),
               (SELECT CAST(range AS DOUBLE) AS i,
                       CASE WHEN range IN (0, 2000) THEN 1 WHEN range % 2 = 1 THEN 4 ELSE 2 END
                         AS weight FROM range(2001))
          GROUP BY top, start)""",
    "model_versions": """
        SELECT model_name, version, model_name || '-' || version AS run_id, auc FROM (
          SELECT model_name, version,
                 CASE WHEN sum(p) > 0 AND sum(n) > 0
                      THEN CAST(sum(p * (below + n / 2.0)) AS DOUBLE) / (sum(p) * sum(n)) END AS auc
          FROM (SELECT *, coalesce(sum(n) OVER (PARTITION BY model_name, version ORDER BY score_b
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
                FROM (SELECT event_type AS model_name, CAST(tx_time_days + 1 AS INTEGER) AS version,
                             score_b, count(*) FILTER (tx_fraud = 1) AS p,
                             count(*) FILTER (tx_fraud = 0) AS n
                      FROM scored GROUP BY ALL))
          GROUP BY model_name, version) WHERE auc IS NOT NULL""",
    "history": """
        SELECT *, max(CASE WHEN alias = 'champion' THEN version END)
                    OVER (PARTITION BY model_name ORDER BY version) AS serving_version
        FROM (SELECT model_name, version, run_id, auc,
                     CASE WHEN best IS NULL OR auc > best THEN 'champion' ELSE 'challenger' END
                       AS alias,
                     CASE WHEN auc > best THEN (auc - best) / best * 100 END AS improvement_percent
              FROM (SELECT *, max(auc) OVER (PARTITION BY model_name ORDER BY version
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
                    FROM model_versions))""",
    "aliased": """
        SELECT model_name, version, run_id, auc,
               CASE WHEN version = serving THEN 'champion' WHEN version = newest THEN 'challenger'
               END AS alias
        FROM (SELECT *, max(CASE WHEN alias = 'champion' THEN version END)
                          OVER (PARTITION BY model_name) AS serving,
                        max(CASE WHEN alias = 'challenger' THEN version END)
                          OVER (PARTITION BY model_name) AS newest FROM history)""",
    "day_cells": """
        SELECT CAST(tx_datetime AS DATE) AS day, count(*) AS total,
               CAST(count(*) FILTER (tx_fraud = 1 AND pred_b = 1) AS DOUBLE) AS tp,
               CAST(count(*) FILTER (tx_fraud = 0 AND pred_b = 1) AS DOUBLE) AS fp,
               CAST(count(*) FILTER (tx_fraud = 1 AND pred_b = 0) AS DOUBLE) AS fn,
               CAST(count(*) FILTER (tx_fraud = 0 AND pred_b = 0) AS DOUBLE) AS tn,
               sum(CASE WHEN tx_fraud = 1 AND pred_b = 0 THEN tx_amount ELSE 0 END) AS missed_loss
        FROM scored GROUP BY ALL""",
    "arrivals": """
        SELECT *, xor(tx_time_days // 8, 1) AS run, CAST(tx_datetime AS DATE) AS day,
               CAST(CAST(tx_datetime AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS day_end FROM scored""",
    "marks": """
        SELECT run, max(max(tx_datetime)) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                    - INTERVAL 2 DAY AS mark FROM arrivals GROUP BY run""",
    "arrival_cells": """
        SELECT CASE WHEN coalesce(day_end <= mark, false) THEN 'late' ELSE 'closed' END AS kind, day, day_end,
               CAST(count(*) FILTER (tx_fraud = 1 AND pred_b = 1) AS DOUBLE) AS tp,
               CAST(count(*) FILTER (tx_fraud = 0 AND pred_b = 1) AS DOUBLE) AS fp,
               CAST(count(*) FILTER (tx_fraud = 1 AND pred_b = 0) AS DOUBLE) AS fn,
               CAST(count(*) FILTER (tx_fraud = 0 AND pred_b = 0) AS DOUBLE) AS tn,
               sum(CASE WHEN tx_fraud = 1 AND pred_b = 0 THEN tx_amount ELSE 0 END) AS missed_loss
        FROM arrivals JOIN marks USING (run) GROUP BY ALL""",
    "closed_cells": """
        SELECT *, tp + fp + fn + tn AS total FROM arrival_cells WHERE kind = 'closed'
          AND day_end <= (SELECT max(tx_datetime) - INTERVAL 2 DAY FROM arrivals)""",
    "thresholds": """
        SELECT score_b AS threshold, tp / (tp + fp) AS precision, tp / p AS recall, fp / n AS fpr
        FROM (SELECT score_b,
                     CAST(sum(pos) OVER (ORDER BY score_b DESC) AS DOUBLE) AS tp,
                     CAST(sum(neg) OVER (ORDER BY score_b DESC) AS DOUBLE) AS fp,
                     CAST(sum(pos) OVER () AS DOUBLE) AS p, CAST(sum(neg) OVER () AS DOUBLE) AS n
              FROM (SELECT score_b, count(*) FILTER (tx_fraud = 1) AS pos,
                           count(*) FILTER (tx_fraud = 0) AS neg FROM scored GROUP BY score_b))""",
    "buckets": """
        SELECT transaction_id,
               CAST(concat('0x', substr(md5(CAST(transaction_id AS VARCHAR)), 1, 8)) AS BIGINT)
                 AS bucket FROM tx""",
}

_TX = "transaction_id, tx_datetime, customer_id, terminal_id, tx_amount, tx_time_seconds, tx_time_days"
_FEATURES = "round(conv_rate, 9) AS conv_rate, round(acc_rate, 9) AS acc_rate, avg_daily_trips"
_PLUS = ("round(conv_rate + val_to_add, 9) AS conv_rate_plus_val1, "
         "round(conv_rate + val_to_add_2, 9) AS conv_rate_plus_val2")
_RATING = "(conv_rate * 0.6 + acc_rate * 0.4)"
_PERFORMANCE = (f"round({_RATING}, 9) AS combined_rating, "
                f"round({_RATING} * ln(1 + avg_daily_trips), 9) AS performance_score")
_ACT = "ln(1 + coalesce(avg_daily_trips, 0))"
_REL = "((coalesce(acc_rate, 0) + coalesce(conv_rate, 0)) / 2)"
_RISK = (f"round({_ACT} * {_REL} * (0.5 + 0.5 * {_REL}), 9) AS risk_adjusted_score, "
         f"round(2 / (1 / ({_ACT} + 1e-6) + 1 / ({_REL} + 1e-6)), 9) AS engagement_level")
_ENTITY = "event_id, driver_id, event_timestamp, round(label, 9) AS label, val_to_add, val_to_add_2"
_REQUEST = "event_id, driver_id, val_to_add, val_to_add_2"
_MESSAGE = """CASE WHEN transaction_id % 97 <> 0 THEN transaction_id END AS transaction_id,
    CASE WHEN transaction_id % 97 <> 0 THEN strftime(tx_datetime, '%Y-%m-%d %H:%M:%S') END
      AS timestamp,
    CASE WHEN transaction_id % 97 <> 0 THEN tx_amount END AS tx_amount,
    CASE WHEN transaction_id % 97 <> 0 THEN terminal_id END AS terminal_id,
    CASE WHEN transaction_id % 97 <> 0 THEN tx_time_seconds END AS tx_time_seconds,
    CASE WHEN transaction_id % 97 <> 0 THEN tx_time_days END AS tx_time_days,
    CASE WHEN transaction_id % 97 = 0 THEN 'malformed' END AS problem"""
_NULLS = ["transaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount",
          "tx_time_seconds", "tx_time_days", "tx_fraud", "tx_fraud_scenario"]
_RULES = {
    "id_negative": "transaction_id < 0",
    "amount_not_positive": "tx_amount <= 0",
    "seconds_negative": "tx_time_seconds < 0",
    "days_negative": "tx_time_days < 0",
    "label_unknown": "tx_fraud NOT IN (0, 1)",
    "scenario_negative": "tx_fraud_scenario < 0",
}
_BAD_DATE = "try_strptime(tx_datetime, '%Y-%m-%d %H:%M:%S') IS NULL"
_REASONS = """concat_ws(';', CASE WHEN transaction_id IS NULL THEN 'id_missing' END,
    CASE WHEN tx_amount <= 0 THEN 'amount_not_positive' END,
    CASE WHEN tx_fraud NOT IN (0, 1) THEN 'label_unknown' END) AS reasons"""
_BAD = "transaction_id IS NULL OR tx_amount <= 0 OR tx_fraud NOT IN (0, 1)"
_FUNNEL = """
    SELECT count(*) + 1 AS lines_read, CAST(1 AS BIGINT) AS dropped_comment,
           CAST(0 AS BIGINT) AS dropped_field_count,
           count(*) FILTER (outcome = 'type') AS dropped_type,
           count(*) FILTER (outcome = 'range') AS dropped_range,
           count(*) FILTER (outcome = 'scenario') AS dropped_scenario,
           count(*) FILTER (outcome = 'kept')
             - count(DISTINCT transaction_id) FILTER (outcome = 'kept') AS dropped_duplicate,
           count(DISTINCT transaction_id) FILTER (outcome = 'kept') AS rows_kept
    FROM staged"""
_STAGES = ["lines_read", "dropped_comment", "dropped_field_count", "dropped_type", "dropped_range",
           "dropped_scenario", "dropped_duplicate", "rows_kept"]
_WHOLE = f"SELECT {_TX}, tx_fraud, tx_fraud_scenario FROM "
_SCALED = ["terminal_id", "tx_amount", "tx_time_seconds", "tx_time_days"]
_MULTI = """
    SELECT {entity},
      round(CASE WHEN event_timestamp <= seen_at + INTERVAL 12 HOUR THEN conv_rate END, 9) AS conv_rate,
      round(CASE WHEN event_timestamp <= seen_at + INTERVAL 12 HOUR THEN acc_rate END, 9) AS acc_rate,
      CASE WHEN event_timestamp <= seen_at + INTERVAL 3 DAY THEN avg_daily_trips END AS avg_daily_trips,
      risk_adjusted_score, engagement_level
    FROM known JOIN (SELECT event_id, {risk} FROM fresh) USING (event_id)"""


def _per_name(pairs: dict[str, str], name: str, value: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS \"{name}\", count(*) FILTER ({test}) AS {value} FROM {source}"
        for label, test in pairs.items()
    )


BODIES = {
    "scan_raw_csv": "SELECT * FROM raw_fields UNION ALL SELECT '#transaction_id', "
                    + ", ".join(f"'{c}'" for c in _NULLS[1:]),
    "scan_text_lines": "SELECT * FROM profiled",
    "scan_header_csv": f"SELECT {_TX}, CAST(tx_fraud AS BIGINT) AS fraud FROM tx",
    "scan_feature_source": "SELECT * FROM driver_stats",
    "entity_rows_literal": """
        SELECT CAST(e.driver_id AS BIGINT) AS driver_id, e.event_timestamp, e.satisfaction,
               CASE WHEN e.event_timestamp <= s.event_timestamp + INTERVAL 1 DAY
                    THEN s.conv_rate END AS conv_rate,
               CASE WHEN e.event_timestamp <= s.event_timestamp + INTERVAL 1 DAY
                    THEN s.acc_rate END AS acc_rate,
               CASE WHEN e.event_timestamp <= s.event_timestamp + INTERVAL 1 DAY
                    THEN s.avg_daily_trips END AS avg_daily_trips
        FROM (VALUES (1, TIMESTAMP '2024-01-05 10:59:42', 1), (2, TIMESTAMP '2024-01-12 08:12:10', 5),
                     (7, TIMESTAMP '2024-01-20 16:40:26', 3), (-1, TIMESTAMP '2024-01-20 16:40:26', 4))
             AS e(driver_id, event_timestamp, satisfaction)
        ASOF LEFT JOIN stats s
          ON e.driver_id = s.driver_id AND e.event_timestamp >= s.event_timestamp""",
    "stream_json_source": """
        SELECT transaction_id, strftime(tx_datetime, '%Y-%m-%d %H:%M:%S') AS timestamp, tx_amount,
               terminal_id, tx_time_seconds, tx_time_days FROM tx""",
    "replay_as_json": f"SELECT {_TX}, CAST(NULL AS INTEGER) AS fraud FROM tx",
    "sink_parquet_roundtrip": _WHOLE + "cleaned",
    "sink_rejects_csv": f"SELECT *, {_REASONS} FROM profiled WHERE {_BAD}",
    "sink_report_json": """
        SELECT round(champion_auc, 9) AS champion_auc, round(champion_f1, 9) AS champion_f1,
               round(champion_accuracy, 9) AS champion_accuracy,
               round(challenger_auc, 9) AS challenger_auc, round(challenger_f1, 9) AS challenger_f1,
               round(challenger_accuracy, 9) AS challenger_accuracy,
               round(mb - ma, 9) AS f1_improvement, p < 0.05 AND mb > ma AS is_significant,
               CASE WHEN p < 0.05 AND mb > ma THEN 'PROMOTE' ELSE 'KEEP_CHAMPION' END AS decision,
               test_set_size, 'rule@champion' AS champion_model,
               'rule@challenger' AS challenger_model
        FROM comparison, tested""",
    "sink_log_text": " UNION ALL ".join(
        f"SELECT '{s}: ' || {s} AS message FROM ({_FUNNEL})" for s in _STAGES
    ),
    "model_save_load": """
        SELECT count(*) AS rows, count(*) AS agreeing FROM buckets WHERE bucket % 100 >= 80""",
    "model_load_by_alias": """
        SELECT 1 AS champion_version, 2 AS challenger_version, count(*) AS rows_scored
        FROM buckets WHERE bucket % 100 >= 80""",
    "log_served_features": f"""
        SELECT {_REQUEST}, round(conv_rate, 9) AS conv_rate, {_PLUS}, true AS is_stamped
        FROM served""",
    "typed_projection": _WHOLE + "typed",
    "filter_malformed": """
        SELECT count(*) + 1 AS lines, CAST(1 AS BIGINT) AS comment_lines,
               CAST(0 AS BIGINT) AS wrong_field_count FROM raw_fields""",
    "filter_not_null": _WHOLE + "staged WHERE outcome <> 'type'",
    "filter_business_rules": _WHOLE + """typed WHERE tx_amount > 0 AND tx_time_seconds >= 0
        AND tx_time_days >= 0 AND transaction_id >= 0 AND customer_id >= 0 AND terminal_id >= 0
        AND tx_fraud IN (0, 1) AND tx_fraud_scenario >= 0""",
    "filter_fraud_scenario": _WHOLE + "typed WHERE tx_fraud = 0 OR tx_fraud_scenario >= 1",
    "quarantine_rows": f"SELECT *, {_REASONS} FROM profiled WHERE {_BAD}",
    "select_features": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls "
        "FROM tx JOIN buckets USING (transaction_id) WHERE bucket % 100 < 80" for c in _SCALED
    ),
    "feature_refs_projection": f"SELECT {_ENTITY}, {_FEATURES}, {_PLUS} FROM fresh",
    "feature_set_v1": f"SELECT {_ENTITY}, round(conv_rate, 9) AS conv_rate, {_PLUS} FROM fresh",
    "feature_set_v2": f"SELECT {_ENTITY}, {_FEATURES}, {_PLUS} FROM fresh",
    "feature_set_v3": f"SELECT {_ENTITY}, {_FEATURES}, {_PLUS} FROM fresh",
    "feature_set_v4": f"SELECT {_ENTITY}, {_FEATURES}, {_PERFORMANCE} FROM fresh",
    "feature_set_realtime": f"SELECT {_ENTITY}, {_FEATURES}, {_RISK} FROM fresh",
    "prediction_envelope": """
        SELECT CASE WHEN transaction_id % 10 <> 0 THEN CAST(transaction_id AS VARCHAR)
                    ELSE 'unknown_' || transaction_id END AS transaction_id,
               strftime(tx_datetime, '%Y-%m-%d %H:%M:%S') AS original_timestamp,
               pred_a AS prediction, round(score_a / 1000, 9) AS probability,
               'champion' AS model_alias, tx_amount, terminal_id, tx_time_seconds, tx_time_days
        FROM scored""",
    "prediction_decode": """
        SELECT transaction_id, CASE WHEN transaction_id % 5 = 0 THEN -1 ELSE pred_a END AS prediction,
               CASE WHEN transaction_id % 3 < 2 THEN round(score_a / 1000, 9) END AS probability
        FROM scored""",
    "dedup_transactions": _WHOLE + "cleaned",
    "preview_rows": _WHOLE + "tx ORDER BY tx_datetime, transaction_id LIMIT 5",
    "pit_join": f"SELECT {_ENTITY}, {_FEATURES} FROM fresh",
    "pit_join_two_sources": f"""
        SELECT {_ENTITY}, {_FEATURES}, (
          SELECT round(max_by(value, (ts, value)), 9) FROM events x
          WHERE x.event_type = 'error' AND x.user_id = driver_id AND x.ts <= event_timestamp
            AND x.ts >= event_timestamp - INTERVAL 6 HOUR) AS error_value
        FROM fresh""",
    "pit_join_multi_view": _MULTI.format(entity=_ENTITY, risk=_RISK),
    "pit_join_as_of_now": f"""
        SELECT e.event_id, e.driver_id, TIMESTAMP '2024-01-20 12:00:00' AS event_timestamp,
               round(label, 9) AS label, val_to_add, val_to_add_2,
               round(conv_rate, 9) AS conv_rate, round(acc_rate, 9) AS acc_rate, avg_daily_trips
        FROM entities e LEFT JOIN (
          SELECT * FROM stats WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-19 12:00:00'
                                                        AND TIMESTAMP '2024-01-20 12:00:00'
          QUALIFY row_number() OVER (PARTITION BY driver_id ORDER BY event_timestamp DESC) = 1) s
        ON e.driver_id = s.driver_id""",
    "latest_features_lookup": f"SELECT {_REQUEST}, {_FEATURES} FROM served",
    "latest_with_request": f"SELECT {_REQUEST}, round(acc_rate, 9) AS acc_rate, {_PLUS} FROM served",
    "dq_null_counts": _per_name({c: f"{c} IS NULL" for c in _NULLS}, "column", "nulls", "profiled"),
    "dq_rule_violations": _per_name(_RULES, "rule", "violations", "profiled"),
    "dq_invalid_dates": f"SELECT count(*) FILTER ({_BAD_DATE}) AS invalid_dates FROM profiled",
    "dq_fraud_without_scenario": """
        SELECT count(*) FILTER (tx_fraud = 1 AND tx_fraud_scenario = 0) AS fraud_without_scenario
        FROM profiled""",
    "dq_duplicate_ids": """
        SELECT count(*) AS duplicate_ids FROM (
          SELECT transaction_id FROM profiled WHERE transaction_id IS NOT NULL
          GROUP BY transaction_id HAVING count(*) > 1)""",
    "dq_summary": """
        SELECT count(*) AS transactions, CAST(sum(tx_fraud) AS BIGINT) AS fraud,
               count(DISTINCT customer_id) AS customers, count(DISTINCT terminal_id) AS terminals,
               min(tx_amount) AS min_amount, max(tx_amount) AS max_amount FROM profiled""",
    "dq_profile": "SELECT count(*) AS transactions, "
                  + ", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in _NULLS) + ", "
                  + ", ".join(f"count(*) FILTER ({t}) AS rule_{n}" for n, t in _RULES.items())
                  + f""", count(*) FILTER ({_BAD_DATE}) AS invalid_dates,
               count(*) FILTER (tx_fraud = 1 AND tx_fraud_scenario = 0) AS fraud_without_scenario,
               CAST(sum(tx_fraud) AS BIGINT) AS fraud, min(tx_amount) AS min_amount,
               max(tx_amount) AS max_amount, count(DISTINCT customer_id) AS customers,
               count(DISTINCT terminal_id) AS terminals FROM profiled""",
    "clean_funnel": _FUNNEL,
    "clean_job": _FUNNEL,
    "clean_observed": _FUNNEL,
    "train_forest": """
        SELECT count(*) AS rows, CAST(sum(tx_fraud) AS BIGINT) AS fraud, true AS ranks_well, true AS calls_well
        FROM tx JOIN buckets USING (transaction_id) WHERE bucket % 100 >= 80""",
    "cross_validate": """
        SELECT num_trees, max_depth, true AS ranks_well, true AS best_is_refitted
        FROM (VALUES (CAST(10 AS DOUBLE)), (20)) a(num_trees), (VALUES (CAST(5 AS DOUBLE)), (10)) b(max_depth)""",
    "best_params": "SELECT true AS is_in_grid, true AS is_arg_max",
    "batch_score": """
        SELECT transaction_id, true AS is_sound, true AS call_follows_probability, true AS is_same_when_loaded
        FROM buckets WHERE bucket % 100 >= 80""",
    "stream_against_batch": """
        SELECT count(*) AS compared, 0 AS differences FROM tx WHERE transaction_id % 97 <> 0""",
    "split_sizes": """
        SELECT CASE WHEN bucket % 100 >= 80 THEN 'test' ELSE 'train' END AS split,
               count(*) AS rows FROM buckets GROUP BY 1""",
    "odf_conv_rate_plus": f"SELECT event_id, {_PLUS} FROM fresh",
    "odf_performance": f"SELECT event_id, {_PERFORMANCE} FROM fresh",
    "odf_risk_adjusted": f"SELECT event_id, {_RISK} FROM fresh",
    "coerce_numeric": """
        SELECT transaction_id AS raw_id, tx_amount,
               coalesce(TRY_CAST(transaction_id AS DOUBLE), 0) AS id_number,
               coalesce(TRY_CAST(customer_id AS DOUBLE), 0) AS customer_number FROM raw_fields""",
    "parse_timestamps": """
        SELECT transaction_id AS raw_id, tx_datetime,
               try_strptime(tx_datetime, '%Y-%m-%d %H:%M:%S') AS parsed FROM raw_fields""",
    "json_roundtrip": f"SELECT {_MESSAGE} FROM tx",
    "split_train_test": """
        SELECT transaction_id, bucket,
               CASE WHEN bucket % 100 >= 80 THEN 'test' ELSE 'train' END AS split FROM buckets""",
    "assign_folds": "SELECT transaction_id, CAST(bucket % 3 AS INTEGER) AS fold FROM buckets",
    "assemble_features": "SELECT transaction_id, " + ", ".join(
        f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in _SCALED) + " FROM tx",
    "scale_features": "SELECT transaction_id, " + ", ".join(
        f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _SCALED) + " FROM tx, (SELECT "
        + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _SCALED)
        + " FROM tx JOIN buckets USING (transaction_id) WHERE bucket % 100 < 80)",
    "metric_auc": "SELECT model, round(auc, 12) AS auc FROM side_auc",
    "metric_accuracy": "SELECT round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy FROM cells",
    "metric_f1_weighted": """
        SELECT round((2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fp + fn)
                      * (fp + tn)) / (tp + fp + fn + tn), 9) AS f1_weighted FROM cells""",
    "metric_f1_fraud": "SELECT round(2 * tp / (2 * tp + fp + fn), 9) AS f1_fraud FROM cells",
    "metric_rates": """
        SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
               CAST(tn AS BIGINT) AS tn, round(fp / (fp + tn), 9) AS fpr,
               round(tp / (tp + fn), 9) AS recall, round(tp / (tp + fp), 9) AS precision
        FROM cells""",
    "metric_fbeta": """
        SELECT round(1.25 * p * r / (0.25 * p + r), 9) AS f_beta
        FROM (SELECT tp / (tp + fp) AS p, tp / (tp + fn) AS r FROM cells)""",
    "ab_metrics": "SELECT test_set_size, " + ", ".join(
        f"round({s}_{m}, 9) AS {s}_{m}" for s in ("champion", "challenger")
        for m in ("auc", "f1", "accuracy")) + " FROM comparison",
    "ab_joint_cells": """
        SELECT tx_fraud AS label, pred_a AS champion, pred_b AS challenger, count(*) AS n
        FROM scored GROUP BY ALL""",
    "ab_significance": """
        SELECT n AS iterations, round(ma, 6) AS champion_f1_mean, round(mb, 6) AS challenger_f1_mean,
               round(sa, 6) AS champion_f1_std, round(sb, 6) AS challenger_f1_std,
               round(mb - ma, 6) AS f1_improvement, round(t, 6) AS welch_t, round(df, 6) AS welch_df,
               round(p, 6) AS p_value,
               round((mb - ma) / sqrt((sa * sa + sb * sb) / 2), 6) AS effect_size,
               round(low, 6) AS gain_low, round(high, 6) AS gain_high,
               p < 0.05 AND mb > ma AS is_significant FROM tested""",
    "ab_decision": """
        SELECT p < 0.05 AND mb > ma AS is_significant,
               CASE WHEN p < 0.05 AND mb > ma THEN 'PROMOTE' ELSE 'KEEP_CHAMPION' END AS decision
        FROM tested""",
    "champion_lookup": """
        SELECT run_id, model_name, version, round(auc, 9) AS auc FROM aliased
        WHERE alias = 'champion'""",
    "champion_history": """
        SELECT model_name, version, round(auc, 9) AS auc, alias,
               round(improvement_percent, 9) AS improvement_percent, serving_version FROM history""",
    "promote_alias": """
        SELECT model_name, version, round(auc, 9) AS auc, CASE
          WHEN model_name NOT IN ('error', 'purchase') OR NOT has THEN alias
          WHEN alias = 'challenger' THEN 'champion' END AS alias
        FROM (SELECT *, max(CASE WHEN alias = 'challenger' THEN 1 ELSE 0 END)
                          OVER (PARTITION BY model_name) = 1 AS has FROM aliased)""",
    "stream_score": """
        SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, 'champion' AS model_alias,
               true AS is_sound FROM tx WHERE transaction_id % 97 <> 0""",
    "run_record": """
        SELECT CAST(num_trees AS DOUBLE) AS num_trees, CAST(max_depth AS DOUBLE) AS max_depth, true AS is_plausible,
               CAST(1 AS BIGINT) AS best_points, (SELECT count(*) FROM tx) AS rows
        FROM (VALUES (10, 5), (10, 10), (20, 5), (20, 10)) AS grid(num_trees, max_depth)""",
    "stream_scored_topic": """
        SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, 'champion' AS model_alias,
               true AS is_sound FROM tx WHERE transaction_id % 97 <> 0""",
    "stream_new_checkpoint": """
        SELECT user_id AS driver_id, 2 * count(*) AS history_rows FROM events GROUP BY 1""",
    "stream_exactly_once": """
        SELECT CASE WHEN transaction_id % 97 = 0 THEN 'rejected' ELSE 'scored' END AS status,
               count(*) AS messages FROM tx GROUP BY 1""",
    "stream_dead_letter": """
        SELECT '{bad' AS value, 'malformed' AS reason FROM tx WHERE transaction_id % 97 = 0""",
    "stream_progress": """
        SELECT count(*) FILTER (transaction_id % 97 <> 0) AS processed,
               count(*) FILTER (transaction_id % 97 = 0) AS errors, true AS has_rate FROM tx""",
    "stream_sink_json": f"SELECT {_MESSAGE} FROM tx",
    "stream_observed_progress": "SELECT count(*) AS messages, true AS has_size FROM tx",
    "stream_unique_predictions": """
        SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, 1 AS received FROM tx WHERE transaction_id % 97 <> 0""",
    "stream_latest_state": """
        SELECT driver_id, event_timestamp, created, round(conv_rate, 9) AS conv_rate,
               round(acc_rate, 9) AS acc_rate, avg_daily_trips
        FROM (SELECT * FROM driver_stats UNION ALL SELECT user_id, ts, ts, value / 1000, 1.0, event_id FROM events)
        QUALIFY row_number() OVER (PARTITION BY driver_id ORDER BY event_timestamp DESC, created DESC, conv_rate DESC,
                                   acc_rate DESC, avg_daily_trips DESC) = 1""",
    "push_features": """
        SELECT driver_id, event_timestamp, created, round(conv_rate, 9) AS conv_rate,
               round(acc_rate, 9) AS acc_rate, avg_daily_trips, history_rows
        FROM (SELECT *, count(*) OVER (PARTITION BY driver_id) AS history_rows,
                     row_number() OVER (PARTITION BY driver_id ORDER BY event_timestamp DESC,
                       created DESC, conv_rate DESC, acc_rate DESC, avg_daily_trips DESC) AS place
              FROM (SELECT * FROM driver_stats UNION ALL
                    SELECT user_id, ts, ts, value / 1000, 1.0, event_id FROM events))
        WHERE place = 1""",
    "materialize_incremental": """
        SELECT driver_id, event_timestamp, created, round(conv_rate, 9) AS conv_rate,
               round(acc_rate, 9) AS acc_rate, avg_daily_trips FROM driver_stats
        WHERE event_timestamp <= TIMESTAMP '2024-01-20 12:00:00'
        QUALIFY row_number() OVER (PARTITION BY driver_id
                                   ORDER BY event_timestamp DESC, created DESC) = 1""",
    "materialize_remembered": """
        SELECT driver_id, event_timestamp, created, round(conv_rate, 9) AS conv_rate,
               round(acc_rate, 9) AS acc_rate, avg_daily_trips FROM driver_stats
        WHERE event_timestamp <= TIMESTAMP '2024-01-20 12:00:00'
        QUALIFY row_number() OVER (PARTITION BY driver_id
                                   ORDER BY event_timestamp DESC, created DESC) = 1""",
    "stream_daily_quality": """
        SELECT day, total AS transactions, round(fp / (fp + tn), 9) AS fpr,
               CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 9) ELSE 0 END AS recall
        FROM day_cells""",
    "stream_closed_days": """
        SELECT kind, day, CAST(tp + fp + fn + tn AS BIGINT) AS transactions,
               CASE WHEN fp + tn > 0 THEN round(fp / (fp + tn), 6) ELSE 0 END AS fpr,
               CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) ELSE 0 END AS recall,
               round(missed_loss, 6) AS missed_loss
        FROM closed_cells
        UNION ALL
        SELECT kind, day, CAST(tp + fp + fn + tn AS BIGINT), NULL, NULL, NULL FROM arrival_cells WHERE kind = 'late'""",
    "select_threshold": """
        SELECT round(threshold, 9) AS threshold, round(precision, 9) AS precision,
               round(recall, 9) AS recall, round(fpr, 9) AS fpr, round(f_beta, 9) AS f_beta
        FROM (SELECT *, CASE WHEN 0.25 * precision + recall > 0
                 THEN 1.25 * precision * recall / (0.25 * precision + recall) ELSE 0 END AS f_beta
              FROM thresholds WHERE fpr <= 0.05)
        ORDER BY f_beta DESC, threshold DESC LIMIT 1""",
    "monthly_missed_loss": """
        SELECT strftime(day, '%Y-%m') AS month, round(sum(missed_loss), 2) AS missed_loss,
               sum(missed_loss) <= 500000 AS within_limit FROM day_cells GROUP BY 1""",
    "fraud_rate": """
        SELECT count(*) AS transactions, round(100.0 * sum(tx_fraud) / count(*), 9) AS fraud_per_100,
               100.0 * sum(tx_fraud) / count(*) <= 2 AS within_limit FROM tx""",
    "quality_alerts": """
        SELECT period, metric, round(value, 6) AS value, "limit" FROM (
          SELECT strftime(day, '%Y-%m-%d') AS period, 'fpr' AS metric, fp / (fp + tn) AS value,
                 CAST(0.05 AS DOUBLE) AS "limit" FROM day_cells WHERE fp / (fp + tn) > 0.05
          UNION ALL
          SELECT strftime(day, '%Y-%m-%d'), 'recall', tp / (tp + fn), 0.85 FROM day_cells
          WHERE tp + fn > 0 AND tp / (tp + fn) < 0.85
          UNION ALL
          SELECT strftime(day, '%Y-%m-%d'), 'fraud_per_100', (tp + fn) / total * 100, 2.0
          FROM day_cells WHERE (tp + fn) / total * 100 > 2
          UNION ALL
          SELECT strftime(day, '%Y-%m'), 'missed_loss', sum(missed_loss), 500000.0
          FROM day_cells GROUP BY 1 HAVING sum(missed_loss) > 500000)""",
    "throughput_profile": """
        SELECT CAST(sum(n) AS BIGINT) AS transactions, count(*) AS busy_seconds,
               round(avg(n), 9) AS mean_per_busy_second,
               round(CAST(sum(n) AS DOUBLE) / (date_diff('second', min(s), max(s)) + 1), 9)
                 AS mean_per_second,
               max(n) AS peak_per_second,
               CAST(sum(n) AS DOUBLE) / (date_diff('second', min(s), max(s)) + 1) <= 50
                 AS usual_within_target,
               max(n) <= 400 AS peak_within_target
        FROM (SELECT tx_datetime AS s, count(*) AS n FROM tx GROUP BY 1)""",
    "latency_sketch": """
        SELECT strftime(tx_datetime, '%Y-%m') AS month, count(*) AS decisions,
               round(avg(CASE WHEN transaction_id * 37 % 260 <= 200 THEN 1.0 ELSE 0 END), 9) AS share_in_time,
               max(transaction_id * 37 % 260) AS max_ms, true AS median_ms_in_bound, true AS p95_ms_in_bound,
               true AS customers_in_bound
        FROM tx GROUP BY 1""",
    "latency_share": """
        SELECT count(*) AS decisions, round(avg(CASE WHEN ms <= 200 THEN 1.0 ELSE 0 END), 9)
                 AS share_in_time, quantile_cont(ms, 0.5) AS median_ms,
               quantile_cont(ms, 0.95) AS p95_ms, max(ms) AS max_ms,
               avg(CASE WHEN ms <= 200 THEN 1.0 ELSE 0 END) >= 0.95 AS within_target
        FROM (SELECT transaction_id * 37 % 260 AS ms FROM tx)""",
}


def _bootstrap(iterations: int = 1000, seed: int = 42) -> str:
    """Resamples of the eight joint cells, drawn one cell after the other by the same hashes."""
    cells = [(y, a, b) for y in (0, 1) for a in (0, 1) for b in (0, 1)]
    counts = ", ".join(
        f"count(*) FILTER (tx_fraud = {y} AND pred_a = {a} AND pred_b = {b}) AS c{i}" for i, (y, a, b) in enumerate(cells))
    total = " + ".join(f"c{i}" for i in range(8))
    groups = [(0,), (3,), (1, 2), (4,), (7,), (5, 6)]
    steps = [f"s0 AS (SELECT i.iteration, n.*, {total} AS rest, {total} AS mass FROM range({iterations}) i(iteration), (SELECT {counts} FROM scored) n)"]

    def draw(i: int, number: str, part: str, whole: str) -> None:
        def uniform(use: str) -> str:
            text = f"'{seed}|' || iteration || '|{i}|{use}'"
            return f"(CAST(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0"

        steps.append(f"p{i} AS (SELECT *, {number} AS m, CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / ({whole}) ELSE 0.0 END AS p, "
                     f"{uniform('u')} AS u, {uniform('v')} AS v FROM s{i})")
        steps.append(f"q{i} AS (SELECT *, least(p, 1 - p) AS r, sqrt(-2 * ln(u)) * cos(2 * pi() * v) AS z FROM p{i})")
        steps.append(
            f"e{i} AS (SELECT *, list_transform(range(150), lambda k: CASE WHEN k > m THEN 0.0 WHEN r <= 0 THEN CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END "
            "ELSE exp(lgamma(m + 1) - lgamma(k + 1) - lgamma(m - k + 1) + k * ln(r) + (m - k) * ln(1 - r)) END) AS terms "
            f"FROM q{i})")
        few = "len(list_filter(range(150), lambda k: k < m AND list_sum(terms[1:k + 1]) < u))"
        many = "least(greatest(floor(m * r + z * sqrt(m * r * (1 - r)) + (1 - 2 * r) * (z * z - 1) / 6 + 0.5), 0), m)"
        steps.append(f"f{i} AS (SELECT *, CAST(CASE WHEN m * r < 50 THEN {few} ELSE {many} END AS BIGINT) AS rare FROM e{i})")
        steps.append(f"h{i} AS (SELECT * EXCLUDE (m, p, u, v, r, z, terms, rare), CASE WHEN p > 0.5 THEN m - rare ELSE rare END AS g{i} FROM f{i})")

    for i, of in enumerate(groups[:-1]):
        part = "(" + " + ".join(f"c{c}" for c in of) + ")"
        draw(i, "rest", part, "mass")
        steps.append(f"s{i + 1} AS (SELECT * REPLACE (rest - g{i} AS rest, mass - {part} AS mass) FROM h{i})")
    steps.append("s6 AS (SELECT * EXCLUDE (rest, mass), rest AS g5 FROM s5)")
    draw(6, "g2", "c1", "c1 + c2")
    steps.append("s7 AS (SELECT * FROM h6)")
    draw(7, "g5", "c5", "c5 + c6")
    numbers = ["g0", "g6", "(g2 - g6)", "g1", "g3", "g7", "(g5 - g7)", "g4"]

    def f1(side: int) -> str:
        tp = " + ".join(n for n, c in zip(numbers, cells) if c[0] and c[side])
        wrong = " + ".join(n for n, c in zip(numbers, cells) if c[0] != c[side])
        return f"CASE WHEN {tp} + {wrong} > 0 THEN 2.0 * ({tp}) / (2 * ({tp}) + {wrong}) ELSE 0 END"

    return (f"WITH {', '.join(steps)} SELECT CAST(iteration AS INTEGER) AS iteration, round({f1(1)}, 9) AS champion_f1, "
            f"round({f1(2)}, 9) AS challenger_f1 FROM h7")


BODIES["bootstrap_f1"] = _bootstrap()
BODIES["train_logistic"] = BODIES["train_forest"].replace("AS calls_well", "AS calls_well, true AS keeps_base_rate")
BODIES["materialize_buckets"] = BODIES["materialize_remembered"]
BODIES["lookup_buckets"] = BODIES["latest_features_lookup"]
BODIES["daily_quality"] = BODIES["stream_daily_quality"]
BODIES["closed_day_alerts"] = BODIES["quality_alerts"].replace("day_cells", "closed_cells")


def oracle_sql() -> dict[str, str]:
    """Each query with the views it can use; unused ones cost nothing."""
    views = ", ".join(f"{name} AS ({body})" for name, body in VIEWS.items())
    return {name: f"WITH {views} SELECT * FROM ({body})" for name, body in BODIES.items()}
