"""The queries once more as SQL over the same tables, with constants of their own."""

from __future__ import annotations

# The component columns, and the countries further down.
COMPONENTS = [f"V{i}" for i in range(1, 29)]

_VECTOR = ", ".join(f"v.embedding[{i + 1}]::DOUBLE AS {name}" for i, name in enumerate(COMPONENTS))
_V = ", ".join(COMPONENTS)

_FEATURES = " ".join(["Time", *COMPONENTS, "Amount"])

_COUNTRIES = "['US', 'UK', 'FR', 'DE', 'ES', 'IT', 'BR', 'AU', 'CA', 'JP']"

_ARRIVALS = f"""
arrivals AS (
  SELECT event_id, ts,
         (epoch_us(ts) - 1704067200000000) / 1e6 AS "Time",
         value AS "Amount",
         printf('MERCHANT-%04d', event_id * 7 % 1000 + 1) AS merchant_id,
         (user_id % 9000 + 1000)::VARCHAR AS card_last_four,
         {_COUNTRIES}[(user_id % 10 + 1)::INTEGER] AS country,
         (event_id % 3)::INTEGER AS partition,
         event_id // 3 AS "offset",
         event_id // 500 AS batch_id,
         (event_id // 500 % 60 + 20)::DOUBLE AS processing_time_ms
  FROM events
)"""

_TXN = f"""{_ARRIVALS},
txn AS (
  SELECT a.*, printf('TXN-%08d', a.event_id) AS transaction_id,
         (v.label = 0)::INTEGER AS "Class", (v.label = 0)::INTEGER AS is_fraud_ground_truth,
         {_VECTOR}
  FROM arrivals a JOIN embeddings v ON v.vec_id = a.event_id % (SELECT count(*) FROM embeddings)
)"""

_LOGISTIC = '1 / (1 + exp(-(-2 + 8 * V1 - 6 * V2 + 4 * V3 + 0.004::DOUBLE * "Amount")))'

_DECIDED = f"""{_TXN},
decided AS (
  SELECT *, fraud_probability >= 0.5 AS is_fraud_predicted
  FROM (SELECT *, {_LOGISTIC} AS fraud_probability FROM txn)
)"""

_METRICS = f"""{_DECIDED},
metrics AS (
  SELECT batch_id, count(*) AS batch_size, count(*) FILTER (is_fraud_predicted) AS fraud_count,
         count(*) FILTER (is_fraud_predicted) / count(*)::DOUBLE AS fraud_rate,
         max(ts) AS last_ts, count(*) FILTER (is_fraud_ground_truth = 1) AS actual_count, (batch_id % 60 + 20)::DOUBLE AS processing_ms
  FROM decided GROUP BY batch_id
)"""

_SEVERITY = (
    "CASE WHEN fraud_probability >= 0.9 THEN 'CRITICAL' WHEN fraud_probability >= 0.7 THEN 'HIGH' "
    "WHEN fraud_probability >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS severity"
)

_SHOWN_SCORE = "fraud_probability::DECIMAL(18,6) AS fraud_probability"

_MESSAGE = f"""
  transaction_id, epoch_us(ts) / 1e6 AS "timestamp",
  CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp_iso,
  "Time", "Amount", {_V}, is_fraud_ground_truth, merchant_id, card_last_four, country"""

# Faults planted into the records, first match wins.
_FAULTY = f"""{_TXN},
faulty AS (
  SELECT * REPLACE (
           CASE WHEN event_id % 89 <> 0 THEN transaction_id END AS transaction_id,
           CASE WHEN event_id % 79 <> 0 THEN is_fraud_ground_truth END AS is_fraud_ground_truth,
           CASE WHEN event_id % 83 = 0 THEN country || 'X' ELSE country END AS country),
         CASE WHEN event_id % 97 = 0 THEN 'malformed_json'
              WHEN event_id % 89 = 0 THEN 'null_transaction_id'
              WHEN event_id % 83 = 0 THEN 'long_country'
              WHEN event_id % 79 = 0 THEN 'null_label' END AS issue
  FROM txn
)"""

# What the stream sees: the faulty records, then a tenth of them once more with a raised amount.
_SENT = f"""{_FAULTY},
sent AS (
  SELECT 0 AS round, * FROM faulty
  UNION ALL
  SELECT 1 AS round, * REPLACE ("Amount" + 1 AS "Amount") FROM faulty WHERE event_id % 10 = 0
),
sound AS (
  SELECT *, fraud_probability >= 0.5 AS is_fraud_predicted
  FROM (SELECT *, {_LOGISTIC} AS fraud_probability FROM sent WHERE issue IS NULL OR issue = 'null_label')
)"""

# Exact split: the test part is rounded up, the train part shared among classes by largest remainder.
_SPLIT = f"""{_TXN},
sizes AS (SELECT "Class" AS class, count(*) AS n, sum(count(*)) OVER () AS total FROM txn GROUP BY "Class"),
shares AS (
  SELECT class, n, total - ceil(total * 0.2::DOUBLE)::BIGINT AS train_rows,
         n * (total - ceil(total * 0.2::DOUBLE)::BIGINT) // total AS whole,
         n * (total - ceil(total * 0.2::DOUBLE)::BIGINT) % total AS remainder
  FROM sizes
),
wanted AS (
  SELECT class, n - whole - (row_number() OVER (ORDER BY remainder DESC, class)
                             <= train_rows - sum(whole) OVER ())::INTEGER AS test_rows
  FROM shares
),
split AS (
  SELECT t.transaction_id, t."Class",
         CASE WHEN row_number() OVER (PARTITION BY t."Class" ORDER BY md5('42:' || t.transaction_id))
                   <= w.test_rows THEN 'test' ELSE 'train' END AS split
  FROM txn t JOIN wanted w ON w.class = t."Class"
)"""

_FIRST_SENT = f"""WITH {_SENT}
SELECT transaction_id, "Amount" AS amount, {_SHOWN_SCORE}, is_fraud_predicted, is_fraud_ground_truth, merchant_id,
       card_last_four, country
FROM sound QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY round) = 1"""

# The split of the model queries: whole vectors go to either part by the hash of their id.
_BY_VECTOR = f"""{_DECIDED},
parted AS (
  SELECT *, is_fraud_predicted::INTEGER AS y, CASE WHEN substr(md5('42:' || (event_id % (SELECT count(*) FROM embeddings))::VARCHAR), 1, 8) < '33333333'
                 THEN 'test' ELSE 'train' END AS split
  FROM decided
)"""


def _histogram(source: str, value: str, bounds: list[float], group: str = "") -> str:
    labels = ", ".join(f"({i}, '{bound}', {bound}::DOUBLE)" for i, bound in enumerate(bounds))
    lead = f"{group}, " if group else ""
    keep = f"PARTITION BY {group} " if group else ""
    return f"""
bounds(bucket, le, upper) AS (VALUES {labels}, ({len(bounds)}, '+Inf', 'Infinity'::DOUBLE)),
at_or_below AS (
  SELECT {lead}bucket, le, count(*) FILTER ({value} <= upper) AS cumulative_count
  FROM {source} CROSS JOIN bounds GROUP BY ALL
)
SELECT {lead}bucket::INTEGER AS bucket, le,
       cumulative_count - coalesce(lag(cumulative_count) OVER ({keep}ORDER BY bucket), 0) AS bucket_count,
       cumulative_count
FROM at_or_below"""


def _quantile(source: str, value: str, bounds: list[float], group: str) -> str:
    edges = ", ".join(f"({i}, {bound}::DOUBLE)" for i, bound in enumerate(bounds))

    def pick(q: float, name: str) -> str:
        return f"""
  CASE WHEN {q} * max(total) > max(below) FILTER (bucket = {len(bounds)}) THEN {bounds[-1]}::DOUBLE
       ELSE max(lower_edge + (upper - lower_edge) * (({q} * total - below) / (upto - below)))
            FILTER (below < {q} * total AND upto >= {q} * total) END::DECIMAL(18,6) AS {name}"""

    return f"""
bounds(bucket, upper) AS (VALUES {edges}, ({len(bounds)}, 'Infinity'::DOUBLE)),
counted AS (
  SELECT {group}, bucket, upper, count(*) FILTER ({value} <= upper) AS upto, count(*) AS total
  FROM {source} CROSS JOIN bounds GROUP BY ALL
),
stepped AS (
  SELECT *, coalesce(lag(upto) OVER same, 0) AS below, coalesce(lag(upper) OVER same, 0) AS lower_edge
  FROM counted WINDOW same AS (PARTITION BY {group} ORDER BY bucket)
)
SELECT {group}, {pick(0.5, "p50")}, {pick(0.95, "p95")}
FROM stepped GROUP BY {group}"""


def _sliding(source: str, window: int, slide: int, columns: str) -> str:
    return f"""
SELECT time_bucket(INTERVAL '{slide} seconds', ts) - k.range * INTERVAL '{slide} seconds' AS window_start,
       {columns}, count(*) AS n
FROM {source} CROSS JOIN range({window // slide}) k GROUP BY 1"""


_SCORE_BOUNDS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
_SCORE_RANGES = "\nUNION ALL\n".join(
    f"SELECT '{'< 0.1' if i == 1 else f'{_SCORE_BOUNDS[i - 1]}-{_SCORE_BOUNDS[i]}'}' AS score_range, "
    f"count(*) FILTER (fraud_probability <= {_SCORE_BOUNDS[i]}"
    + (f" AND fraud_probability > {_SCORE_BOUNDS[i - 1]}" if i > 1 else "")
    + ") AS n_rows FROM decided"
    for i in range(1, len(_SCORE_BOUNDS))
)

_CELLS = """
cells AS (
  SELECT count(*) FILTER (is_fraud_ground_truth = 0 AND NOT is_fraud_predicted) AS tn,
         count(*) FILTER (is_fraud_ground_truth = 0 AND is_fraud_predicted) AS fp,
         count(*) FILTER (is_fraud_ground_truth = 1 AND NOT is_fraud_predicted) AS fn,
         count(*) FILTER (is_fraud_ground_truth = 1 AND is_fraud_predicted) AS tp
  FROM decided
)"""

_INFERENCE_BOUNDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]

ORACLES: dict[str, str] = {
    "score_records": f"""WITH {_SENT}
SELECT count(*) AS total, sum(is_fraud_predicted::INTEGER)::BIGINT AS detected,
       sum(is_fraud_ground_truth)::BIGINT AS actual, avg(fraud_probability)::DECIMAL(18,4) AS avg_score,
       avg(20.0::DOUBLE + partition)::DECIMAL(18,2) AS avg_ms
FROM sound WHERE round = 0""",
    "parse_messages": f"""WITH {_FAULTY}
SELECT {_MESSAGE}, ts AS kafka_timestamp, partition, "offset"
FROM faulty WHERE issue IS DISTINCT FROM 'malformed_json' AND transaction_id IS NOT NULL""",
    "rejected_records": f"""WITH {_FAULTY}
SELECT issue, partition, "offset", issue = 'malformed_json' AS not_json FROM faulty WHERE issue <> 'null_label'""",
    "reject_counts": f"""WITH {_FAULTY}
SELECT issue, count(*) AS n_rows FROM faulty WHERE issue IS NOT NULL GROUP BY issue""",
    "build_messages": f"WITH {_TXN} SELECT {_MESSAGE} FROM txn",
    "keyed_records": f"""WITH {_TXN}
SELECT event_id::VARCHAR AS key, {_MESSAGE} FROM txn""",
    "csv_dataset": f"""WITH {_TXN} SELECT "Time", {_V}, "Amount", "Class" FROM txn""",
    "decisions": f"""WITH {_DECIDED}
SELECT transaction_id, {_SHOWN_SCORE}, is_fraud_predicted, {_SEVERITY} FROM decided""",
    "alerts": f"""WITH {_DECIDED}
SELECT 'ALERT-' || transaction_id AS alert_id, transaction_id, epoch_us(ts) / 1e6 AS "timestamp", {_SHOWN_SCORE},
       "Amount" AS amount, merchant_id, country, card_last_four, {_SEVERITY}
FROM decided WHERE is_fraud_predicted""",
    "alert_messages": f"""WITH {_DECIDED}
SELECT 'ALERT-' || transaction_id AS alert_id, transaction_id, merchant_id, country, card_last_four, {_SEVERITY}
FROM decided WHERE is_fraud_predicted""",
    "transaction_records": f"""WITH {_DECIDED}
SELECT transaction_id, ts AS processed_at, "Amount" AS amount, {_SHOWN_SCORE}, is_fraud_predicted,
       is_fraud_ground_truth, merchant_id, card_last_four, country, processing_time_ms
FROM decided""",
    "high_confidence": f"""WITH {_DECIDED}
SELECT transaction_id, "Amount"::DECIMAL(18,2) AS amount, fraud_probability::DECIMAL(18,4) AS score, country
FROM decided WHERE fraud_probability >= 0.9""",
    "class_profile": f"""WITH {_TXN}
SELECT count(*) AS total, count(*) FILTER ("Class" = 1) AS fraud, count(*) FILTER ("Class" = 0) AS legitimate,
       count(*) FILTER ("Class" = 0) / count(*)::DOUBLE * 100 AS legitimate_pct,
       count(*) FILTER ("Class" = 1) / count(*)::DOUBLE * 100 AS fraud_pct
FROM txn""",
    "split_profile": f"""WITH {_TXN}
SELECT CASE WHEN substr(md5('42:' || transaction_id), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split,
       count(*) AS n_rows, count(*) FILTER ("Class" = 1) AS fraud,
       count(*) FILTER ("Class" = 1) / count(*)::DOUBLE AS fraud_rate
FROM txn GROUP BY 1""",
    "stratified_split": f"WITH {_SPLIT} SELECT * FROM split",
    "class_weight": f"""WITH {_SPLIT}
SELECT count(*) FILTER ("Class" = 0) AS legitimate, count(*) FILTER ("Class" = 1) AS fraud,
       count(*) FILTER ("Class" = 0)::DOUBLE / count(*) FILTER ("Class" = 1)::DOUBLE AS scale_pos_weight
FROM split WHERE split = 'train'""",
    "scaled_features": f"""WITH {_ARRIVALS},
facts AS (
  SELECT avg("Time") AS mt, stddev_pop("Time") AS dt, avg("Amount") AS ma, stddev_pop("Amount") AS da FROM arrivals)
SELECT printf('TXN-%08d', event_id) AS transaction_id, (("Time" - mt) / dt)::DECIMAL(18,6) AS "scaled_Time",
       (("Amount" - ma) / da)::DECIMAL(18,6) AS "scaled_Amount"
FROM arrivals CROSS JOIN facts""",
    "batch_stats": f"WITH {_METRICS} SELECT batch_id, batch_size, fraud_count, fraud_rate FROM metrics",
    "running_counters": f"""WITH {_METRICS}
SELECT batch_id, (sum(batch_size) OVER (ORDER BY batch_id))::BIGINT AS processed_total,
       (sum(fraud_count) OVER (ORDER BY batch_id))::BIGINT AS fraud_total
FROM metrics""",
    "sent_counters": f"""WITH {_METRICS}
SELECT batch_id, (sum(batch_size) OVER (ORDER BY batch_id))::BIGINT AS sent_total,
       (sum(actual_count) OVER (ORDER BY batch_id))::BIGINT AS fraud_sent_total
FROM metrics""",
    "batch_count_series": f"""WITH {_METRICS}
SELECT batch_id, row_number() OVER (ORDER BY batch_id) AS batches_total FROM metrics""",
    "latest_rate": f"""WITH {_METRICS}
SELECT fraud_rate * 100 AS fraud_rate_pct FROM metrics ORDER BY batch_id DESC LIMIT 1""",
    "recent_batches": f"""WITH {_METRICS}
SELECT batch_id, batch_size, fraud_count, (fraud_rate * 100)::DECIMAL(18,3) AS fraud_pct,
       processing_ms::DECIMAL(18,0) AS ms, last_ts AS processed_at
FROM metrics ORDER BY batch_id DESC LIMIT 10""",
    "fraud_summary": f"""WITH {_DECIDED}
SELECT count(*) AS total, sum(is_fraud_predicted::INTEGER)::BIGINT AS detected,
       sum(is_fraud_ground_truth)::BIGINT AS actual, avg(fraud_probability)::DECIMAL(18,4) AS avg_score,
       avg(processing_time_ms)::DECIMAL(18,2) AS avg_ms
FROM decided""",
    "health_count": f"""WITH {_DECIDED}
SELECT count(*) AS total, sum(is_fraud_predicted::INTEGER)::BIGINT AS fraud FROM decided""",
    "recent_transactions": f"""WITH {_DECIDED}
SELECT transaction_id, "Amount"::DECIMAL(18,2) AS amount, fraud_probability::DECIMAL(18,4) AS score,
       is_fraud_predicted AS fraud, country, ts AS processed_at
FROM decided ORDER BY ts DESC, transaction_id DESC LIMIT 10""",
    "confusion": f"""WITH {_DECIDED},{_CELLS}
SELECT *, fp / (tn + fp)::DOUBLE * 100 AS fpr_pct, fn / (fn + tp)::DOUBLE * 100 AS fnr_pct FROM cells""",
    "classification_report": f"""WITH {_DECIDED},{_CELLS},
per_class AS (
  SELECT 'Legitimate' AS class_name, tn / (tn + fn)::DOUBLE AS precision, tn / (tn + fp)::DOUBLE AS recall,
         tn + fp AS support FROM cells
  UNION ALL
  SELECT 'Fraud', tp / (tp + fp)::DOUBLE, tp / (tp + fn)::DOUBLE, tp + fn FROM cells
),
scored AS (SELECT *, 2 * precision * recall / (precision + recall) AS f1_score FROM per_class),
report AS (
  SELECT class_name, precision, recall, f1_score, support FROM scored
  UNION ALL
  SELECT 'accuracy', NULL, NULL, (tp + tn) / (tp + tn + fp + fn)::DOUBLE, tp + tn + fp + fn FROM cells
  UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM scored
  UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1_score * support) / sum(support), sum(support) FROM scored
)
SELECT class_name, precision::DECIMAL(18,6) AS precision, recall::DECIMAL(18,6) AS recall,
       f1_score::DECIMAL(18,6) AS f1_score, support::BIGINT AS support
FROM report""",
    "roc_auc": f"""WITH {_DECIDED},
ranked AS (
  SELECT is_fraud_ground_truth AS y,
         rank() OVER (ORDER BY fraud_probability)
         + (count(*) OVER (PARTITION BY fraud_probability) - 1) / 2.0 AS place
  FROM decided
)
SELECT ((sum(place) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0)::DOUBLE
        / (sum(y)::DOUBLE * (count(*) - sum(y))::DOUBLE))::DECIMAL(18,10) AS auc_roc
FROM ranked""",
    "score_metadata": f"""WITH {_SPLIT},
scored AS (
  SELECT s.split, s."Class" AS y, {_LOGISTIC} AS p FROM split s JOIN txn t USING (transaction_id)
),
ranked AS (
  SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS place
  FROM scored WHERE split = 'test'
),
area AS (
  SELECT ((sum(place) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0)::DOUBLE
          / (sum(y)::DOUBLE * (count(*) - sum(y))::DOUBLE)) AS auc_roc
  FROM ranked
)
SELECT round((SELECT auc_roc FROM area), 4) AS auc_roc, '{_FEATURES}' AS features, 100::INTEGER AS n_estimators,
       0.5::DOUBLE AS threshold, count(*) FILTER (split = 'train') AS train_size,
       count(*) FILTER (split = 'test') AS test_size,
       round(avg(y) FILTER (split = 'train'), 6) AS fraud_rate_train,
       round(count(*) FILTER (split = 'train' AND y = 0) / (count(*) FILTER (split = 'train' AND y = 1))::DOUBLE, 2)
         AS scale_pos_weight
FROM scored""",
    "score_histogram": f"WITH {_DECIDED},{_histogram('decided', 'fraud_probability', _SCORE_BOUNDS)}",
    "score_buckets": f"WITH {_DECIDED}\n{_SCORE_RANGES}",
    "size_histogram": f"""WITH {_METRICS},{
        _histogram('metrics', 'batch_size', [1.0, 5.0, 10.0, 50.0, 100.0, 500.0, 1000.0, 5000.0])
    }""",
    "batch_seconds_histogram": f"""WITH {_METRICS},{
        _histogram('metrics', 'processing_ms / 1000', [0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0])
    }""",
    "inference_histogram": f"""WITH {_ARRIVALS},{
        _histogram('arrivals', 'processing_time_ms / 1000', _INFERENCE_BOUNDS, 'country')
    }""",
    "send_histogram": f"""WITH {_ARRIVALS},{
        _histogram('arrivals', '"Amount" / 1000', [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5])
    }""",
    "histogram_quantile": f"""WITH {_ARRIVALS},
daily AS (SELECT ts::DATE AS day, "Amount" FROM arrivals),{
        _quantile('daily', '"Amount"', [1.0, 5.0, 10.0, 50.0, 100.0, 500.0], 'day')
    }""",
    "inference_latency": f"""WITH {_ARRIVALS},
timed AS (
  SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, processing_time_ms / 1000 AS seconds FROM arrivals
),{_quantile('timed', 'seconds', _INFERENCE_BOUNDS, 'window_start')}""",
    "windowed_rate": f"WITH {_ARRIVALS}{_sliding('arrivals', 60, 15, 'count(*) / 60::DOUBLE AS rate')}",
    "detected_vs_actual": f"""WITH {_DECIDED}{
        _sliding(
            'decided',
            3600,
            900,
            'count(*) FILTER (is_fraud_predicted) / 3600::DOUBLE AS detected_rate, '
            'count(*) FILTER (is_fraud_ground_truth = 1) / 3600::DOUBLE AS actual_rate',
        )
    }""",
    "achieved_rate": """
SELECT count(*) AS n_rows, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS elapsed_seconds,
       count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) AS rows_per_second
FROM events""",
    "insert_if_absent": f"""WITH {_DECIDED}
SELECT transaction_id, "Amount" AS amount, {_SHOWN_SCORE}, is_fraud_predicted, is_fraud_ground_truth, merchant_id,
       country
FROM decided""",
    "stream_score": _FIRST_SENT,
    "stream_alerts": f"""WITH {_SENT}
SELECT 'ALERT-' || transaction_id AS alert_id, transaction_id, {_SHOWN_SCORE}, "Amount" AS amount, merchant_id,
       country, {_SEVERITY}
FROM sound WHERE is_fraud_predicted""",
    "stream_totals": f"""WITH {_SENT}
SELECT count(*) AS processed, count(*) FILTER (is_fraud_predicted) AS detected FROM sound""",
    "stream_score_histogram": f"WITH {_SENT},{_histogram('sound', 'fraud_probability', _SCORE_BOUNDS)}",
    "stream_rejects": f"""WITH {_SENT}
SELECT issue, count(*) AS n_rows FROM sent WHERE issue <> 'null_label' GROUP BY issue""",
    "stream_windowed_rate": _sliding("events", 3600, 900, "count(*) / 3600::DOUBLE AS rate"),
    "stream_new_checkpoint": _FIRST_SENT,
    "stream_intake_limit": """WITH sizes AS (SELECT count(*) AS n, greatest(1, 3 * count(*) // 10) AS most FROM events)
SELECT batch_id, least(most, n - batch_id * most) AS batch_size
FROM sizes, unnest(range((n + most - 1) // most)) AS batches (batch_id)""",
    "stream_latest_start": f"""WITH {_SENT}
SELECT transaction_id, "Amount" AS amount, {_SHOWN_SCORE}, is_fraud_predicted, is_fraud_ground_truth, country
FROM sound WHERE round = 1""",
    "stream_lost_range": f"""WITH {_DECIDED},
third AS (SELECT max("offset") // 3 AS n FROM decided)
SELECT transaction_id, "Amount" AS amount, {_SHOWN_SCORE}, true AS failed_first
FROM decided, third WHERE "offset" < n OR "offset" >= 2 * n""",
    "stream_rate_over_checkpoints": _sliding("events", 3600, 900, "count(*) / 3600::DOUBLE AS rate"),
    "train_eval": f"""WITH {_BY_VECTOR}
SELECT count(*) FILTER (y = 0) AS n_legitimate, count(*) FILTER (y = 1) AS n_fraud, true AS auc_reached,
       true AS recall_reached, true AS precision_reached
FROM parted WHERE split = 'test'""",
    "model_metadata": f"""WITH {_BY_VECTOR}
SELECT true AS auc_reached, '{_FEATURES}' AS features, 100::INTEGER AS n_estimators, 0.5::DOUBLE AS threshold,
       count(*) FILTER (split = 'train') AS train_size, count(*) FILTER (split = 'test') AS test_size,
       round(avg(y) FILTER (split = 'train'), 6) AS fraud_rate_train,
       round(count(*) FILTER (split = 'train' AND y = 0)
             / (count(*) FILTER (split = 'train' AND y = 1))::DOUBLE, 2) AS scale_pos_weight
FROM parted""",
    "score_gbt": f"""WITH {_BY_VECTOR}
SELECT transaction_id, y AS "Class", true AS score_sound, true AS flag_sound, count(*) OVER (PARTITION BY y) AS n_rows,
       0.0::DOUBLE AS largest_difference, true AS mostly_right
FROM parted""",
    "feature_importance": """
SELECT feature, true AS matters, 30::BIGINT AS n_features, 1.0::DECIMAL(18,6) AS total, true AS signal_found
FROM (VALUES ('Amount'), ('V1'), ('V2'), ('V3')) t(feature)""",
    "pandas_udf_score": f"WITH {_DECIDED} SELECT transaction_id, {_SHOWN_SCORE} FROM decided",
}
ORACLES["stream_inference_latency"] = ORACLES["inference_latency"]
