"""Keys, conforming, contract and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import keys
from tidewell.operators import conform, mutation, quality
from tidewell.operators.quality import Rule, Severity
from tidewell.sources import contract
from workload.tables import (
    AS_OF,
    CONTRACT_EVENTS,
    SEED_ROWS,
    contract_events,
    load,
    seed_rows,
)

CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def record_hash(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", keys.record_hash(CUSTOMER_COLUMNS).alias("record_hash"))


def hash_uniform(spark, sf):
    u = keys.hash_uniform(["c_custkey"], 20260801)
    return load(spark, sf, "customer").select("c_custkey", F.round(u, 12).alias("u"))


def event_identity(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd")
    return load(spark, sf, "events").select(
        "event_id", keys.event_identity(["user_id", "event_type", day, "event_id"]).alias("identity")
    )


def _conformed(spark, sf):
    return conform.conform_customers(seed_rows(spark, sf), AS_OF)


def conform_customer(spark, sf):
    return _conformed(spark, sf).select(
        "customer_id", "snapshot_date", "senior_citizen", "tenure", "internet_service", "contract",
        "payment_method", "monthly_charges", "total_charges", "churn", "churn_label",
    )


SHOP_RULES = (
    Rule("user_present", "user is required", Severity.FAIL, lambda: F.col("user_id").isNotNull()),
    Rule("value_not_tiny", "value must be at least 1", Severity.QUARANTINE, lambda: F.col("value") >= 1),
    Rule("known_type", "type must be known", Severity.QUARANTINE,
         lambda: F.col("event_type").isin("click", "view", "purchase", "signup")),
    Rule("value_moderate", "value should stay below 100", Severity.WARN, lambda: F.col("value") < 100),
    Rule("value_not_huge", "value must stay below 250", Severity.QUARANTINE, lambda: F.col("value") < 250),
    Rule("even_id", "even ids are preferred", Severity.WARN, lambda: F.col("event_id") % 2 == 0),
)

FIRST_BROKEN_SQL = """
tagged AS (
  SELECT *, CASE WHEN NOT coalesce(value >= 1, false) THEN 1
                 WHEN NOT coalesce(event_type IN ('click','view','purchase','signup'), false) THEN 2
                 WHEN NOT coalesce(value < 250, false) THEN 4 END AS q FROM events
)"""


def _check(spark, sf):
    return quality.QualityCheck(load(spark, sf, "events"), SHOP_RULES, "run-1", "bronze")


def quality_metrics(spark, sf):
    return _check(spark, sf).metrics().drop("evaluated_at")


def _metric_sql(rules, source):
    parts = []
    for i, (name, severity, good) in enumerate(rules):
        parts.append(
            f"SELECT {i} AS rule_order, '{name}' AS rule_name, '{severity}' AS severity, "
            f"count(*) AS total_rows, count(*) FILTER (WHERE coalesce({good}, false)) AS passing_rows, "
            f"count(*) FILTER (WHERE NOT coalesce({good}, false)) AS violating_rows "
            f"FROM {source} WHERE q IS NULL OR q >= {i}"
        )
    return " UNION ALL ".join(parts)


QUALITY_METRICS_SQL = f"""
WITH {FIRST_BROKEN_SQL}, m AS ({_metric_sql([
    ('user_present', 'fail', 'user_id IS NOT NULL'),
    ('value_not_tiny', 'quarantine', 'value >= 1'),
    ('known_type', 'quarantine', "event_type IN ('click','view','purchase','signup')"),
    ('value_moderate', 'warn', 'value < 100'),
    ('value_not_huge', 'quarantine', 'value < 250'),
    ('even_id', 'warn', 'event_id % 2 = 0'),
], 'tagged')})
SELECT *, 'bronze' AS stage, 'run-1' AS run_id FROM m"""


def quality_quarantine(spark, sf):
    q = _check(spark, sf).quarantine()
    payload = F.from_json("original_payload", "event_id bigint, user_id bigint, event_type string, value double")
    return q.select(payload.alias("p"), "violated_rule", "violation_description", "ingestion_run_id").select(
        "p.*", "violated_rule", "violation_description", "ingestion_run_id"
    )


QUARANTINE_SQL = f"""
WITH {FIRST_BROKEN_SQL}
SELECT event_id, user_id, event_type, value,
       CASE q WHEN 1 THEN 'value_not_tiny' WHEN 2 THEN 'known_type' ELSE 'value_not_huge' END AS violated_rule,
       CASE q WHEN 1 THEN 'value must be at least 1' WHEN 2 THEN 'type must be known'
              ELSE 'value must stay below 250' END AS violation_description,
       'run-1' AS ingestion_run_id
FROM tagged WHERE q IS NOT NULL"""


def quality_clean(spark, sf):
    return _check(spark, sf).clean().select("event_id", "user_id", "event_type", "value")


def _event_text(spark, sf):
    """Contract events with the time as ISO text, as they come from the landing zone."""
    e = contract_events(spark, sf)
    return e.withColumns(
        {
            "event_id": F.when(F.col("k") == 0, "").otherwise(F.col("event_id").cast("string")),
            "event_timestamp": F.when(F.col("k") == 1, "yesterday").otherwise(
                F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
            ),
            "event_type": F.when(F.col("k") == 2, "teleportation").otherwise(F.col("event_type")),
            "amount": F.when(F.col("k") == 3, -F.col("amount")).otherwise(F.col("amount")),
            "schema_version": F.when(F.col("k") == 4, F.lit(None)).when(F.col("k") == 5, 999).otherwise(1),
        }
    )


EVENT_TEXT_SQL = f"""
{CONTRACT_EVENTS},
et AS (
  SELECT CASE WHEN k = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS event_id, customer_id,
         CASE WHEN k = 1 THEN 'yesterday' ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_timestamp,
         CASE WHEN k = 2 THEN 'teleportation' ELSE event_type END AS event_type,
         CASE WHEN k = 3 THEN -amount ELSE amount END AS amount, usage_gb, payment_status, complaint_severity,
         CASE WHEN k = 4 THEN NULL WHEN k = 5 THEN 999 ELSE 1 END AS schema_version, k
  FROM ev
)"""

_TYPES_SQL = "('billing','cancellation','complaint','payment','plan_change','support_call','usage')"
EVENT_RULES_SQL = f"""
WITH {EVENT_TEXT_SQL},
tagged AS (
  SELECT *, CASE WHEN NOT coalesce(length(event_id) > 0, false) THEN 0
                 WHEN NOT coalesce(length(customer_id) > 0, false) THEN 1
                 WHEN NOT coalesce(try_strptime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') >= TIMESTAMP '2020-01-01', false) THEN 2
                 WHEN event_type NOT IN {_TYPES_SQL} THEN 3 END AS q FROM et
), m AS ({_metric_sql([
    ('event_id_not_null', 'quarantine', 'length(event_id) > 0'),
    ('customer_id_not_null', 'quarantine', 'length(customer_id) > 0'),
    ('event_timestamp_plausible', 'quarantine',
     "try_strptime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') >= TIMESTAMP '2020-01-01' AND "
     "try_strptime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') < TIMESTAMP '2030-01-01'"),
    ('event_type_in_contract', 'quarantine', f'event_type IN {_TYPES_SQL}'),
    ('amount_non_negative', 'warn', 'amount IS NULL OR amount >= 0'),
    ('usage_gb_non_negative', 'warn', 'usage_gb IS NULL OR usage_gb >= 0'),
    ('schema_version_present', 'warn', 'schema_version IS NOT NULL'),
], 'tagged')})
SELECT rule_order, rule_name, severity, total_rows, passing_rows, violating_rows FROM m"""


def event_rule_metrics(spark, sf):
    check = quality.QualityCheck(_event_text(spark, sf), quality.EVENT_RULES)
    return check.metrics().drop("stage", "run_id", "evaluated_at")


def snapshot_rule_metrics(spark, sf):
    check = quality.QualityCheck(_conformed(spark, sf), quality.SNAPSHOT_RULES)
    return check.metrics().drop("stage", "run_id", "evaluated_at")


SNAPSHOT_RULES_SQL = f"""
WITH {SEED_ROWS},
tagged AS (
  SELECT *, CASE WHEN NOT coalesce(length(customer_id) > 0, false) THEN 0
                 WHEN NOT coalesce(churn_label IN (0, 1), false) THEN 1
                 WHEN senior_citizen IS NULL THEN 2
                 WHEN monthly_charges IS NULL THEN 3
                 WHEN NOT coalesce(tenure >= 0, false) THEN 4 END AS q FROM conformed
), m AS ({_metric_sql([
    ('customer_id_not_null', 'quarantine', 'length(customer_id) > 0'),
    ('churn_label_valid', 'quarantine', 'churn_label IN (0, 1)'),
    ('senior_citizen_not_null', 'quarantine', 'senior_citizen IS NOT NULL'),
    ('monthly_charges_not_null', 'quarantine', 'monthly_charges IS NOT NULL'),
    ('tenure_valid', 'quarantine', 'tenure >= 0'),
    ('total_charges_consistent', 'warn', 'tenure = 0 OR total_charges IS NOT NULL'),
], 'tagged')})
SELECT * FROM m"""


def contract_violations(spark, sf):
    e = _event_text(spark, sf)
    present = [c for c in e.columns if c in contract.EVENT_CONTRACT.names]
    messages = contract.violation_messages(contract.EVENT_CONTRACT, [*present, "event_date"])
    shaped = e.withColumn("event_date", F.when(F.col("k") != 6, F.date_format("event_ts", "yyyy-MM-dd")))
    return (
        shaped.select("event_id", F.explode(messages).alias("message"))
        .groupBy("message")
        .agg(F.count("*").alias("events"))
    )


CONTRACT_VIOLATIONS_SQL = f"""
WITH {EVENT_TEXT_SQL}
SELECT message, count(*) AS events FROM (
  SELECT 'missing required field: event_date' AS message FROM et WHERE k = 6
  UNION ALL SELECT 'missing required field: schema_version' FROM et WHERE schema_version IS NULL
  UNION ALL SELECT 'invalid event_type: ' || event_type FROM et WHERE event_type NOT IN {_TYPES_SQL}
  UNION ALL SELECT 'unsupported schema_version: ' || schema_version FROM et WHERE schema_version <> 1
) GROUP BY message"""


def entity_state_check(spark, sf):
    raw = _conformed(spark, sf).select(
        F.when(F.col("senior_citizen") == 1, " ").otherwise(F.col("customer_id")).alias("customer_id"),
        "tenure",
        "monthly_charges",
        "churn_label",
        F.when(F.col("contract") == "BUILDING", "").otherwise(F.col("contract")).alias("contract"),
        "internet_service",
        "payment_method",
        F.lit(None).cast("string").alias("tech_support"),
    )
    checked = contract.validate_entity_state(raw)
    return checked.groupBy("contract", "tech_support", F.array_join("state_errors", "; ").alias("errors")).agg(
        F.count("*").alias("customers")
    )


ENTITY_STATE_SQL = f"""
WITH {SEED_ROWS}
SELECT CASE WHEN contract = 'BUILDING' THEN 'Unknown' ELSE contract END AS contract, 'Unknown' AS tech_support,
       concat_ws('; ', CASE WHEN senior_citizen = 1 THEN 'customer_id is required' END,
         CASE WHEN NOT coalesce(tenure >= 0, false) THEN 'tenure must be non-negative' END,
         CASE WHEN NOT coalesce(monthly_charges >= 0, false) THEN 'monthly_charges must be non-negative' END,
         CASE WHEN NOT coalesce(churn_label IN (0, 1), false) THEN 'churn_label must be 0 or 1' END) AS errors,
       count(*) AS customers
FROM conformed GROUP BY ALL"""


def rescued_fields(spark, sf):
    """``props`` and an undeclared field, parsed by a one-field contract with rescue."""
    e = load(spark, sf, "events")
    with_extra = F.concat(F.expr("left(props, length(props) - 1)"), F.lit(', "extra": "'), "event_type", F.lit('"}'))
    lines = e.select(
        "event_id", F.when(F.col("event_type") == "error", with_extra).otherwise(F.col("props")).alias("value")
    )
    small = contract.Contract((contract.Field("k", "integer", True),))
    parsed = contract.parse_with_rescue(lines, small)
    return parsed.select("event_id", "k", F.get_json_object("_rescued_data", "$.extra").alias("extra"))


RESCUED_SQL = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CASE WHEN event_type = 'error' THEN 'error' END AS extra
FROM events"""


def duplicate_keys(spark, sf):
    return mutation.duplicate_keys(load(spark, sf, "conversations"), ["conv_id"])


def duplicate_report(spark, sf):
    return mutation.duplicate_report(load(spark, sf, "conversations"), ["conv_id"])


QUERIES = {
    "record_hash": (
        record_hash,
        "SELECT c_custkey, sha256(concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), "
        "CAST(c_acctbal AS VARCHAR), c_mktsegment)) AS record_hash FROM customer",
    ),
    "hash_uniform": (
        hash_uniform,
        "SELECT c_custkey, round(CAST(CAST('0x' || substr(sha256('20260801|' || c_custkey), 1, 16) AS UBIGINT) AS DOUBLE) "
        "/ CAST(18446744073709551616 AS DOUBLE), 12) AS u FROM customer",
    ),
    "event_identity": (
        event_identity,
        "SELECT event_id, sha256('v1|' || user_id || '|' || event_type || '|' || strftime(ts, '%Y-%m-%d') || '|' || event_id) "
        "AS identity FROM events",
    ),
    "conform_customer": (conform_customer, f"WITH {SEED_ROWS} SELECT * FROM conformed"),
    "quality_metrics": (quality_metrics, QUALITY_METRICS_SQL),
    "quality_quarantine": (quality_quarantine, QUARANTINE_SQL),
    "quality_clean": (
        quality_clean,
        f"WITH {FIRST_BROKEN_SQL} SELECT event_id, user_id, event_type, value FROM tagged WHERE q IS NULL",
    ),
    "event_rule_metrics": (event_rule_metrics, EVENT_RULES_SQL),
    "snapshot_rule_metrics": (snapshot_rule_metrics, SNAPSHOT_RULES_SQL),
    "contract_violations": (contract_violations, CONTRACT_VIOLATIONS_SQL),
    "entity_state_check": (entity_state_check, ENTITY_STATE_SQL),
    "rescued_fields": (rescued_fields, RESCUED_SQL),
    "duplicate_keys": (
        duplicate_keys,
        "SELECT conv_id, count(*) AS copies FROM conversations GROUP BY conv_id HAVING count(*) > 1",
    ),
    "duplicate_report": (
        duplicate_report,
        "SELECT conv_id, count(*) AS copies FROM conversations GROUP BY conv_id HAVING count(*) > 1 ORDER BY conv_id LIMIT 3",
    ),
}
