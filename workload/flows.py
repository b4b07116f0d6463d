"""End-to-end flows through stored tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidewell.operators import features, labels, mutation, quality
from tidewell.plans import daily
from tidewell.session import scratch_path
from tidewell.sources import readers
from tidewell.sources.contract import SEED_COLUMNS
from tidewell.sources.tables import TableStore
from workload.tables import AS_OF, CONTRACT_EVENTS, SEED_ROWS, contract_events, load, rounded, seed_rows

RULES = (
    quality.Rule("user_present", "user is required", quality.Severity.QUARANTINE, lambda: F.col("user_id").isNotNull()),
    quality.Rule("value_positive", "value must be positive", quality.Severity.QUARANTINE, lambda: F.col("value") > 0),
    quality.Rule("value_moderate", "value should stay below 200", quality.Severity.WARN, lambda: F.col("value") < 200),
)
SHOP = features.FeatureSpec(
    entity="user_id",
    ts="ts",
    windows=(3, 7, 14),
    counts=(
        features.Count("click_count", "click"),
        features.Count("purchase_count", "purchase"),
        features.Count("error_count", "error"),
    ),
    ratios=(features.Ratio("purchase_rate", "purchase_count", "click_count"),),
    level=features.Level("purchase", "value", "last_purchase", "mean_purchase", "prior_purchase", "purchase_delta_pct", 7),
)


def segment_churn(spark, sf):
    """Quality rules, features at one date, customer attributes, labels, and churn per market segment."""
    events = load(spark, sf, "events")
    clean = quality.QualityCheck(events, RULES).clean()
    snapshot = features.feature_snapshot(clean, AS_OF, SHOP)
    customer = load(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_acctbal")
    spec = labels.LabelSpec(entity="user_id", ts="ts", outcome="error", horizon=7, label="churned")
    outcome = labels.delayed_labels(clean, snapshot, AS_OF, date(2024, 2, 1), spec)
    joined = labels.training_set(snapshot, outcome, "user_id").join(customer, "user_id", "left")
    result = joined.groupBy("c_mktsegment").agg(
        F.count("*").alias("customers"),
        F.sum("churned").alias("churned_customers"),
        F.avg("churned").alias("churn_rate"),
        F.sum("click_count_14d").alias("clicks_14d"),
        F.avg("last_purchase").alias("avg_last_purchase"),
        F.avg("days_since_last_activity").alias("avg_days_idle"),
    )
    return rounded(result, 6, "churn_rate", "avg_last_purchase", "avg_days_idle")


SEGMENT_CHURN_SQL = f"""
WITH c AS (SELECT * FROM events WHERE user_id IS NOT NULL AND value > 0),
f AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'click' AND ts >= DATE '{AS_OF}' - 14) AS clicks,
             arg_max(value, (ts, event_id)) FILTER (WHERE event_type = 'purchase') AS last_purchase,
             date_diff('day', CAST(max(ts) AS DATE), DATE '{AS_OF}') AS idle
      FROM c WHERE ts < DATE '{AS_OF}' + 1 GROUP BY user_id),
l AS (SELECT DISTINCT user_id FROM c WHERE event_type = 'error' AND ts >= DATE '{AS_OF}' + 1 AND ts < DATE '{AS_OF}' + 8)
SELECT c_mktsegment, count(*) AS customers, count(l.user_id) AS churned_customers,
       round(avg(CASE WHEN l.user_id IS NULL THEN 0 ELSE 1 END), 6) AS churn_rate, CAST(sum(clicks) AS BIGINT) AS clicks_14d,
       round(avg(last_purchase), 6) AS avg_last_purchase, round(avg(idle), 6) AS avg_days_idle
FROM f LEFT JOIN l USING (user_id) LEFT JOIN customer ON f.user_id = c_custkey GROUP BY c_mktsegment"""


def seed_csv(spark, sf):
    """The seed file written as CSV, scanned strictly, with record hash and lineage."""
    path = f"{scratch_path(spark, 'seed')}/customers.csv"
    writer = seed_rows(spark, sf).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    rows = readers.read_seed_csv(spark, path, SEED_COLUMNS)
    return rows.select(
        F.trim("customerID").alias("customer_id"),
        "_record_hash",
        "_source_type",
        F.col("_source_file").contains("customers.csv").alias("has_lineage"),
    )


SEED_CSV_SQL = f"""
WITH {SEED_ROWS}
SELECT trim(customer_id) AS customer_id,
       sha256(concat_ws('|', customer_id, 'Female ', senior_citizen, 'Yes', ' No', tenure, 'Yes', 'No', internet_service, 'No', 'No',
                        'No', 'Yes', 'No', 'No', contract, 'Yes', payment_method, monthly_charges, total_charges, churn)) AS _record_hash,
       'csv_seed' AS _source_type, true AS has_lineage
FROM seed"""


def daily_flow(spark, sf):
    """Seed, customer snapshot with quarantine, features, labels and training set, all through tables."""
    store = TableStore(spark, scratch_path(spark, "daily"))
    events = contract_events(spark, sf)
    store.overwrite(daily.CUSTOMERS_RAW, seed_rows(spark, sf))
    daily.build_customer_snapshot(store, AS_OF)
    daily.build_feature_snapshot(store, events, AS_OF)
    daily.build_labels(store, events, AS_OF, date(2024, 2, 1), horizon=7)
    rows = daily.training_set(store)
    return rows.select(
        "customer_id", "snapshot_date", "payment_count_30d", "days_since_last_activity", "tenure",
        "internet_service", "churned", "maturity_date",
    )


DAILY_SQL = f"""
WITH {CONTRACT_EVENTS}, {SEED_ROWS},
good AS (SELECT * FROM conformed WHERE churn_label IN (0, 1) AND senior_citizen IS NOT NULL AND monthly_charges IS NOT NULL AND tenure >= 0),
f AS (SELECT customer_id, count(*) FILTER (WHERE event_type = 'payment' AND event_ts >= DATE '{AS_OF}' - 30) AS payment_count_30d,
             CAST(date_diff('day', CAST(max(event_ts) AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_last_activity
      FROM ev WHERE event_ts < DATE '{AS_OF}' + 1 GROUP BY customer_id),
l AS (SELECT DISTINCT customer_id, 1 AS hit FROM ev WHERE event_type = 'cancellation' AND event_ts >= DATE '{AS_OF}' + 1 AND event_ts < DATE '{AS_OF}' + 8)
SELECT customer_id, DATE '{AS_OF}' AS snapshot_date, payment_count_30d, days_since_last_activity, tenure, internet_service,
       coalesce(hit, 0) AS churned, DATE '2024-01-27' AS maturity_date
FROM f LEFT JOIN good USING (customer_id) LEFT JOIN l USING (customer_id)"""


def label_mature_flow(spark, sf):
    """Snapshots of four weeks, labelled at three times as they mature; a repeated call adds nothing."""
    store = TableStore(spark, scratch_path(spark, "labels"))
    events = contract_events(spark, sf)
    daily.backfill(store, events, date(2024, 1, 2), date(2024, 1, 29))
    added = [
        daily.label_mature_snapshots(store, events, today, horizon=7).rows
        for today in (date(2024, 1, 15), date(2024, 1, 20), date(2024, 1, 20), date(2024, 1, 30))
    ]
    labelled = store.read(daily.LABELS)
    steps = F.lit(",".join("none" if n == 0 else "some" for n in added)).alias("calls")
    return labelled.select("customer_id", "snapshot_date", "churned", "maturity_date", steps)


LABEL_FLOW_SQL = f"""
WITH {CONTRACT_EVENTS},
days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-02', DATE '2024-01-23', INTERVAL 1 DAY)) AS DATE) AS snapshot_date),
seen AS (SELECT customer_id, CAST(min(event_ts) AS DATE) AS first_day FROM ev GROUP BY customer_id),
c AS (SELECT DISTINCT customer_id, CAST(event_ts AS DATE) AS day FROM ev WHERE event_type = 'cancellation')
SELECT customer_id, snapshot_date, CAST(EXISTS (SELECT 1 FROM c WHERE c.customer_id = seen.customer_id
         AND c.day > snapshot_date AND c.day <= snapshot_date + 7) AS INTEGER) AS churned,
       CAST(snapshot_date + 7 AS DATE) AS maturity_date, 'some,some,none,some' AS calls
FROM days JOIN seen ON first_day <= snapshot_date"""


def require_unique_seed(spark, sf):
    """Customers whose trimmed id is unique, after the structural check passed."""
    ids = seed_rows(spark, sf).select(F.trim("customerID").alias("customer_id"))
    return mutation.require_unique(ids, ["customer_id"])


QUERIES = {
    "segment_churn": (segment_churn, SEGMENT_CHURN_SQL),
    "seed_csv": (seed_csv, SEED_CSV_SQL),
    "daily_flow": (daily_flow, DAILY_SQL),
    "label_mature_flow": (label_mature_flow, LABEL_FLOW_SQL),
    "require_unique_seed": (
        require_unique_seed,
        f"WITH {SEED_ROWS} SELECT trim(customer_id) AS customer_id FROM seed",
    ),
}
