"""Point-in-time features, labels, training set and backfill queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidewell.operators import features, labels
from tidewell.operators.features import CUSTOMER_FEATURES, Count, FeatureSpec, Level, Ratio
from workload.tables import (
    AS_OF,
    CONTRACT_EVENTS,
    CUSTOMER_SNAPSHOTS,
    contract_events,
    customer_snapshots,
    load,
    rounded,
)

WINDOWS = (7, 30, 90)
COUNTS = {
    "payment_count": "event_type = 'payment'",
    "payment_failures": "event_type = 'payment' AND payment_status = 'failed'",
    "support_call_count": "event_type = 'support_call'",
    "complaint_count": "event_type = 'complaint'",
    "complaint_high": "event_type = 'complaint' AND complaint_severity = 'high'",
    "plan_change_count": "event_type = 'plan_change'",
    "billing_count": "event_type = 'billing'",
    "cancellation_count": "event_type = 'cancellation'",
}
LEVELS = ("latest_usage_gb", "avg_usage_30d", "avg_usage_prior_30d", "usage_delta_pct")
RATES = tuple(f"payment_failure_rate_{d}d" for d in WINDOWS)
COUNT_NAMES = [f"{n}_{d}d" for d in WINDOWS for n in COUNTS]


def snapshot_sql(source: str, day: str, group: str) -> str:
    """Event features grouped by ``group`` as of the day expression ``day``."""
    counts = [
        f"count(*) FILTER (WHERE {cond} AND event_ts >= CAST({day} AS DATE) - {d}) AS {name}_{d}d"
        for d in WINDOWS
        for name, cond in COUNTS.items()
    ]
    usage = "event_type = 'usage'"
    levels = [
        f"arg_max(usage_gb, (event_ts, event_id)) FILTER (WHERE {usage}) AS latest_usage_gb",
        f"avg(usage_gb) FILTER (WHERE {usage} AND event_ts >= CAST({day} AS DATE) - 30) AS avg_usage_30d",
        f"avg(usage_gb) FILTER (WHERE {usage} AND event_ts >= CAST({day} AS DATE) - 60 "
        f"AND event_ts < CAST({day} AS DATE) - 30) AS avg_usage_prior_30d",
        f"CAST(date_diff('day', CAST(max(event_ts) AS DATE), CAST({day} AS DATE)) AS INTEGER) AS days_since_last_activity",
    ]
    return (
        f"SELECT {group}, {', '.join(counts + levels)} FROM {source} "
        f"WHERE event_ts < CAST({day} AS DATE) + 1 GROUP BY {group}"
    )


FINISH = """
  CASE WHEN avg_usage_prior_30d > 0
       THEN round((avg_usage_30d - avg_usage_prior_30d) / avg_usage_prior_30d * 100, 6) END AS usage_delta_pct,
  CASE WHEN payment_count_7d > 0 THEN round(payment_failures_7d / payment_count_7d, 6) END AS payment_failure_rate_7d,
  CASE WHEN payment_count_30d > 0 THEN round(payment_failures_30d / payment_count_30d, 6) END AS payment_failure_rate_30d,
  CASE WHEN payment_count_90d > 0 THEN round(payment_failures_90d / payment_count_90d, 6) END AS payment_failure_rate_90d"""
ROUND_MEANS = (
    "* REPLACE (round(avg_usage_30d, 6) AS avg_usage_30d, round(avg_usage_prior_30d, 6) AS avg_usage_prior_30d)"
)
FINISHED = f"SELECT {ROUND_MEANS}, {FINISH} FROM f"
ONE_DATE = f"{CONTRACT_EVENTS}, f AS ({snapshot_sql('ev', chr(39) + AS_OF.isoformat() + chr(39), 'customer_id')})"


def _rounded(df):
    return rounded(df, 6, "avg_usage_30d", "avg_usage_prior_30d", "usage_delta_pct", *RATES)


def _snapshot(spark, sf):
    return features.feature_snapshot(contract_events(spark, sf), AS_OF, snapshots=customer_snapshots(spark, sf))


def feature_counts(spark, sf):
    f = features.aggregate_events(contract_events(spark, sf), AS_OF, CUSTOMER_FEATURES)
    return f.select("customer_id", *COUNT_NAMES)


def feature_rates(spark, sf):
    f = features.aggregate_events(contract_events(spark, sf), AS_OF, CUSTOMER_FEATURES)
    return rounded(f.select("customer_id", *RATES), 6, *RATES)


def feature_usage(spark, sf):
    f = features.aggregate_events(contract_events(spark, sf), AS_OF, CUSTOMER_FEATURES)
    return rounded(f.select("customer_id", *LEVELS), 6, *LEVELS[1:])


def feature_recency(spark, sf):
    f = features.aggregate_events(contract_events(spark, sf), AS_OF, CUSTOMER_FEATURES)
    return f.select("customer_id", "days_since_last_activity")


def feature_snapshot(spark, sf):
    return _rounded(_snapshot(spark, sf).drop("_built_at"))


ATTRIBUTES = ", ".join(CUSTOMER_FEATURES.attributes)
FEATURE_SNAPSHOT_SQL = f"""
WITH {ONE_DATE}, {CUSTOMER_SNAPSHOTS},
latest AS (SELECT * FROM snap WHERE snapshot_date <= DATE '{AS_OF}'
           QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY snapshot_date DESC) = 1),
g AS ({FINISHED})
SELECT g.*, {', '.join('latest.' + a for a in CUSTOMER_FEATURES.attributes)}, DATE '{AS_OF}' AS snapshot_date
FROM g LEFT JOIN latest USING (customer_id)"""


def attributes_as_of(spark, sf):
    return features.attributes_as_of(customer_snapshots(spark, sf), CUSTOMER_FEATURES, date(2022, 6, 30))


ORDER_FEATURES = FeatureSpec(
    entity="o_custkey",
    ts="o_orderdate",
    kind="o_orderstatus",
    event_id="o_orderkey",
    windows=(30, 90, 180),
    counts=(Count("finished", "F"), Count("urgent_open", "O", "o_orderpriority", "1-URGENT"), Count("open", "O")),
    ratios=(Ratio("urgent_share", "urgent_open", "open"),),
    level=Level("F", "o_totalprice", "last_price", "mean_price", "prior_price", "price_delta_pct", 180),
    recency="days_since_order",
)


def feature_snapshot_orders(spark, sf):
    f = features.aggregate_events(load(spark, sf, "orders"), date(1998, 1, 1), ORDER_FEATURES)
    shares = [f"urgent_share_{d}d" for d in ORDER_FEATURES.windows]
    return rounded(f, 6, "mean_price", "prior_price", "price_delta_pct", *shares)


def _orders_sql() -> str:
    cut = "DATE '1998-01-01'"
    conditions = {
        "finished": "o_orderstatus = 'F'",
        "urgent_open": "o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'",
        "open": "o_orderstatus = 'O'",
    }
    cols = [
        f"count(*) FILTER (WHERE {c} AND o_orderdate >= {cut} - {d}) AS {n}_{d}d"
        for d in (30, 90, 180)
        for n, c in conditions.items()
    ]
    finished = "o_orderstatus = 'F'"
    shares = ", ".join(
        f"CASE WHEN open_{d}d > 0 THEN round(urgent_open_{d}d / open_{d}d, 6) END AS urgent_share_{d}d"
        for d in (30, 90, 180)
    )
    return f"""
WITH f AS (
  SELECT o_custkey, {', '.join(cols)},
         arg_max(o_totalprice, (o_orderdate, o_orderkey)) FILTER (WHERE {finished}) AS last_price,
         avg(o_totalprice) FILTER (WHERE {finished} AND o_orderdate >= {cut} - 180) AS mean_price,
         avg(o_totalprice) FILTER (WHERE {finished} AND o_orderdate >= {cut} - 360 AND o_orderdate < {cut} - 180) AS prior_price,
         CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), {cut}) AS INTEGER) AS days_since_order
  FROM orders WHERE o_orderdate < {cut} + 1 GROUP BY o_custkey)
SELECT * REPLACE (round(mean_price, 6) AS mean_price, round(prior_price, 6) AS prior_price),
       CASE WHEN prior_price > 0 THEN round((mean_price - prior_price) / prior_price * 100, 6) END AS price_delta_pct,
       {shares}
FROM f"""


BACKFILL_START, BACKFILL_END = date(2024, 1, 5), date(2024, 1, 28)
BACKFILL_DATES = (
    f"d AS (SELECT CAST(range AS DATE) AS snapshot_date FROM range(DATE '{BACKFILL_START}', "
    f"DATE '{BACKFILL_END}' + INTERVAL 1 DAY, INTERVAL 1 DAY))"
)
BACKFILL_CTES = (
    f"{CONTRACT_EVENTS}, {BACKFILL_DATES}, "
    f"f AS ({snapshot_sql('ev, d', 'snapshot_date', 'customer_id, snapshot_date')})"
)


def _backfilled(spark, sf):
    return features.feature_snapshots(contract_events(spark, sf), BACKFILL_START, BACKFILL_END)


def backfill_snapshots(spark, sf):
    return _rounded(_backfilled(spark, sf).drop("_built_at"))


def backfill_attributes(spark, sf):
    rows = _backfilled(spark, sf).select("customer_id", "snapshot_date", "days_since_last_activity")
    return features.attributes_for_dates(rows, customer_snapshots(spark, sf), CUSTOMER_FEATURES)


BACKFILL_ATTRIBUTES_SQL = f"""
WITH {BACKFILL_CTES}, {CUSTOMER_SNAPSHOTS}
SELECT f.customer_id, f.snapshot_date, f.days_since_last_activity, {ATTRIBUTES}
FROM (SELECT customer_id, snapshot_date, days_since_last_activity FROM f) f
ASOF LEFT JOIN (SELECT customer_id AS cid, snapshot_date AS sd, {ATTRIBUTES} FROM snap) s
  ON f.customer_id = s.cid AND f.snapshot_date >= s.sd"""

LABELS = labels.LabelSpec(horizon=3)
LABEL_DATE = date(2024, 1, 10)
TODAY = date(2024, 1, 25)


def delayed_labels(spark, sf):
    e = contract_events(spark, sf)
    snapshot = features.aggregate_events(e, LABEL_DATE, CUSTOMER_FEATURES).select("customer_id")
    return labels.delayed_labels(e, snapshot, LABEL_DATE, TODAY, LABELS).drop("_labeled_at")


DELAYED_LABELS_SQL = f"""
WITH {CONTRACT_EVENTS},
pop AS (SELECT DISTINCT customer_id FROM ev WHERE event_ts < DATE '2024-01-11'),
hit AS (SELECT DISTINCT customer_id FROM ev WHERE event_type = 'cancellation'
        AND event_ts >= DATE '2024-01-11' AND event_ts < DATE '2024-01-14')
SELECT customer_id, CASE WHEN hit.customer_id IS NULL THEN 0 ELSE 1 END AS churned,
       DATE '2024-01-10' AS snapshot_date, 3 AS label_horizon_days, DATE '2024-01-13' AS maturity_date
FROM pop LEFT JOIN hit USING (customer_id)"""


def _mature(spark, sf):
    e = contract_events(spark, sf)
    return labels.mature_labels(e, _backfilled(spark, sf).select("customer_id", "snapshot_date"), TODAY, LABELS)


def mature_labels(spark, sf):
    return _mature(spark, sf).drop("_labeled_at")


MATURE_LABELS = f"""
{BACKFILL_CTES},
hits AS (SELECT DISTINCT customer_id, snapshot_date FROM ev JOIN d
           ON event_ts >= snapshot_date + 1 AND event_ts < snapshot_date + 4 WHERE event_type = 'cancellation'),
lab AS (
  SELECT customer_id, CASE WHEN hits.customer_id IS NULL THEN 0 ELSE 1 END AS churned, snapshot_date,
         3 AS label_horizon_days, snapshot_date + 3 AS maturity_date
  FROM (SELECT DISTINCT customer_id, snapshot_date FROM f) p LEFT JOIN hits USING (customer_id, snapshot_date)
  WHERE snapshot_date <= DATE '2024-01-22')"""


def _training(spark, sf):
    return labels.training_set(_backfilled(spark, sf).drop("_built_at"), _mature(spark, sf))


def training_dataset(spark, sf):
    return _rounded(_training(spark, sf))


TRAINING_SQL = f"""
WITH {MATURE_LABELS}, g AS ({FINISHED})
SELECT g.*, churned, label_horizon_days, maturity_date FROM g JOIN lab USING (customer_id, snapshot_date)"""


def label_counts(spark, sf):
    return labels.label_counts(_mature(spark, sf))


def late_snapshot_dates(spark, sf):
    e = contract_events(spark, sf)
    arrival = e.withColumn("ingestion_timestamp", F.date_add(F.to_date("event_ts"), F.col("k") % 4))
    return labels.late_snapshot_dates(
        arrival, _backfilled(spark, sf).select("snapshot_date"), reach_days=90
    )


LATE_SQL = f"""
WITH {CONTRACT_EVENTS}, {BACKFILL_DATES},
late AS (SELECT CAST(event_ts AS DATE) AS happened, CAST(event_ts AS DATE) + k % 4 AS arrived FROM ev)
SELECT snapshot_date, count(*) AS late_events FROM late JOIN d
  ON happened <= snapshot_date AND arrived > snapshot_date AND snapshot_date <= happened + 90
GROUP BY snapshot_date"""

def _arrivals(spark, sf):
    e = contract_events(spark, sf)
    days = F.when(F.col("k") < 10, 40).otherwise(F.col("k") % 4)  # some arrive after any lookback
    return e.withColumn("ingestion_timestamp", F.date_add(F.to_date("event_ts"), days).cast("timestamp"))


def stale_snapshot_dates(spark, sf):
    built = _backfilled(spark, sf).withColumn("_built_at", F.date_add("snapshot_date", 30).cast("timestamp"))
    return labels.stale_snapshot_dates(_arrivals(spark, sf), built)


STALE_SQL = f"""
WITH {CONTRACT_EVENTS}, {BACKFILL_DATES},
a AS (SELECT CAST(event_ts AS DATE) AS day,
        CAST(CAST(event_ts AS DATE) + CASE WHEN k < 10 THEN 40 ELSE k % 4 END AS TIMESTAMP) AS arrived FROM ev)
SELECT snapshot_date, CAST(snapshot_date + 30 AS TIMESTAMP) AS built_at, max(arrived) AS newest_event
FROM d JOIN a ON day <= snapshot_date GROUP BY snapshot_date HAVING max(arrived) > CAST(snapshot_date + 30 AS TIMESTAMP)"""


def stale_label_dates(spark, sf):
    made = _mature(spark, sf).withColumn("_labeled_at", F.date_add("maturity_date", 20).cast("timestamp"))
    return labels.stale_label_dates(_arrivals(spark, sf), made, labels.LabelSpec(horizon=3))


STALE_LABEL_SQL = f"""
WITH {MATURE_LABELS}, m AS (SELECT DISTINCT snapshot_date, CAST(maturity_date + 20 AS TIMESTAMP) AS labeled_at FROM lab),
a AS (SELECT CAST(event_ts AS DATE) AS day,
        CAST(CAST(event_ts AS DATE) + CASE WHEN k < 10 THEN 40 ELSE k % 4 END AS TIMESTAMP) AS arrived
      FROM ev WHERE event_type = 'cancellation')
SELECT snapshot_date, labeled_at, max(arrived) AS newest_event
FROM m JOIN a ON day > snapshot_date AND day <= snapshot_date + 3
GROUP BY ALL HAVING max(arrived) > labeled_at"""

QUERIES = {
    "stale_snapshot_dates": (stale_snapshot_dates, STALE_SQL),
    "stale_label_dates": (stale_label_dates, STALE_LABEL_SQL),
    "feature_counts": (
        feature_counts,
        f"WITH {ONE_DATE} SELECT customer_id, {', '.join(COUNT_NAMES)} FROM f",
    ),
    "feature_rates": (
        feature_rates,
        f"WITH {ONE_DATE}, g AS ({FINISHED}) SELECT customer_id, {', '.join(RATES)} FROM g",
    ),
    "feature_usage": (
        feature_usage,
        f"WITH {ONE_DATE}, g AS ({FINISHED}) SELECT customer_id, {', '.join(LEVELS)} FROM g",
    ),
    "feature_recency": (
        feature_recency,
        f"WITH {ONE_DATE} SELECT customer_id, days_since_last_activity FROM f",
    ),
    "feature_snapshot": (feature_snapshot, FEATURE_SNAPSHOT_SQL),
    "attributes_as_of": (
        attributes_as_of,
        f"WITH {CUSTOMER_SNAPSHOTS} SELECT customer_id, {ATTRIBUTES} FROM snap WHERE snapshot_date <= DATE '2022-06-30' "
        "QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY snapshot_date DESC) = 1",
    ),
    "feature_snapshot_orders": (feature_snapshot_orders, _orders_sql()),
    "backfill_snapshots": (backfill_snapshots, f"WITH {BACKFILL_CTES} {FINISHED}"),
    "backfill_attributes": (backfill_attributes, BACKFILL_ATTRIBUTES_SQL),
    "delayed_labels": (delayed_labels, DELAYED_LABELS_SQL),
    "mature_labels": (mature_labels, f"WITH {MATURE_LABELS} SELECT * FROM lab"),
    "training_dataset": (training_dataset, TRAINING_SQL),
    "label_counts": (
        label_counts,
        f"WITH {MATURE_LABELS} SELECT count(*) AS total_customers, count(*) FILTER (WHERE churned = 1) AS churned, "
        "round(avg(churned), 4) AS churn_rate FROM lab",
    ),
    "late_snapshot_dates": (late_snapshot_dates, LATE_SQL),
}
