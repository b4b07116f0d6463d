"""Reporting queries bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import bands
from tidewell.operators import conform, runlog
from tidewell.operators.mutation import latest_per_key
from tidewell.plans import daily, reports
from tidewell.session import scratch_path, stage
from tidewell.sources.tables import TableStore
from workload import snapshots
from workload.tables import CUSTOMER_SNAPSHOTS, contract_events, customer_snapshots, load, rounded
from workload.snapshots import MATURE_LABELS


def segment_summary(spark, sf):
    s = conform.segment_summary(customer_snapshots(spark, sf))
    return rounded(s, 6, "avg_monthly_charge", "avg_tenure")


def current_state_summary(spark, sf):
    """The same summary from a stored table of current states, which five batches of snapshots went into, the newest first."""
    store = TableStore(spark, scratch_path(spark, "current"))
    snap = stage(customer_snapshots(spark, sf), "snapshots")
    part = F.pmod(F.year("snapshot_date"), F.lit(5))
    for n in (4, 3, 2, 1, 0):
        batch = latest_per_key(snap.where(part == n), ["customer_id"], ["snapshot_date"])
        daily.merge_current(store, batch, buckets=4)
    s = conform.segment_summary(store.read(daily.CURRENT), snapshot_date=None)
    return rounded(s, 6, "avg_monthly_charge", "avg_tenure")


SEGMENT_SQL = f"""
WITH {CUSTOMER_SNAPSHOTS},
latest AS (SELECT * FROM snap QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY snapshot_date DESC) = 1)
SELECT contract, internet_service, payment_method, count(*) AS customers, CAST(sum(churn_label) AS BIGINT) AS churned_customers,
       round(avg(churn_label), 4) AS churn_rate, round(avg(monthly_charges), 6) AS avg_monthly_charge, round(avg(tenure), 6) AS avg_tenure
FROM latest GROUP BY contract, internet_service, payment_method"""


def customer_kpis(spark, sf):
    k = reports.customer_kpis(customer_snapshots(spark, sf), snapshots._mature(spark, sf))
    return rounded(k, 6, "avg_tenure", "avg_monthly_charges", "churn_rate")


CUSTOMER_KPIS_SQL = f"""
WITH {MATURE_LABELS}, {CUSTOMER_SNAPSHOTS}
SELECT count(DISTINCT customer_id) AS total_customers, round(avg(tenure), 6) AS avg_tenure,
       round(avg(monthly_charges), 6) AS avg_monthly_charges,
       (SELECT round(count(*) FILTER (WHERE churned = 1) / count(*), 6) FROM lab) AS churn_rate FROM snap"""


def charge_histogram(spark, sf):
    return reports.binned_by_label(customer_snapshots(spark, sf), "monthly_charges", 20, 5, "churn_label")


def quantity_histogram(spark, sf):
    li = load(spark, sf, "lineitem")
    return reports.binned_by_label(li, "l_quantity", 12, None, "l_returnflag")


def category_by_label(spark, sf):
    return reports.category_by_label(customer_snapshots(spark, sf), "contract", "churn_label")


def churn_rate_by_senior(spark, sf):
    return rounded(reports.rate_by(customer_snapshots(spark, sf), "senior_citizen", "churn_label"), 6, "rate")


def churn_rate_by_date(spark, sf):
    return rounded(reports.rate_by(snapshots._mature(spark, sf), "snapshot_date", "churned"), 6, "rate")


def class_shares(spark, sf):
    return rounded(reports.class_shares(snapshots._mature(spark, sf), "churned"), 6, "share")


CORRELATED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey")


def correlation_matrix(spark, sf):
    return rounded(reports.correlation_matrix(load(spark, sf, "lineitem"), CORRELATED), 6, "correlation")


_CELLS = " UNION ALL ".join(
    f"SELECT '{x}' AS feature_x, '{y}' AS feature_y, round(corr({x}, {y}), 6) AS correlation FROM lineitem"
    for x in CORRELATED
    for y in CORRELATED
)


def box_summary(spark, sf):
    usage = contract_events(spark, sf).withColumn("is_churn", (F.col("k") >= 70).cast("int"))
    return rounded(reports.box_summary(usage, "usage_gb", "is_churn"), 6, "minimum", "q1", "median", "q3", "maximum")


def recency_histogram(spark, sf):
    joined = snapshots._training(spark, sf)
    return reports.binned_by_label(joined, "days_since_last_activity", 1, None, "churned")


def complaint_flag_by_label(spark, sf):
    return reports.flag_by_label(snapshots._training(spark, sf), F.col("complaint_high_30d") > 0, "churned")


def behaviour_points(spark, sf):
    return reports.behaviour_points(
        snapshots._backfilled(spark, sf),
        snapshots._mature(spark, sf),
        ("support_call_count_30d", "complaint_count_30d"),
    )


def drift_history(spark, sf):
    """A drift table by month and order priority, measured from order prices."""
    o = load(spark, sf, "orders")
    psi = F.round(F.avg("o_totalprice") / 1000000, 6)
    measured = o.groupBy(
        F.trunc(F.to_date("o_orderdate"), "month").alias("snapshot_date"), F.col("o_orderpriority").alias("feature_name")
    ).agg(psi.alias("psi"))
    kind = F.when(F.col("feature_name") == "5-LOW", "prediction").otherwise("numeric")
    return measured.select("*", kind.alias("feature_type"), bands.alert_level(F.col("psi")).alias("alert_level"))


DRIFT_HISTORY = """
dm AS (SELECT *, CASE WHEN feature_name = '5-LOW' THEN 'prediction' ELSE 'numeric' END AS feature_type,
              CASE WHEN psi > 0.25 THEN 'significant' WHEN psi > 0.10 THEN 'moderate' ELSE 'none' END AS alert_level
       FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, o_orderpriority AS feature_name,
                    round(avg(o_totalprice) / 1000000, 6) AS psi FROM orders GROUP BY ALL))"""


def drift_kpis(spark, sf):
    return reports.drift_kpis(drift_history(spark, sf))


def psi_ranking(spark, sf):
    return reports.psi_ranking(drift_history(spark, sf)).select("rank", "snapshot_date", "feature_name", "psi", "alert_level")


def psi_trend(spark, sf):
    return reports.psi_trend(drift_history(spark, sf), 3)


def run_log(spark, sf):
    """A run log with one run per event."""
    k = F.get_json_object("props", "$.k").cast("int")
    return load(spark, sf, "events").select(
        F.col("event_type").alias("task_name"),
        F.format_string("run-%012d", "event_id").alias("run_id"),
        F.when(k < 80, "succeeded").when(k < 95, "failed").otherwise("skipped").alias("status"),
        F.col("ts").alias("started_at"),
        F.col("value").alias("duration_seconds"),
    )


RUN_LOG = """
runs AS (SELECT event_type AS task_name, 'run-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id,
                CASE WHEN k < 80 THEN 'succeeded' WHEN k < 95 THEN 'failed' ELSE 'skipped' END AS status,
                ts AS started_at, value AS duration_seconds
         FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""


def run_log_rows(spark, sf):
    """The stored log of one run per return flag, which counts its lines; that of R fails after counting."""
    store = TableStore(spark, scratch_path(spark, "runs"))
    counts = load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("orders"))
    for row in counts.orderBy("l_returnflag").collect():  # one row per return flag
        try:
            with runlog.track_run(store, "count_lines", row.l_returnflag) as run:
                run.output.update(lines=row.n, orders=row.orders)
                if row.l_returnflag.startswith("R"):
                    raise ValueError(f"{row.n} lines refused")
                run.status = "empty" if row.n == 0 else run.status
        except ValueError:
            pass
    logged = store.read(runlog.TABLE)
    timed = (F.col("finished_at") >= F.col("started_at")) & (F.col("duration_seconds") >= 0)
    return logged.select("task_name", "run_id", "status", "output_summary", "error_message", timed.alias("timed"))


RUN_LOG_ROWS = """
SELECT 'count_lines' AS task_name, l_returnflag AS run_id, CASE WHEN l_returnflag LIKE 'R%' THEN 'failed' ELSE 'succeeded' END AS status,
       CASE WHEN l_returnflag LIKE 'R%' THEN '{}' ELSE '{"lines": ' || count(*) || ', "orders": ' || count(DISTINCT l_orderkey) || '}' END AS output_summary,
       CASE WHEN l_returnflag LIKE 'R%' THEN count(*) || ' lines refused' ELSE '' END AS error_message, true AS timed
FROM lineitem GROUP BY l_returnflag"""


def run_kpis(spark, sf):
    return rounded(reports.run_kpis(run_log(spark, sf)), 6, "success_rate", "avg_duration")


def runs_by_day(spark, sf):
    return reports.runs_by_day(run_log(spark, sf))


def duration_trend(spark, sf):
    return rounded(reports.duration_trend(run_log(spark, sf)), 6, "avg_duration")


def recent_runs(spark, sf):
    return reports.recent_runs(run_log(spark, sf)).select("task_name", "run_id", "status", "duration_seconds")


def quality_history(spark, sf):
    """A quality-metric table per ship day and return flag."""
    return (
        load(spark, sf, "lineitem")
        .groupBy(F.col("l_shipdate").alias("evaluated_at"), F.col("l_returnflag").alias("rule_name"))
        .agg(F.count("*").alias("total_rows"), F.count_if(F.col("l_discount") < 0.08).alias("passing_rows"))
        .withColumn("violating_rows", F.col("total_rows") - F.col("passing_rows"))
        .withColumn("severity", F.when(F.col("rule_name") == "R", "quarantine").otherwise("warn"))
    )


QUALITY_HISTORY = """
qm AS (SELECT l_shipdate AS evaluated_at, l_returnflag AS rule_name, count(*) AS total_rows,
              count(*) FILTER (WHERE l_discount < 0.08) AS passing_rows, count(*) FILTER (WHERE NOT l_discount < 0.08) AS violating_rows,
              CASE WHEN l_returnflag = 'R' THEN 'quarantine' ELSE 'warn' END AS severity FROM lineitem GROUP BY ALL)"""


def pass_rate(spark, sf):
    return rounded(reports.pass_rate(quality_history(spark, sf)), 6, "pass_rate")


def pass_rate_by_day(spark, sf):
    return rounded(reports.pass_rate_by_day(quality_history(spark, sf)), 6, "pass_rate")


def violations_by_rule(spark, sf):
    return reports.violations_by_rule(quality_history(spark, sf))


QUERIES = {
    "segment_summary": (segment_summary, SEGMENT_SQL),
    "current_state_summary": (current_state_summary, SEGMENT_SQL),
    "customer_kpis": (customer_kpis, CUSTOMER_KPIS_SQL),
    "charge_histogram": (
        charge_histogram,
        f"WITH {CUSTOMER_SNAPSHOTS} SELECT least(CAST(floor(monthly_charges / 20) AS INTEGER), 5) AS bin, churn_label AS label, "
        "count(*) AS customers FROM snap GROUP BY ALL",
    ),
    "quantity_histogram": (
        quantity_histogram,
        "SELECT CAST(floor(l_quantity / 12) AS INTEGER) AS bin, l_returnflag AS label, count(*) AS customers FROM lineitem GROUP BY ALL",
    ),
    "category_by_label": (
        category_by_label,
        f"WITH {CUSTOMER_SNAPSHOTS} SELECT contract AS category, churn_label AS label, count(*) AS customers FROM snap GROUP BY ALL",
    ),
    "churn_rate_by_senior": (
        churn_rate_by_senior,
        f"WITH {CUSTOMER_SNAPSHOTS} SELECT senior_citizen, count(*) AS \"rows\", count(*) FILTER (WHERE churn_label = 1) AS positives, "
        "round(avg(churn_label), 6) AS rate FROM snap GROUP BY senior_citizen",
    ),
    "churn_rate_by_date": (
        churn_rate_by_date,
        f"WITH {MATURE_LABELS} SELECT snapshot_date, count(*) AS \"rows\", count(*) FILTER (WHERE churned = 1) AS positives, "
        "round(avg(churned), 6) AS rate FROM lab GROUP BY snapshot_date",
    ),
    "class_shares": (
        class_shares,
        f"WITH {MATURE_LABELS} SELECT churned AS label, count(*) AS customers, round(count(*) / (SELECT count(*) FROM lab), 6) AS share "
        "FROM lab GROUP BY churned",
    ),
    "correlation_matrix": (correlation_matrix, _CELLS),
    "box_summary": (
        box_summary,
        f"WITH {snapshots.CONTRACT_EVENTS} SELECT CASE WHEN k >= 70 THEN 1 ELSE 0 END AS label, count(usage_gb) AS \"rows\", "
        "round(min(usage_gb), 6) AS minimum, round(quantile_cont(usage_gb, 0.25), 6) AS q1, round(quantile_cont(usage_gb, 0.5), 6) AS median, "
        "round(quantile_cont(usage_gb, 0.75), 6) AS q3, round(max(usage_gb), 6) AS maximum FROM ev GROUP BY ALL",
    ),
    "recency_histogram": (
        recency_histogram,
        f"WITH {MATURE_LABELS} SELECT CAST(days_since_last_activity AS INTEGER) AS bin, churned AS label, count(*) AS customers "
        "FROM f JOIN lab USING (customer_id, snapshot_date) GROUP BY ALL",
    ),
    "complaint_flag_by_label": (
        complaint_flag_by_label,
        f"WITH {MATURE_LABELS} SELECT churned AS label, complaint_high_30d > 0 AS flag, count(*) AS customers "
        "FROM f JOIN lab USING (customer_id, snapshot_date) GROUP BY ALL",
    ),
    "behaviour_points": (
        behaviour_points,
        f"WITH {MATURE_LABELS} SELECT customer_id, snapshot_date, support_call_count_30d, complaint_count_30d, churned "
        "FROM f JOIN lab USING (customer_id, snapshot_date)",
    ),
    "drift_kpis": (
        drift_kpis,
        f"WITH {DRIFT_HISTORY} SELECT count(*) FILTER (WHERE feature_type <> 'prediction') AS features_monitored, count(*) FILTER "
        "(WHERE alert_level = 'significant') AS significant_drift, count(*) FILTER (WHERE alert_level = 'moderate') AS moderate_drift, "
        "max(snapshot_date) AS latest_snapshot FROM dm",
    ),
    "psi_ranking": (
        psi_ranking,
        f"WITH {DRIFT_HISTORY} SELECT row_number() OVER (ORDER BY psi DESC NULLS LAST, feature_name, snapshot_date) AS rank, "
        "snapshot_date, feature_name, psi, alert_level FROM dm",
    ),
    "psi_trend": (
        psi_trend,
        f"WITH {DRIFT_HISTORY} SELECT snapshot_date, feature_name, psi FROM dm WHERE feature_name IN "
        "(SELECT feature_name FROM dm GROUP BY feature_name ORDER BY max(psi) DESC, feature_name LIMIT 3)",
    ),
    "run_kpis": (
        run_kpis,
        f"WITH {RUN_LOG} SELECT count(*) AS total_runs, round(count(*) FILTER (WHERE status = 'succeeded') / count(*), 6) AS success_rate, "
        "round(avg(duration_seconds), 6) AS avg_duration, count(*) FILTER (WHERE status = 'failed') AS failed_runs FROM runs",
    ),
    "run_log_rows": (run_log_rows, RUN_LOG_ROWS),
    "runs_by_day": (
        runs_by_day,
        f"WITH {RUN_LOG} SELECT CAST(started_at AS DATE) AS day, status, count(*) AS runs FROM runs GROUP BY ALL",
    ),
    "duration_trend": (
        duration_trend,
        f"WITH {RUN_LOG} SELECT CAST(started_at AS DATE) AS day, task_name, round(avg(duration_seconds), 6) AS avg_duration FROM runs GROUP BY ALL",
    ),
    "recent_runs": (
        recent_runs,
        f"WITH {RUN_LOG} SELECT task_name, run_id, status, duration_seconds FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 50",
    ),
    "pass_rate": (pass_rate, f"WITH {QUALITY_HISTORY} SELECT round(sum(passing_rows) / sum(total_rows), 6) AS pass_rate FROM qm"),
    "pass_rate_by_day": (
        pass_rate_by_day,
        f"WITH {QUALITY_HISTORY} SELECT CAST(evaluated_at AS DATE) AS day, round(sum(passing_rows) / sum(total_rows), 6) AS pass_rate "
        "FROM qm GROUP BY ALL",
    ),
    "violations_by_rule": (
        violations_by_rule,
        f"WITH {QUALITY_HISTORY} SELECT rule_name, severity, CAST(sum(violating_rows) AS BIGINT) AS violating_rows FROM qm GROUP BY ALL",
    ),
}
