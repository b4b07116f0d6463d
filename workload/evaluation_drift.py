"""Classifier evaluation, splits, quantiles and drift queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidewell.operators import drift, evaluation, ordering, split
from tidewell.session import scratch_path
from tidewell.sources.tables import TableStore
from workload.tables import (
    CONTRACT_EVENTS,
    CUSTOMER_SNAPSHOTS,
    LINEAR_SQL,
    SCORED_ORDERS,
    contract_events,
    customer_snapshots,
    load,
    rounded,
    scored_orders,
)
from workload.tables import COEFFICIENTS, INTERCEPT
from tidewell.operators.scoring import linear_score, logistic

CURVE = """
c AS (SELECT model_version, score AS threshold, count(*) FILTER (WHERE label = 1) AS pos,
             count(*) FILTER (WHERE label = 0) AS neg FROM so GROUP BY ALL),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER g AS p, sum(neg) OVER g AS n
          FROM c WINDOW w AS (PARTITION BY model_version ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING),
                        g AS (PARTITION BY model_version)),
pr AS (SELECT *, tp / (tp + fp) AS precision, tp / p AS recall FROM curve),
f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-12) AS f1 FROM pr)"""


def pr_curve(spark, sf):
    curve = evaluation.pr_curve(scored_orders(spark, sf), "label", "score", ["model_version"])
    return rounded(curve, 9, "precision", "recall", "f1")


def ranking_metrics(spark, sf):
    m = evaluation.ranking_metrics(scored_orders(spark, sf), "label", "score", ["model_version"])
    return rounded(m, 9, "pr_auc", "roc_auc", "best_f1")


def quality_label_metrics(spark, sf):
    """Ungrouped: document length as a score for the quality label."""
    d, y = load(spark, sf, "documents"), load(spark, sf, "labels")
    scored = d.join(y, "doc_id").select("quality", (F.col("n_chars") / 200000).alias("score"))
    m = evaluation.ranking_metrics(scored, "quality", "score")
    return rounded(m, 9, "pr_auc", "roc_auc", "best_f1")


def tied_scores_metrics(spark, sf):
    """Few distinct scores over many rows: all line items, one model per line status."""
    li = load(spark, sf, "lineitem").select(
        F.col("l_linestatus").alias("model_version"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.col("l_discount").alias("score"),
    )
    m = evaluation.ranking_metrics(li, "label", "score", ["model_version"])
    return rounded(m, 9, "pr_auc", "roc_auc", "best_f1")


METRICS = """
SELECT {group} round(sum(pos * precision) / max(p), 9) AS pr_auc,
       round(sum(neg * (tp - pos + pos / 2)) / (max(p) * max(n)), 9) AS roc_auc,
       arg_max(threshold, (f1, -threshold)) AS threshold, round(max(f1), 9) AS best_f1,
       CAST(max(p) AS BIGINT) AS positives, CAST(max(n) AS BIGINT) AS negatives FROM f {by}"""
GROUPED = METRICS.format(group="model_version,", by="GROUP BY model_version")


def best_threshold(spark, sf):
    found = evaluation.best_threshold(scored_orders(spark, sf), "label", "score", ["model_version"])
    return rounded(found, 9, "best_f1")


def confusion_metrics(spark, sf):
    m = evaluation.confusion_metrics(scored_orders(spark, sf), "label", "score", 0.3, ["model_version"])
    return rounded(m, 9, "precision", "recall", "f1", "balanced_accuracy", "positive_rate")


CONFUSION_SQL = f"""
WITH {SCORED_ORDERS}, k AS (
  SELECT model_version, count(*) FILTER (WHERE label = 1 AND score >= 0.3) AS tp,
         count(*) FILTER (WHERE label = 0 AND score >= 0.3) AS fp,
         count(*) FILTER (WHERE label = 1 AND score < 0.3) AS fn,
         count(*) FILTER (WHERE label = 0 AND score < 0.3) AS tn FROM so GROUP BY ALL)
SELECT *, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 9) AS balanced_accuracy,
       round((tp + fn) / (tp + fp + fn + tn), 9) AS positive_rate, tp + fp + fn + tn AS "rows" FROM k"""


def class_balance(spark, sf):
    return rounded(
        evaluation.class_balance(scored_orders(spark, sf), "label", ["model_version"]), 9, "scale_pos_weight"
    )


def stratified_split(spark, sf):
    folds = split.stratified_split(load(spark, sf, "orders"), "o_orderstatus", "o_orderkey")
    return folds.select("o_orderkey", "o_orderstatus", "fold")


STRATIFIED_SQL = """
WITH r AS (SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
                  row_number() OVER (PARTITION BY o_orderstatus ORDER BY sha256('996|' || o_orderkey), o_orderkey) AS i FROM orders)
SELECT o_orderkey, o_orderstatus,
       CASE WHEN i <= n * 64 // 100 THEN 'train' WHEN i <= n * 80 // 100 THEN 'validation' ELSE 'test' END AS fold FROM r"""


def exact_quantiles(spark, sf):
    q = ordering.exact_quantiles(
        load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", [i / 10 for i in range(11)]
    )
    return q.select(
        "l_returnflag", "l_linestatus", "n_values", F.posexplode("quantiles").alias("decile", "price")
    ).withColumn("price", F.round("price", 4))


QUANTILES_SQL = """
SELECT l_returnflag, l_linestatus, n AS n_values, CAST(i AS INTEGER) AS decile, round(q[i + 1], 4) AS price
FROM (SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n,
             quantile_cont(l_extendedprice, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS q
      FROM lineitem GROUP BY ALL), range(11) t(i)"""

# Drift

HALF = "2024-01-16"


def _halves(spark, sf):
    e = load(spark, sf, "events").withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("int"),
            "hour": F.hour("ts"),
            "small": F.when(F.col("value") < 5, F.floor("value")),
        }
    )
    first = F.col("ts") < F.lit(HALF).cast("timestamp_ntz")
    columns = ("value", "k", "hour", "small", "event_type")
    return e.where(first).select(*columns), e.where(~first).select(*columns)


HALVES = f"""
e AS (SELECT ts < TIMESTAMP '{HALF}' AS base, event_type, CAST(value AS DOUBLE) AS value,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(hour(ts) AS DOUBLE) AS "hour",
             CASE WHEN value < 5 THEN CAST(floor(value) AS DOUBLE) END AS small FROM events)"""


def numeric_sql(long: str) -> str:
    """PSI, KS, means and counts from ``long``, a query giving (feature_name, base, v)."""
    return f"""
l AS ({long}),
ed AS (SELECT feature_name, list_distinct(list_sort(quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS raw
       FROM l WHERE base GROUP BY feature_name),
e2 AS (SELECT feature_name, list_sort(raw) AS edges FROM ed),
b AS (SELECT l.feature_name, base, least(len([x for x in edges if x <= v]), len(edges) - 1) AS bin
      FROM l JOIN e2 USING (feature_name) WHERE v >= edges[1] AND v <= edges[-1]),
h AS (SELECT feature_name, bin, count(*) FILTER (WHERE base) AS nb, count(*) FILTER (WHERE NOT base) AS nc FROM b GROUP BY ALL),
s AS (SELECT feature_name, nb / sum(nb) OVER w + 1e-6 AS pb, nc / sum(nc) OVER w + 1e-6 AS pc FROM h WINDOW w AS (PARTITION BY feature_name)),
psi AS (SELECT feature_name, sum((pc - pb) * ln(pc / pb)) AS psi FROM s GROUP BY feature_name),
vc AS (SELECT feature_name, v, count(*) FILTER (WHERE base) AS nb, count(*) FILTER (WHERE NOT base) AS nc FROM l GROUP BY ALL),
cu AS (SELECT feature_name, sum(nb) OVER o / sum(nb) OVER g - sum(nc) OVER o / sum(nc) OVER g AS gap FROM vc
       WINDOW o AS (PARTITION BY feature_name ORDER BY v ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY feature_name)),
ks AS (SELECT feature_name, max(abs(gap)) AS ks FROM cu GROUP BY feature_name),
num AS (SELECT feature_name, 'numeric' AS feature_type, psi, ks AS ks_statistic, avg(v) FILTER (WHERE base) AS baseline_mean,
          avg(v) FILTER (WHERE NOT base) AS current_mean, count(*) FILTER (WHERE base) AS baseline_count,
          count(*) FILTER (WHERE NOT base) AS current_count
        FROM l JOIN psi USING (feature_name) JOIN ks USING (feature_name) GROUP BY ALL)"""


HALF_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature_name, base, {q} AS v FROM e WHERE {q} IS NOT NULL"
    for c, q in (("value", "value"), ("k", "k"), ("hour", '"hour"'), ("small", "small"))
)
ROUNDED_DRIFT = (
    "round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic, round(baseline_mean, 6) AS baseline_mean, "
    "round(current_mean, 6) AS current_mean"
)
ALERT = "CASE WHEN psi > 0.25 THEN 'significant' WHEN psi > 0.10 THEN 'moderate' ELSE 'none' END AS alert_level"


def _numeric(spark, sf):
    base, current = _halves(spark, sf)
    return drift.numeric_drift(base, current, ["value", "k", "hour", "small"])


def psi_numeric(spark, sf):
    return rounded(_numeric(spark, sf).select("feature_name", "psi"), 6, "psi")


def ks_statistic(spark, sf):
    return rounded(_numeric(spark, sf).select("feature_name", "ks_statistic"), 6, "ks_statistic")


def psi_categorical(spark, sf):
    """Language and source of documents that have labels against all others."""
    d, y = load(spark, sf, "documents"), load(spark, sf, "labels").select("doc_id")
    found = drift.categorical_drift(
        d.join(y, "doc_id", "left_semi"), d.join(y, "doc_id", "left_anti"), ["lang", "source"]
    )
    return rounded(found.select("feature_name", "psi", "baseline_count", "current_count"), 6, "psi")


def categorical_sql(long: str) -> str:
    """Categorical PSI from ``long``, a query giving (feature_name, base, v)."""
    return f"""
cl AS ({long}),
cc AS (SELECT feature_name, v, count(*) FILTER (WHERE base) AS nb, count(*) FILTER (WHERE NOT base) AS nc FROM cl GROUP BY ALL),
ct AS (SELECT *, nb / sum(nb) OVER w + 1e-6 AS pb, nc / sum(nc) OVER w + 1e-6 AS pc, sum(nb) OVER w AS tb, sum(nc) OVER w AS tc
       FROM cc WINDOW w AS (PARTITION BY feature_name)),
cat AS (SELECT feature_name, 'categorical' AS feature_type, sum((pc - pb) * ln(pc / pb)) AS psi, NULL::DOUBLE AS ks_statistic,
          NULL::DOUBLE AS baseline_mean, NULL::DOUBLE AS current_mean, CAST(max(tb) AS BIGINT) AS baseline_count,
          CAST(max(tc) AS BIGINT) AS current_count FROM ct GROUP BY feature_name)"""


def drift_report(spark, sf):
    base, current = _halves(spark, sf)
    return drift.drift_report(base, current, F.lit(date(2024, 1, 30))).drop("computed_at")


def drift_report_stored(spark, sf):
    """The same report from baseline counts that were stored in parts and merged; the baseline itself is not read."""
    base, current = _halves(spark, sf)
    store = TableStore(spark, scratch_path(spark, "baseline"))
    for part in (F.col("value") < 50, F.coalesce(F.col("value") >= 50, F.lit(True))):
        store.append("counts", drift.feature_counts(base.where(part)))
    counted = drift.CountedSample(store.read("counts"), base.schema)
    return drift.drift_report(counted, current, F.lit(date(2024, 1, 30))).drop("computed_at")


DRIFT_REPORT_SQL = f"""
WITH {HALVES}, {numeric_sql(HALF_LONG)},
{categorical_sql("SELECT 'event_type' AS feature_name, base, event_type AS v FROM e")},
u AS (SELECT * FROM num UNION ALL SELECT * FROM cat)
SELECT DATE '2024-01-30' AS snapshot_date, feature_name, feature_type, {ROUNDED_DRIFT}, baseline_count, current_count, {ALERT} FROM u"""


def drift_report_orders(spark, sf):
    """Orders of 1995-1997 as baseline against all later ones."""
    o = load(spark, sf, "orders").withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    columns = ("o_totalprice", "o_custkey", "o_orderstatus", "o_orderpriority")
    base, current = o.where(cut).select(*columns), o.where(~cut).select(*columns)
    return drift.drift_report(base, current, F.lit(date(2001, 8, 1))).drop("computed_at")


ORDERS_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature_name, o_orderdate < DATE '1998-01-01' AS base, CAST({c} AS DOUBLE) AS v FROM orders"
    for c in ("o_totalprice", "o_custkey")
)
ORDERS_CAT = " UNION ALL ".join(
    f"SELECT '{c}' AS feature_name, o_orderdate < DATE '1998-01-01' AS base, {c} AS v FROM orders"
    for c in ("o_orderstatus", "o_orderpriority")
)
DRIFT_ORDERS_SQL = f"""
WITH {numeric_sql(ORDERS_LONG)}, {categorical_sql(ORDERS_CAT)},
u AS (SELECT * FROM num UNION ALL SELECT * FROM cat)
SELECT DATE '2001-08-01' AS snapshot_date, feature_name, feature_type, {ROUNDED_DRIFT}, baseline_count, current_count, {ALERT} FROM u"""


def prediction_drift(spark, sf):
    """Labels of the customer snapshots against the scores of the linear model."""
    snap = customer_snapshots(spark, sf)
    scores = snap.select(logistic(linear_score(COEFFICIENTS, INTERCEPT)).alias("churn_probability"))
    found = drift.prediction_drift(snap, scores, F.lit(date(2024, 1, 20)), label="churn_label")
    return found.drop("computed_at")


PREDICTION_LONG = (
    "SELECT '_prediction_churn_probability' AS feature_name, true AS base, CAST(churn_label AS DOUBLE) AS v FROM snap "
    f"UNION ALL SELECT '_prediction_churn_probability', false, 1 / (1 + exp(-{LINEAR_SQL})) FROM snap"
)
PREDICTION_DRIFT_SQL = f"""
WITH {CUSTOMER_SNAPSHOTS}, {numeric_sql(PREDICTION_LONG)}
SELECT DATE '2024-01-20' AS snapshot_date, feature_name, 'prediction' AS feature_type, {ROUNDED_DRIFT},
       baseline_count, current_count, {ALERT} FROM num"""


def newest_partition(spark, sf):
    return drift.latest_date(customer_snapshots(spark, sf))


QUERIES = {
    "pr_curve": (
        pr_curve,
        f"WITH {SCORED_ORDERS}, {CURVE} SELECT model_version, threshold, round(precision, 9) AS precision, "
        "round(recall, 9) AS recall, round(f1, 9) AS f1 FROM f",
    ),
    "ranking_metrics": (ranking_metrics, f"WITH {SCORED_ORDERS}, {CURVE} {GROUPED}"),
    "quality_label_metrics": (
        quality_label_metrics,
        "WITH so AS (SELECT 1 AS model_version, quality AS label, n_chars / 200000 AS score FROM documents JOIN labels USING (doc_id)), "
        f"{CURVE} {METRICS.format(group='', by='')}",
    ),
    "tied_scores_metrics": (
        tied_scores_metrics,
        "WITH so AS (SELECT l_linestatus AS model_version, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, "
        f"l_discount AS score FROM lineitem), {CURVE} {GROUPED}",
    ),
    "best_threshold": (
        best_threshold,
        f"WITH {SCORED_ORDERS}, {CURVE} SELECT model_version, arg_max(threshold, (f1, -threshold)) AS threshold, "
        "round(max(f1), 9) AS best_f1 FROM f GROUP BY model_version",
    ),
    "confusion_metrics": (confusion_metrics, CONFUSION_SQL),
    "class_balance": (
        class_balance,
        f"WITH {SCORED_ORDERS} SELECT model_version, count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER "
        "(WHERE label = 0) AS negatives, count(DISTINCT label) AS classes, round(count(*) FILTER (WHERE label = 0) / "
        "count(*) FILTER (WHERE label = 1), 9) AS scale_pos_weight FROM so GROUP BY ALL",
    ),
    "stratified_split": (stratified_split, STRATIFIED_SQL),
    "exact_quantiles": (exact_quantiles, QUANTILES_SQL),
    "psi_numeric": (psi_numeric, f"WITH {HALVES}, {numeric_sql(HALF_LONG)} SELECT feature_name, round(psi, 6) AS psi FROM num"),
    "ks_statistic": (
        ks_statistic,
        f"WITH {HALVES}, {numeric_sql(HALF_LONG)} SELECT feature_name, round(ks_statistic, 6) AS ks_statistic FROM num",
    ),
    "psi_categorical": (
        psi_categorical,
        "WITH d AS (SELECT *, doc_id IN (SELECT doc_id FROM labels) AS base FROM documents), "
        + categorical_sql(
            "SELECT 'lang' AS feature_name, base, lang AS v FROM d UNION ALL SELECT 'source', base, source FROM d"
        )
        + " SELECT feature_name, round(psi, 6) AS psi, baseline_count, current_count FROM cat",
    ),
    "drift_report": (drift_report, DRIFT_REPORT_SQL),
    "drift_report_stored": (drift_report_stored, DRIFT_REPORT_SQL),
    "drift_report_orders": (drift_report_orders, DRIFT_ORDERS_SQL),
    "prediction_drift": (prediction_drift, PREDICTION_DRIFT_SQL),
    "newest_partition": (
        newest_partition,
        f"WITH {CUSTOMER_SNAPSHOTS} SELECT max(snapshot_date) AS snapshot_date FROM snap",
    ),
}
