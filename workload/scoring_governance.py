"""Scoring, prediction history, promotion, champion and rollback queries."""

from __future__ import annotations

from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidewell.functions import bands
from tidewell.operators import governance, mutation, scoring, training
from tidewell.plans import daily, reports
from tidewell.session import scratch_path, stage
from tidewell.sources.tables import TableStore
from workload.tables import (
    COEFFICIENTS,
    CUSTOMER_SNAPSHOTS,
    INTERCEPT,
    LINEAR_SQL,
    SCORED_ORDERS,
    THRESHOLD,
    customer_snapshots,
    load,
    rounded,
    scored_orders,
)

HISTORY_COLUMNS = ("customer_id", "churn_probability", "churn_prediction", "risk_segment", "annual_revenue_at_risk")


def _newest(spark, sf):
    return mutation.latest_per_key(customer_snapshots(spark, sf), ["customer_id"], ["snapshot_date"])


def _probability():
    return scoring.logistic(scoring.linear_score(COEFFICIENTS, INTERCEPT))


def _scored(df, run_id="run-1"):
    return scoring.score_customers(
        df, scoring.prediction_struct(_probability(), THRESHOLD), THRESHOLD, run_id, "linear", "churn", "3"
    )


def _score_sql(source: str, extra: str = "") -> str:
    return f"""
p AS (SELECT *, 1 / (1 + exp(-{LINEAR_SQL})) AS pr FROM {source}),
sc AS (SELECT {extra} customer_id, pr AS churn_probability, CAST(pr >= {THRESHOLD} AS INTEGER) AS churn_prediction,
         CASE WHEN pr >= {THRESHOLD} THEN 'High' WHEN pr >= {THRESHOLD} * 0.6 THEN 'Medium' ELSE 'Low' END AS risk_segment,
         contract, tenure, monthly_charges, monthly_charges * 12 * pr AS annual_revenue_at_risk FROM p)"""


NEWEST = (
    f"{CUSTOMER_SNAPSHOTS}, latest AS (SELECT * FROM snap QUALIFY row_number() OVER "
    "(PARTITION BY customer_id ORDER BY snapshot_date DESC) = 1)"
)
SCORES = f"{NEWEST}, {_score_sql('latest')}"
SCORE_ROW = (
    "SELECT customer_id, round(churn_probability, 9) AS churn_probability, churn_prediction, risk_segment, "
    "round(annual_revenue_at_risk, 6) AS annual_revenue_at_risk FROM sc"
)


def score_linear(spark, sf):
    scores = _scored(_newest(spark, sf)).select(*HISTORY_COLUMNS)
    return rounded(rounded(scores, 9, "churn_probability"), 6, "annual_revenue_at_risk")


def _predict(features: pd.DataFrame) -> np.ndarray:
    z = INTERCEPT + sum(w * features[name].to_numpy(dtype=float) for name, w in COEFFICIENTS.items())
    return 1.0 / (1.0 + np.exp(-z))


def score_predictor(spark, sf):
    """The same scores through a user's own vectorised predictor."""
    df = _newest(spark, sf)
    score = scoring.predictor_udf(_predict, THRESHOLD)
    scores = scoring.score_customers(
        df, score(scoring.pack_features(df, list(COEFFICIENTS))), THRESHOLD, "run-1", "linear", "churn", "3"
    ).select(*HISTORY_COLUMNS)
    return rounded(rounded(scores, 9, "churn_probability"), 6, "annual_revenue_at_risk")


def risk_segments(spark, sf):
    """Risk bands of all order scores at t = 0.5."""
    labelled = scored_orders(spark, sf).withColumn("risk_segment", bands.risk_segment(F.least("score", F.lit(1.0)), 0.5))
    return labelled.groupBy("model_version", "risk_segment").agg(F.count("*").alias("orders"))


def score_kpis(spark, sf):
    k = reports.score_kpis(_scored(_newest(spark, sf)))
    return rounded(rounded(k, 6, "churn_rate", "avg_probability"), 2, "revenue_at_risk")


def probability_histogram(spark, sf):
    return reports.probability_histogram(_scored(_newest(spark, sf)))


def revenue_at_risk(spark, sf):
    s = reports.risk_summary(_scored(_newest(spark, sf)))
    return rounded(rounded(s, 6, "average_churn_probability"), 2, "annual_revenue_at_risk")


def contract_by_segment(spark, sf):
    return reports.segment_by(_scored(_newest(spark, sf)))


def top_at_risk(spark, sf):
    top = reports.top_at_risk(_scored(_newest(spark, sf)))
    return rounded(rounded(top, 9, "churn_probability"), 6, "annual_revenue_at_risk")


def _history(spark, sf):
    """One scoring run per snapshot month over all customer snapshots of that month."""
    snap = customer_snapshots(spark, sf)
    scored = _scored(snap.withColumn("customer_id", F.concat_ws("@", "customer_id", "snapshot_date")))
    day = F.to_date(F.substring_index("customer_id", "@", -1))
    return scored.withColumn("scored_at", day).withColumn(
        "scoring_run_id", F.concat(F.lit("run-"), F.date_format(day, "yyyy-MM"))
    )


def current_scores(spark, sf):
    current = scoring.current_scores(_history(spark, sf)).select("scoring_run_id", *HISTORY_COLUMNS)
    return rounded(rounded(current, 9, "churn_probability"), 6, "annual_revenue_at_risk")


def current_scores_by_run(spark, sf):
    """The history stored by run, one run after the other and one of them again; the latest read through the index."""
    store = TableStore(spark, scratch_path(spark, "runs"))
    scored = stage(_history(spark, sf), "scored")
    daily.store_predictions(store, scored)
    daily.store_predictions(store, scored.where(F.col("scoring_run_id") == "run-2020-01"))
    current = daily.current_predictions(store).select("scoring_run_id", *HISTORY_COLUMNS)
    return rounded(rounded(current, 9, "churn_probability"), 6, "annual_revenue_at_risk")


CURRENT_SQL = f"""
WITH {CUSTOMER_SNAPSHOTS}, tagged AS (SELECT * REPLACE (customer_id || '@' || snapshot_date AS customer_id) FROM snap),
{_score_sql("tagged", "'run-' || strftime(snapshot_date, '%Y-%m') AS scoring_run_id, snapshot_date AS scored_at,")}
SELECT scoring_run_id, customer_id, round(churn_probability, 9) AS churn_probability, churn_prediction, risk_segment,
       round(annual_revenue_at_risk, 6) AS annual_revenue_at_risk FROM sc
WHERE scoring_run_id = (SELECT scoring_run_id FROM sc GROUP BY scoring_run_id ORDER BY max(scored_at) DESC, scoring_run_id DESC LIMIT 1)"""


def contribution_summary(spark, sf):
    snap = customer_snapshots(spark, sf)
    means = snap.agg(*[F.avg(c).alias(c) for c in COEFFICIENTS]).first().asDict()
    summary = scoring.contribution_summary(scoring.contributions(snap, COEFFICIENTS, means), "linear")
    return rounded(summary, 6, "mean_abs_shap", "directional_mean_shap")


CONTRIBUTION_SQL = f"WITH {CUSTOMER_SNAPSHOTS} SELECT feature, round(avg(abs(v)), 6) AS mean_abs_shap, " + (
    "round(avg(v), 6) + 0.0 AS directional_mean_shap, 'linear' AS selected_algorithm FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {w} * ({c} - (SELECT avg({c}) FROM snap)) AS v FROM snap"
        for c, w in COEFFICIENTS.items()
    )
    + ") GROUP BY feature"
)

# Governance


def model_metrics(spark, sf):
    """Candidate metrics per (priority, year), trained twice a year, measured from orders."""
    o = load(spark, sf, "orders").select(
        "o_orderpriority",
        F.year("o_orderdate").alias("year"),
        F.when(F.quarter("o_orderdate") > 2, 2).otherwise(1).alias("half"),
        F.to_date("o_orderdate").alias("day"),
        "o_totalprice",
        "o_orderstatus",
    )
    version = F.concat_ws("/", "o_orderpriority", "year")
    return o.groupBy(version.alias("model_version"), "half").agg(
        F.first("o_orderpriority").alias("model_name"),
        F.round(F.avg("o_totalprice") / 400000, 4).alias("test_pr_auc"),
        F.round(F.avg((F.col("o_orderstatus") != "P").cast("double")), 4).alias("test_recall"),
        F.round(F.avg((F.col("o_orderstatus") == "F").cast("double")) - 0.05, 4).alias("test_positive_rate"),
        F.max("day").alias("trained_at"),
    )


def model_versions(spark, sf):
    """All versions with their contract; the first year has a legacy one."""
    v = model_metrics(spark, sf).select("model_name", "model_version").distinct()
    year = F.substring_index("model_version", "/", -1).cast("int")
    tag = F.when(year > 1995, governance.INFERENCE_CONTRACT).otherwise("")
    return v.withColumn("inference_contract", tag)


MODELS = """
mm AS (
  SELECT o_orderpriority || '/' || year(o_orderdate) AS model_version, CASE WHEN quarter(o_orderdate) > 2 THEN 2 ELSE 1 END AS half,
         o_orderpriority AS model_name, round(avg(o_totalprice) / 400000, 4) AS test_pr_auc,
         round(avg(CASE WHEN o_orderstatus <> 'P' THEN 1.0 ELSE 0.0 END), 4) AS test_recall,
         round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) - 0.05, 4) AS test_positive_rate,
         CAST(max(o_orderdate) AS DATE) AS trained_at
  FROM orders GROUP BY ALL),
lm AS (SELECT * FROM mm QUALIFY row_number() OVER (PARTITION BY model_version ORDER BY trained_at DESC) = 1),
mv AS (SELECT DISTINCT model_name, model_version,
              CASE WHEN CAST(right(model_version, 4) AS INTEGER) > 1995 THEN 'churn_probability_v1' ELSE '' END AS inference_contract FROM mm)"""


def _pairs(spark, sf):
    v = model_versions(spark, sf)
    year = F.substring_index("model_version", "/", -1).cast("int")
    before = F.concat_ws("/", "model_name", (year - 1).cast("string"))
    requests = v.select(
        "model_name",
        F.col("model_version").alias("candidate_version"),
        F.when(year > 1995, before).alias("champion_version"),
    )
    return governance.candidate_pairs(requests, v, model_metrics(spark, sf))


def _decisions(spark, sf):
    return governance.promotion_decisions(_pairs(spark, sf), evaluated_at=F.lit(date(2001, 9, 1)))


def _audit(spark, sf):
    """Decisions dated by the end of the candidate's year."""
    year = F.substring_index("candidate_version", "/", -1).cast("int")
    return _decisions(spark, sf).withColumn("evaluated_at", F.make_date(year + 1, F.lit(1), F.lit(1)))


def promotion_decisions(spark, sf):
    return _decisions(spark, sf)


DECISIONS = f"""
{MODELS},
pairs AS (
  SELECT v.model_name, v.model_version AS candidate_version, b.model_version AS champion_version, v.inference_contract AS cc,
         coalesce(b.inference_contract, '') AS oc, c.test_pr_auc AS cp, c.test_recall AS cr, c.test_positive_rate AS pos,
         h.test_pr_auc AS hp, h.test_recall AS hr
  FROM mv v JOIN lm c ON c.model_version = v.model_version
  LEFT JOIN mv b ON b.model_version = v.model_name || '/' || (CAST(right(v.model_version, 4) AS INTEGER) - 1)
  LEFT JOIN lm h ON h.model_version = b.model_version),
up AS (SELECT *, cc = 'churn_probability_v1' AND oc <> 'churn_probability_v1' AS upgrade FROM pairs),
why AS (SELECT *, CASE
    WHEN champion_version IS NULL THEN CASE WHEN NOT coalesce(pos > 0, false) THEN '{governance.NO_BASELINE}'
      WHEN cp / pos >= 2.0 AND cr >= 0.60 THEN '{governance.FIRST_OK}' ELSE '{governance.FIRST_REJECTED}' END
    WHEN cp - hp < CASE WHEN upgrade THEN 0.0::DOUBLE ELSE 0.01::DOUBLE END - 1e-12 THEN '{governance.NO_IMPROVEMENT}'
    WHEN hr - cr > 0.02::DOUBLE THEN '{governance.RECALL_LOSS}'
    WHEN upgrade THEN '{governance.UPGRADE_OK}' ELSE '{governance.LATER_OK}' END AS reason FROM up),
aud AS (SELECT model_name, candidate_version, coalesce(champion_version, '') AS previous_champion_version,
    cc AS candidate_inference_contract, oc AS previous_champion_inference_contract, upgrade AS contract_upgrade,
    cp AS candidate_pr_auc, cr AS candidate_recall, hp AS champion_pr_auc, hr AS champion_recall,
    CASE WHEN reason IN ('{governance.FIRST_OK}', '{governance.UPGRADE_OK}', '{governance.LATER_OK}') THEN 'APPROVED' ELSE 'REJECTED' END AS decision,
    reason AS decision_reason, make_date(CAST(right(candidate_version, 4) AS INTEGER) + 1, 1, 1) AS evaluated_at FROM why)"""


def champion_resolution(spark, sf):
    return governance.current_champion(_audit(spark, sf))


CHAMPION = """
champ AS (SELECT model_name, candidate_version AS champion_version, candidate_inference_contract AS champion_contract,
                 candidate_pr_auc AS champion_pr_auc, candidate_recall AS champion_recall, evaluated_at AS champion_since
          FROM aud WHERE decision IN ('APPROVED', 'ROLLBACK')
          QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY evaluated_at DESC, candidate_version DESC) = 1)"""


def champion_metrics(spark, sf):
    rows = governance.champion_rows(_audit(spark, sf), model_metrics(spark, sf))
    return rows.drop("half")


def _checks(spark, sf):
    """A rollback request to every version, plus one unknown version per model."""
    v = model_versions(spark, sf)
    wanted = v.select("model_name", F.col("model_version").alias("target_version"))
    unknown = v.select("model_name", F.concat_ws("/", "model_name", F.lit("none")).alias("target_version")).distinct()
    return governance.rollback_checks(
        wanted.unionByName(unknown), v, model_metrics(spark, sf), governance.current_champion(_audit(spark, sf))
    )


def rollback_validation(spark, sf):
    return _checks(spark, sf).select("model_name", "target_version", "champion_version", "problem")


CHECKS = f"""
{DECISIONS}, {CHAMPION},
req AS (SELECT model_name, model_version AS target_version, inference_contract AS tc, true AS known FROM mv
        UNION ALL SELECT DISTINCT model_name, model_name || '/none', NULL, false FROM mv),
chk AS (SELECT req.model_name, target_version, champion_version, champion_contract, tc, t.test_pr_auc AS tp, t.test_recall AS tr,
               q.test_pr_auc AS qp, q.test_recall AS qr,
               CASE WHEN NOT known THEN 'Unknown model version ' || target_version
                    WHEN tc <> 'churn_probability_v1' THEN 'Incompatible inference contract of version ' || target_version
                    WHEN champion_version IS NULL THEN 'There is no champion to roll back.'
                    WHEN champion_version = target_version THEN 'Champion already is version ' || target_version END AS problem
        FROM req LEFT JOIN champ USING (model_name) LEFT JOIN lm t ON t.model_version = target_version
        LEFT JOIN lm q ON q.model_version = champion_version)"""


def rollback_audit(spark, sf):
    return governance.rollback_audit(_checks(spark, sf), F.lit(date(2002, 6, 1)))


ROLLBACK_SQL = f"""
WITH {CHECKS}
SELECT model_name, target_version AS candidate_version, champion_version AS previous_champion_version,
       tc AS candidate_inference_contract, coalesce(champion_contract, '') AS previous_champion_inference_contract,
       false AS contract_upgrade, tp AS candidate_pr_auc, tr AS candidate_recall, qp AS champion_pr_auc, qr AS champion_recall,
       'ROLLBACK' AS decision,
       'Champion alias rolled back from version ' || champion_version || ' to version ' || target_version || '.' AS decision_reason,
       DATE '2002-06-01' AS evaluated_at
FROM chk WHERE problem IS NULL"""


def governance_kpis(spark, sf):
    return reports.governance_kpis(_audit(spark, sf))


def metrics_by_version(spark, sf):
    return reports.metrics_by_version(_audit(spark, sf))


def promotion_history(spark, sf):
    return reports.promotion_history(_audit(spark, sf))


def rejected_candidates(spark, sf):
    return reports.promotion_history(_audit(spark, sf), ["REJECTED"]).select("position", "candidate_version", "decision_reason")


def contract_compatibility(spark, sf):
    return reports.contract_compatibility(_audit(spark, sf))


def candidate_selection(spark, sf):
    """Per model: the half-year candidate with the best (PR-AUC, F1)."""
    m = model_metrics(spark, sf).select(
        "model_name",
        F.concat_ws("#", "model_version", "half").alias("algorithm"),
        F.round("test_pr_auc", 2).alias("validation_pr_auc"),
        F.col("test_recall").alias("validation_best_f1"),
    )
    return training.select_winner(m, ["model_name"])


QUERIES = {
    "score_linear": (score_linear, f"WITH {SCORES} {SCORE_ROW}"),
    "score_predictor": (score_predictor, f"WITH {SCORES} {SCORE_ROW}"),
    "risk_segments": (
        risk_segments,
        f"WITH {SCORED_ORDERS} SELECT model_version, CASE WHEN least(score, 1) >= 0.5 THEN 'High' WHEN least(score, 1) >= 0.3 "
        "THEN 'Medium' ELSE 'Low' END AS risk_segment, count(*) AS orders FROM so GROUP BY ALL",
    ),
    "score_kpis": (
        score_kpis,
        f"WITH {SCORES} SELECT count(*) AS total_customers, round(avg(churn_prediction), 6) AS churn_rate, "
        "round(avg(churn_probability), 6) AS avg_probability, count(*) FILTER (WHERE risk_segment = 'High') AS high_risk, "
        "round(sum(annual_revenue_at_risk), 2) AS revenue_at_risk FROM sc",
    ),
    "probability_histogram": (
        probability_histogram,
        f"WITH {SCORES} SELECT least(CAST(floor(churn_probability * 10) AS INTEGER), 9) AS bin, count(*) AS customers FROM sc GROUP BY ALL",
    ),
    "revenue_at_risk": (
        revenue_at_risk,
        f"WITH {SCORES} SELECT risk_segment, count(*) AS customers, round(avg(churn_probability), 6) AS average_churn_probability, "
        "round(sum(annual_revenue_at_risk), 2) AS annual_revenue_at_risk FROM sc GROUP BY risk_segment",
    ),
    "contract_by_segment": (
        contract_by_segment,
        f"WITH {SCORES} SELECT contract, risk_segment, count(*) AS customers FROM sc GROUP BY ALL",
    ),
    "top_at_risk": (
        top_at_risk,
        f"WITH {SCORES} SELECT customer_id, round(churn_probability, 9) AS churn_probability, risk_segment, contract, tenure, "
        "monthly_charges, round(annual_revenue_at_risk, 6) AS annual_revenue_at_risk FROM "
        "(SELECT * FROM sc ORDER BY churn_probability DESC, customer_id LIMIT 20)",
    ),
    "current_scores": (current_scores, CURRENT_SQL),
    "current_scores_by_run": (current_scores_by_run, CURRENT_SQL),
    "contribution_summary": (contribution_summary, CONTRIBUTION_SQL),
    "promotion_decisions": (
        promotion_decisions,
        f"WITH {DECISIONS} SELECT * REPLACE (DATE '2001-09-01' AS evaluated_at) FROM aud",
    ),
    "champion_resolution": (champion_resolution, f"WITH {DECISIONS}, {CHAMPION} SELECT * FROM champ"),
    "champion_metrics": (
        champion_metrics,
        f"WITH {DECISIONS} SELECT lm.* EXCLUDE (half), evaluated_at AS promoted_at, 'Champion' AS model_alias "
        "FROM lm JOIN aud ON aud.candidate_version = lm.model_version WHERE decision = 'APPROVED'",
    ),
    "rollback_validation": (
        rollback_validation,
        f"WITH {CHECKS} SELECT model_name, target_version, champion_version, problem FROM chk",
    ),
    "rollback_audit": (rollback_audit, ROLLBACK_SQL),
    "governance_kpis": (
        governance_kpis,
        f"WITH {DECISIONS} SELECT arg_max(candidate_version, (evaluated_at, candidate_version)) FILTER (WHERE decision = 'APPROVED') AS champion_version, "
        "arg_max(candidate_pr_auc, (evaluated_at, candidate_version)) FILTER (WHERE decision = 'APPROVED') AS latest_pr_auc, "
        "arg_max(candidate_recall, (evaluated_at, candidate_version)) FILTER (WHERE decision = 'APPROVED') AS latest_recall, "
        "count(*) FILTER (WHERE decision = 'APPROVED') AS total_promotions FROM aud",
    ),
    "metrics_by_version": (
        metrics_by_version,
        f"WITH {DECISIONS} SELECT candidate_version, candidate_pr_auc, champion_pr_auc, candidate_recall, contract_upgrade FROM aud",
    ),
    "promotion_history": (
        promotion_history,
        f"WITH {DECISIONS} SELECT row_number() OVER (ORDER BY evaluated_at DESC NULLS LAST, model_name, candidate_version) AS position, model_name, "
        + ", ".join(reports.HISTORY)
        + " FROM aud",
    ),
    "rejected_candidates": (
        rejected_candidates,
        f"WITH {DECISIONS} SELECT row_number() OVER (ORDER BY evaluated_at DESC NULLS LAST, model_name, candidate_version) AS position, "
        "candidate_version, decision_reason FROM aud WHERE decision = 'REJECTED'",
    ),
    "contract_compatibility": (
        contract_compatibility,
        f"WITH {DECISIONS} SELECT model_name, candidate_inference_contract, previous_champion_inference_contract, contract_upgrade, "
        "count(DISTINCT candidate_version) AS versions, count(*) FILTER (WHERE decision = 'APPROVED') AS approved, "
        "max(evaluated_at) AS latest FROM aud GROUP BY ALL",
    ),
    "candidate_selection": (
        candidate_selection,
        f"WITH {MODELS}, c AS (SELECT model_name, model_version || '#' || half AS algorithm, round(test_pr_auc, 2) AS validation_pr_auc, "
        "test_recall AS validation_best_f1 FROM mm) SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY model_name "
        "ORDER BY validation_pr_auc DESC, validation_best_f1 DESC, algorithm DESC) = 1",
    ),
}
