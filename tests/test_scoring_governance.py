from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.operators import governance, scoring
from tidewell.operators.governance import INFERENCE_CONTRACT
from tidewell.plans import reports

PAIR_DDL = (
    "model_name string, candidate_version string, candidate_contract string, candidate_pr_auc double, "
    "candidate_recall double, candidate_positive_rate double, champion_version string, champion_contract string, "
    "champion_pr_auc double, champion_recall double"
)
# candidate pr/recall/positive rate, champion pr/recall, contract upgrade, expected reason
CASES = [
    (0.70, 0.75, 0.25, None, None, False, governance.FIRST_OK),
    (0.45, 0.75, 0.25, None, None, False, governance.FIRST_REJECTED),
    (0.70, 0.75, None, None, None, False, governance.NO_BASELINE),
    (0.70, 0.75, 0.0, None, None, False, governance.NO_BASELINE),
    (0.70, 0.55, 0.25, None, None, False, governance.FIRST_REJECTED),
    (0.73, 0.78, None, 0.70, 0.79, False, governance.LATER_OK),
    (0.705, 0.80, None, 0.70, 0.79, False, governance.NO_IMPROVEMENT),
    (0.75, 0.70, None, 0.70, 0.80, False, governance.RECALL_LOSS),
    (0.70, 0.79, None, 0.70, 0.79, True, governance.UPGRADE_OK),
    (0.69, 0.80, None, 0.70, 0.79, True, governance.NO_IMPROVEMENT),
    (0.70, 0.76, None, 0.70, 0.79, True, governance.RECALL_LOSS),
    (0.71, 0.79, None, 0.70, 0.79, False, governance.LATER_OK),  # 0.71 - 0.70 is just below 0.01 as a double
]


def test_promotion_truth_table(spark):
    rows = []
    for i, (pr, rec, pos, cpr, crec, upgrade, _) in enumerate(CASES):
        old = None if cpr is None else ("" if upgrade else INFERENCE_CONTRACT)
        rows.append(("m", str(i), INFERENCE_CONTRACT, pr, rec, pos, None if cpr is None else "0", old, cpr, crec))
    decided = governance.promotion_decisions(spark.createDataFrame(rows, PAIR_DDL)).collect()
    got = {int(r.candidate_version): r for r in decided}
    for i, case in enumerate(CASES):
        assert got[i].decision_reason == case[-1], i
        approved = case[-1] in (governance.FIRST_OK, governance.LATER_OK, governance.UPGRADE_OK)
        assert got[i].decision == ("APPROVED" if approved else "REJECTED")
        assert got[i].previous_champion_version == ("" if case[3] is None else "0")
    assert tuple(decided[0].asDict()) == governance.AUDIT_COLUMNS


def test_missing_metrics_fail_the_job(spark):
    versions = spark.createDataFrame([("1", INFERENCE_CONTRACT)], "model_version string, inference_contract string")
    metrics = spark.createDataFrame(
        [("1", 0.7, 0.7, 0.2, date(2026, 1, 1))],
        "model_version string, test_pr_auc double, test_recall double, test_positive_rate double, trained_at date",
    )
    ddl = "model_name string, candidate_version string, champion_version string"
    for row, message in ((("m", "2", None), "candidate version 2"), (("m", "1", "9"), "champion version 9")):
        pairs = governance.candidate_pairs(spark.createDataFrame([row], ddl), versions, metrics)
        with pytest.raises(Exception, match=message):
            pairs.collect()


@pytest.fixture
def registry(spark, store):
    """Versions 1 and 2 with metrics, 3 legacy, 4 without metrics; 2 is the champion."""
    store.overwrite(
        "model_versions",
        spark.createDataFrame(
            [("churn", v, "" if v == "3" else INFERENCE_CONTRACT) for v in "1234"],
            "model_name string, model_version string, inference_contract string",
        ),
    )
    rows = [(v, 0.6 + int(v) / 100, 0.7, 0.2, 0.4, "forest", f"run-{v}", datetime(2026, 1, int(v))) for v in "123"]
    rows.append(("1", 0.5, 0.5, 0.2, 0.4, "forest", "old", datetime(2025, 1, 1)))
    store.overwrite(
        "model_candidate_metrics",
        spark.createDataFrame(
            rows,
            "model_version string, test_pr_auc double, test_recall double, test_positive_rate double, "
            "classification_threshold double, selected_algorithm string, run_id string, trained_at timestamp",
        ),
    )
    return store


def test_promote_roll_back_and_promote_again(registry):
    from tidewell.plans import daily

    first = daily.promote(registry, "churn", "1", evaluated_at=datetime(2026, 2, 1))
    assert (first.decision, first.previous_champion_version) == ("APPROVED", "")
    second = daily.promote(registry, "churn", "2", evaluated_at=datetime(2026, 2, 2))
    assert (second.decision, second.previous_champion_version) == ("APPROVED", "1")
    assert registry.read("model_validation_metrics").first().model_version == "2"

    for target, message in (("", "required"), ("9", "Unknown"), ("3", "Incompatible"), ("4", "No metrics"), ("2", "already")):
        with pytest.raises(governance.RollbackRejected, match=message):
            governance.roll_back(registry, "churn", target)
    assert registry.read("model_promotion_history").count() == 2

    assert governance.roll_back(registry, "churn", "1", datetime(2026, 2, 3)) == "2"
    champion = governance.current_champion(registry.read("model_promotion_history")).first()
    assert (champion.champion_version, champion.champion_pr_auc) == ("1", 0.61)
    again = daily.promote(registry, "churn", "2", evaluated_at=datetime(2026, 2, 4))
    assert (again.decision, again.previous_champion_version) == ("APPROVED", "1")
    kpis = reports.governance_kpis(registry.read("model_promotion_history")).first()
    assert (kpis.champion_version, kpis.total_promotions) == ("2", 3)
    listed = reports.promotion_history(registry.read("model_promotion_history")).orderBy("position").collect()
    assert [(r.position, r.candidate_version, r.decision) for r in listed] == [
        (1, "2", "APPROVED"), (2, "1", "ROLLBACK"), (3, "2", "APPROVED"), (4, "1", "APPROVED")
    ]
    assert reports.promotion_history(registry.read("model_promotion_history"), ["ROLLBACK"]).first().position == 1
    pairs = reports.contract_compatibility(registry.read("model_promotion_history")).collect()
    assert sum(r.approved for r in pairs) == 3 and all(r.latest is not None for r in pairs)


def test_rejection_without_champion_blocks_scoring(registry, spark):
    from tidewell.plans import daily

    weak = registry.read("model_candidate_metrics").where("model_version = '1'").withColumn("test_recall", F.lit(0.1))
    registry.overwrite("model_candidate_metrics", spark.createDataFrame(weak.collect(), weak.schema))
    with pytest.raises(governance.PromotionBlocked):
        daily.promote(registry, "churn", "1")
    assert registry.read("model_promotion_history").first().decision == "REJECTED"
    with pytest.raises(governance.PromotionBlocked):
        daily.champion_for_scoring(registry, "churn")


CUSTOMERS = "customer_id string, contract string, tenure int, monthly_charges double, x double"


def test_score_batch_is_idempotent(registry, spark):
    from tidewell.plans import daily

    daily.promote(registry, "churn", "1", evaluated_at=datetime(2026, 2, 1))
    people = spark.createDataFrame([("a", "m", 1, 10.0, 2.0), ("b", "y", 2, 20.0, -2.0)], CUSTOMERS)
    p = scoring.prediction_struct(scoring.logistic(F.col("x")), 0.4)
    for run_id, hour in (("r1", 1), ("r1", 2), ("r2", 3)):
        daily.score_batch(registry, p, run_id, "churn", people, datetime(2026, 3, 1, hour))
    history = registry.read("prediction_history")
    assert history.count() == 4 and history.where("scoring_run_id = 'r1'").select("scored_at").distinct().count() == 1
    current = {r.customer_id: r for r in spark.table("current_customer_churn_scores").collect()}
    assert {r.scoring_run_id for r in current.values()} == {"r2"}
    assert current["a"].risk_segment == "High" and current["b"].risk_segment == "Low"
    assert current["a"].annual_revenue_at_risk == pytest.approx(120 * current["a"].churn_probability)
    assert [f.name for f in scoring.history_schema()] == spark.table("current_customer_churn_scores").columns
    assert spark.table("current_customer_churn_scores").schema == scoring.history_schema()


def test_latest_run_tie_takes_the_higher_id(spark):
    rows = [("r1", datetime(2026, 1, 1)), ("r2", datetime(2026, 1, 1)), ("r0", datetime(2025, 1, 1))]
    df = spark.createDataFrame(rows, "scoring_run_id string, scored_at timestamp")
    assert scoring.current_scores(df).first().scoring_run_id == "r2"


def test_predictor_adapter(spark):
    df = spark.createDataFrame([(0.2,), (0.5,), (0.9,)], "probability double")
    score = scoring.predictor_udf(lambda features: features["probability"], 0.5)
    got = df.select(score(scoring.pack_features(df, ["probability"])).alias("p")).select("p.*").collect()
    assert [(r.churn_probability, r.churn_prediction) for r in got] == [(0.2, 0), (0.5, 1), (0.9, 1)]
    with pytest.raises(ValueError, match="missing"):
        scoring.pack_features(df, ["nope"])


def test_contributions_sum_to_distance_from_mean(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1.0, 3.0], "b": [0.0, 4.0]}))
    rows = {
        r.feature: r
        for r in scoring.contribution_summary(
            scoring.contributions(df, {"a": 2.0, "b": -1.0}, {"a": 2.0, "b": 2.0}), "linear"
        ).collect()
    }
    assert (rows["a"].mean_abs_shap, rows["a"].directional_mean_shap) == (2.0, 0.0)
    assert rows["b"].mean_abs_shap == 2.0


def test_reports_on_small_tables(spark):
    scores = spark.createDataFrame(
        [("a", 0.95, "High", 100.0, 1), ("b", 1.0, "High", 50.0, 1), ("c", 0.05, "Low", 1.0, 0)],
        "customer_id string, churn_probability double, risk_segment string, annual_revenue_at_risk double, churn_prediction int",
    )
    assert {r.bin: r.customers for r in reports.probability_histogram(scores).collect()} == {9: 2, 0: 1}
    assert [r.customer_id for r in reports.top_at_risk(scores, 2).collect()] == ["b", "a"]
    kpis = reports.score_kpis(scores).first()
    assert (kpis.high_risk, kpis.revenue_at_risk) == (2, 151.0)
    runs = spark.createDataFrame([], "task_name string, status string, duration_seconds double, started_at timestamp")
    assert reports.run_kpis(runs).first().success_rate is None


def test_models_that_share_version_numbers(spark):
    metrics = spark.createDataFrame(
        [("A", "1", 0.9, 0.8, 0.2, "2026-01-01"), ("B", "1", 0.1, 0.2, 0.2, "2026-01-02"), ("A", "1", 0.3, 0.8, 0.2, "2025-01-01")],
        "model_name string, model_version string, test_pr_auc double, test_recall double, test_positive_rate double, trained_at string",
    )
    versions = spark.createDataFrame(
        [("A", "1", governance.INFERENCE_CONTRACT), ("B", "1", "older")], "model_name string, model_version string, inference_contract string"
    )
    wanted = spark.createDataFrame([("A", "1", None), ("B", "1", None)], "model_name string, candidate_version string, champion_version string")
    pairs = {r.model_name: r for r in governance.candidate_pairs(wanted, versions, metrics).collect()}
    assert len(pairs) == 2
    assert (pairs["A"].candidate_pr_auc, pairs["A"].candidate_contract) == (0.9, governance.INFERENCE_CONTRACT)
    assert (pairs["B"].candidate_pr_auc, pairs["B"].candidate_contract) == (0.1, "older")
