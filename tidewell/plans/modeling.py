"""Train a candidate on the stored training set and score with a stored model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import governance, scoring, training
from tidewell.operators.mutation import latest_per_key
from tidewell.operators.runlog import track_run
from tidewell.plans import daily
from tidewell.sources.tables import TableStore, WriteResult

COMPARISON = "model_comparison_metrics"
IMPORTANCE = "shap_feature_importance"
VERSIONS = "model_versions"
ROW_KEY = "_row_key"


def model_path(store: TableStore, model_name: str, version: str) -> str:
    return store.path(f"models/{model_name}/{version}")


def train_candidate(
    store: TableStore,
    model_name: str,
    version: str,
    candidates: Sequence[training.Candidate] | None = None,
    label: str = "churned",
) -> training.TrainingResult:
    """Compare candidates on the training set, store the winner and its metric tables."""
    spark = store.spark
    with track_run(store, "train", f"train-v{version}") as run:
        data = daily.training_set(store).withColumn(ROW_KEY, F.concat_ws("@", "customer_id", "snapshot_date"))
        result = training.train_and_compare(data, label, ROW_KEY, candidates)
        result.model.save(model_path(store, model_name, version))
        store.overwrite(COMPARISON, training.comparison_frame(spark, result))
        store.overwrite(IMPORTANCE, training.feature_importances(spark, result.model, data, result.algorithm))
        store.append(daily.CANDIDATES, training.candidate_metrics_frame(spark, result, model_name, version))
        tag = [(model_name, str(version), governance.INFERENCE_CONTRACT)]
        store.append(
            VERSIONS,
            spark.createDataFrame(tag, "model_name string, model_version string, inference_contract string"),
        )
        run.output = {"model_version": version, "algorithm": result.algorithm, "candidates": len(result.comparison)}
    return result


def current_features(store: TableStore) -> DataFrame:
    """The newest feature row of each customer."""
    return latest_per_key(store.read(daily.FEATURES), ["customer_id"], ["snapshot_date"])


def score_with_champion(store: TableStore, model_name: str, scoring_run_id: str) -> WriteResult:
    """Score the newest feature rows with the stored champion model."""
    champion = daily.champion_for_scoring(store, model_name)
    model = PipelineModel.load(model_path(store, model_name, champion.model_version))
    scored = training.with_probability(model, current_features(store))
    prediction = scoring.prediction_struct(
        F.col(training.PROBABILITY), float(champion.classification_threshold)
    )
    return daily.score_batch(store, prediction, scoring_run_id, model_name, scored)
