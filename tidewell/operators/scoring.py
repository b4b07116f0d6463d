"""Batch scoring, risk output, prediction history and the current-score view."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import bands
from tidewell.sources.readers import require_columns

PREDICTION_TYPE = "struct<churn_probability:double,churn_prediction:long>"
HISTORY_KEY = ("scoring_run_id", "customer_id")


def logistic(score: Column) -> Column:
    return 1 / (1 + F.exp(-score))


def linear_score(coefficients: Mapping[str, float], intercept: float) -> Column:
    """w.x + b over columns; a null feature makes the score null."""
    total = F.lit(float(intercept))
    for name, weight in coefficients.items():
        total = total + F.lit(float(weight)) * F.col(f"`{name}`")
    return total


def prediction_struct(probability: Column, threshold: float) -> Column:
    """Probability and thresholded prediction as one struct column."""
    limit = F.lit(bands.check_threshold(threshold))
    return F.struct(
        probability.alias("churn_probability"),
        (probability >= limit).cast("long").alias("churn_prediction"),
    )


def predictor_udf(predict: Callable[[pd.DataFrame], Sequence[float]], threshold: float):
    """A vectorised UDF over a struct of features for a user's own predictor.

    ``predict`` maps a batch of feature rows to positive-class probabilities; it is
    called once per Arrow batch on the executors.
    """
    limit = bands.check_threshold(threshold)

    @F.pandas_udf(PREDICTION_TYPE)
    def score(features: pd.DataFrame) -> pd.DataFrame:
        probability = pd.Series(predict(features), dtype="float64")
        return pd.DataFrame(
            {"churn_probability": probability, "churn_prediction": (probability >= limit).astype("int64")}
        )

    return score


def pack_features(df: DataFrame, features: Sequence[str]) -> Column:
    """The model input as a struct, after checking that every feature is there."""
    require_columns(df, features, "scoring input")
    return F.struct(*[F.col(f"`{f}`") for f in features])


def score_customers(
    df: DataFrame,
    prediction: Column,
    threshold: float,
    scoring_run_id: str,
    algorithm: str,
    model_name: str,
    model_version: str,
    model_run_id: str = "",
    scored_at: datetime | None = None,
    strict: bool = True,
) -> DataFrame:
    """The 15 columns of the prediction history from a prediction struct column.

    ``df`` holds one row per customer; pass the newest snapshot of each.
    """
    limit = bands.check_threshold(threshold)
    scored = df.withColumn("_prediction", prediction)
    p = F.col("_prediction.churn_probability")
    return scored.select(
        F.lit(scoring_run_id).alias("scoring_run_id"),
        "customer_id",
        p.alias("churn_probability"),
        F.col("_prediction.churn_prediction").cast("int").alias("churn_prediction"),
        F.lit(limit).alias("classification_threshold"),
        bands.risk_segment(p, limit, strict).alias("risk_segment"),
        "contract",
        "tenure",
        "monthly_charges",
        (F.col("monthly_charges") * 12 * p).alias("annual_revenue_at_risk"),
        F.lit(algorithm).alias("selected_algorithm"),
        F.lit(model_name).alias("model_name"),
        F.lit(str(model_version)).alias("model_version"),
        F.lit(str(model_run_id)).alias("model_run_id"),
        (F.lit(scored_at).cast("timestamp") if scored_at else F.current_timestamp()).alias("scored_at"),
    )


def latest_run(history: DataFrame, run: str = "scoring_run_id", scored_at: str = "scored_at") -> DataFrame:
    """The run with the newest score, the highest id on ties, as a one-row frame."""
    return (
        history.groupBy(run)
        .agg(F.max(scored_at).alias("latest_scored_at"))
        .orderBy(F.desc("latest_scored_at"), F.desc(run))
        .limit(1)
        .select(run)
    )


def current_scores(history: DataFrame, run: str = "scoring_run_id", scored_at: str = "scored_at") -> DataFrame:
    """History rows of the latest run. The joined side has exactly one row."""
    return history.join(F.broadcast(latest_run(history, run, scored_at)), run, "left_semi")


def contributions(df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float]) -> DataFrame:
    """Long (feature, contribution): weight times distance from the feature's mean, per row."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                (F.lit(float(w)) * (F.col(f"`{name}`").cast("double") - F.lit(float(means[name])))).alias(
                    "contribution"
                ),
            )
            for name, w in coefficients.items()
        ]
    )
    return df.select(F.inline(pairs))


def contribution_summary(long: DataFrame, algorithm: str) -> DataFrame:
    """Mean absolute and mean signed contribution per feature, largest first."""
    return (
        long.groupBy("feature")
        .agg(
            F.avg(F.abs("contribution")).alias("mean_abs_shap"),
            F.avg("contribution").alias("directional_mean_shap"),
        )
        .withColumn("selected_algorithm", F.lit(algorithm))
        .orderBy(F.desc("mean_abs_shap"), "feature")
    )


def history_schema() -> T.StructType:
    """Schema of the prediction history."""
    text, number = T.StringType(), T.DoubleType()
    types = {
        "scoring_run_id": text, "customer_id": text, "churn_probability": number,
        "churn_prediction": T.IntegerType(), "classification_threshold": number,
        "risk_segment": text, "contract": text, "tenure": T.IntegerType(), "monthly_charges": number,
        "annual_revenue_at_risk": number, "selected_algorithm": text, "model_name": text,
        "model_version": text, "model_run_id": text, "scored_at": T.TimestampType(),
    }
    return T.StructType([T.StructField(n, t) for n, t in types.items()])
