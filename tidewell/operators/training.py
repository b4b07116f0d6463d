"""Preprocessing, candidate comparison and feature contributions with Spark ML.

Data stays on the executors. The driver holds model parameters only: one imputation
value per feature, one metric row per candidate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import evaluation, split
from tidewell.operators.cells import CellFits
from tidewell.operators.drift import unpivot
from tidewell.operators.ordering import exact_quantiles, global_rank
from tidewell.session import scratch_path, stage

NOT_FEATURES = ("customer_id", "churn", "churn_label", "churned", "snapshot_date", "_transformed_at",
                "_built_at", "label_horizon_days", "maturity_date", "fold")
WEIGHT = "_weight"
PROBABILITY = "churn_probability"
#: Values that a text column may have to be one-hot encoded.
MAX_CATEGORIES = 1000


class TrainingError(ValueError):
    """The training data cannot support a classifier."""


class TooManyCategories(TrainingError):
    """A text column has more values than one-hot encoding is meant for."""


def feature_columns(df: DataFrame, excluded: Sequence[str] = NOT_FEATURES) -> tuple[list[str], list[str]]:
    """Columns to learn from as (numeric, categorical), by type."""
    wanted = [f for f in df.schema if f.name not in excluded]
    numeric = [f.name for f in wanted if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    return numeric, [f.name for f in wanted if isinstance(f.dataType, T.StringType)]


def median_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per numeric column as (feature, fill)."""
    medians = exact_quantiles(unpivot(df, columns, "double"), ["feature"], "value", [0.5])
    return medians.select("feature", F.get("quantiles", F.lit(0)).alias("fill"))


def most_frequent_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per text column as (feature, fill); the smallest wins ties."""
    counts = unpivot(df, columns, "string").groupBy("feature", "value").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), "value"))
    return counts.groupBy("feature").agg(best["value"].alias("fill"))


@dataclass(frozen=True)
class Imputation:
    """Fill values per column, learned on the training fold only."""

    numbers: Mapping[str, float]
    texts: Mapping[str, str]

    def as_stage(self) -> SQLTransformer:
        """A pipeline stage that adds ``<name>_filled`` columns, so a saved model carries its fills."""
        filled = [
            f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {float(v)!r}D) AS `{c}_filled`"
            for c, v in self.numbers.items()
        ]
        for c, v in self.texts.items():
            quoted = v.replace("\\", "\\\\").replace("'", "\\'")
            filled.append(f"coalesce(`{c}`, '{quoted}') AS `{c}_filled`")
        return SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")

    def apply(self, df: DataFrame) -> DataFrame:
        return self.as_stage().transform(df)


def learn_imputation(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Imputation:
    """Medians and most frequent values; one collected row per column."""
    numbers = {r.feature: r.fill for r in median_values(train, numeric).collect()} if numeric else {}
    texts = {r.feature: r.fill for r in most_frequent_values(train, categorical).collect()} if categorical else {}
    return Imputation(
        {c: numbers.get(c, 0.0) for c in numeric}, {c: texts.get(c, "Unknown") for c in categorical}
    )


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n, code): values of each text column coded from 0 by falling count, then by value.

    Coded by ranges over all columns together: a column may have any number of values. Nulls have no code.
    """
    counts = unpivot(df, columns, "string").groupBy("feature", "value").agg(F.count("*").alias("n"))
    ranked = global_rank(counts, [F.col("feature").asc(), F.col("n").desc(), F.col("value").asc()])
    # One row per column of the table.
    first = ranked.groupBy("feature").agg(F.min("position").alias("_first"))
    coded = ranked.join(F.broadcast(first), "feature")
    return coded.select("feature", "value", "n", (F.col("position") - F.col("_first")).cast("int").alias("code"))


def encode_categories(df: DataFrame, codes: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Add ``<column>_code`` by a join with ``category_codes``; null for a value that has none."""
    of = codes.where(F.col("feature") == column).select(F.col("value").alias(column), F.col("code").alias(name or f"{column}_code"))
    return df.join(of, column, "left").select(*df.columns, name or f"{column}_code")


def category_labels(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """The values of each text column in the order of their codes.

    Raises ``TooManyCategories`` before any value is collected where a column has more than ``limit``.
    """
    if not columns:
        return {}
    codes = stage(category_codes(df, columns), "category-codes")
    for r in codes.groupBy("feature").agg(F.count("*").alias("values")).orderBy("feature").collect():
        if r["values"] > limit:
            raise TooManyCategories(f"column {r.feature} has {r['values']} values, more than the {limit} allowed")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in codes.orderBy("feature", "code").collect():  # at most ``limit`` rows per column
        found[r.feature].append(r.value)
    return found


def preprocessing_stages(numeric: Sequence[str], labels: Mapping[str, Sequence[str]]) -> list:
    """One-hot for texts by their ``labels`` (an unseen value encodes as all zeros) and standardised numbers."""
    stages: list = []
    parts: list[str] = []
    if labels:
        indexed = [f"{c}_index" for c in labels]
        encoded = [f"{c}_onehot" for c in labels]
        # A model per column: one model for several pads shorter lists with nulls.
        for (c, values), index in zip(labels.items(), indexed):
            stages.append(StringIndexerModel.from_labels(list(values), f"{c}_filled", index, handleInvalid="keep"))
        # The index of unseen values is the last one, which dropLast leaves out.
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True))
        parts += encoded
    if numeric:
        stages.append(VectorAssembler(inputCols=[f"{c}_filled" for c in numeric], outputCol="_numbers"))
        stages.append(StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True))
        parts.append("_scaled")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages


@dataclass(frozen=True)
class Candidate:
    """An estimator to compare. All of them take class weights against imbalance."""

    algorithm: str
    estimator: object
    imbalance_method: str = "class_weight_balanced"


def default_candidates(label: str, trees: int = 300, rounds: int = 300, seed: int = split.SEED) -> list[Candidate]:
    """Two forests of ``trees`` trees, ``rounds`` boosted trees and a linear model."""
    common = {"featuresCol": "features", "labelCol": label, "weightCol": WEIGHT}
    return [
        Candidate(
            "class_weighted_forest",
            RandomForestClassifier(numTrees=trees, maxDepth=10, seed=seed, subsamplingRate=1.0, **common),
        ),
        Candidate(
            "gradient_boosting",
            GBTClassifier(
                maxIter=rounds, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, seed=seed, **common
            ),
        ),
        Candidate(
            "forest_without_bootstrap",
            RandomForestClassifier(
                numTrees=trees, maxDepth=10, bootstrap=False, featureSubsetStrategy="onethird", seed=seed, **common
            ),
        ),
        Candidate("logistic_regression", LogisticRegression(regParam=0.01, **common)),
    ]


def single_tree(label: str, seed: int = split.SEED) -> Candidate:
    return Candidate(
        "decision_tree",
        DecisionTreeClassifier(featuresCol="features", labelCol=label, weightCol=WEIGHT, maxDepth=5, seed=seed),
    )


@dataclass
class TrainingResult:
    """The winner, its test metrics and one comparison row per candidate."""

    model: PipelineModel
    algorithm: str
    threshold: float
    comparison: list[dict] = field(default_factory=list)
    test_metrics: dict = field(default_factory=dict)

    def score(self, df: DataFrame) -> DataFrame:
        """Add the positive-class probability as a plain double."""
        return with_probability(self.model, df)


def with_probability(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the positive-class probability of a fitted model."""
    p = vector_to_array("probability").getItem(1)
    return model.transform(df).select(*df.columns, p.alias(PROBABILITY))


def _without_summary(fitted, spark):
    """Save a fitted classifier to the shared scratch folder and load it again.

    A loaded model has no training summary. A summary refers to the session, which
    cannot always be serialised with the tasks that score.
    """
    path = scratch_path(spark, "model")
    fitted.save(path)
    return type(fitted).load(path)


def _scored(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    """Label and probability, written once, so the model runs once per row.

    A filter on the probability would otherwise be pushed below it and evaluate the
    model again for each condition.
    """
    return stage(with_probability(model, df).select(label, PROBABILITY), "scored")


def balance_weights(positives: int, negatives: int, label: str) -> Column:
    """Weights under which both classes weigh the same and the mean weight is 1."""
    total = positives + negatives
    return F.when(F.col(label) == 1, F.lit(total / (2.0 * positives))).otherwise(F.lit(total / (2.0 * negatives)))


def train_and_compare(
    data: DataFrame,
    label: str,
    key: str,
    candidates: Sequence[Candidate] | None = None,
    excluded: Sequence[str] = NOT_FEATURES,
    seed: int = split.SEED,
    trained_at: datetime | None = None,
    max_categories: int = MAX_CATEGORIES,
) -> TrainingResult:
    """Fit every candidate, pick by (validation PR-AUC, F1), test only the winner.

    64/16/20 stratified folds; the threshold is the F1-best validation score.
    """
    spark = data.sparkSession
    numeric, categorical = feature_columns(data, [*excluded, key, label])
    if not numeric and not categorical:
        raise TrainingError("no feature columns")
    balance = evaluation.class_balance(data, label).first()
    if balance.classes != 2:
        raise TrainingError("training needs both classes")
    typed = data.withColumn(label, F.col(label).cast("int"))
    # Written once by fold: every later step reads only the fold it needs.
    folded = stage(split.stratified_split(typed, label, key, seed), "folds", ["fold"])
    train = folded.where(F.col("fold") == "train")
    sizes = evaluation.class_balance(train, label).first()
    if not sizes.positives or not sizes.negatives:
        raise TrainingError("the training fold lacks a class")
    imputation = learn_imputation(train, numeric, categorical)
    ready = imputation.apply(train).withColumn(WEIGHT, balance_weights(sizes.positives, sizes.negatives, label))
    validation = folded.where(F.col("fold") == "validation")
    test = folded.where(F.col("fold") == "test")

    stamp = trained_at or datetime.now(timezone.utc)
    filled = ready.select(*[F.col(f"{c}_filled").alias(c) for c in categorical])
    labels = category_labels(filled, categorical, max_categories)
    prepared = Pipeline(stages=preprocessing_stages(numeric, labels)).fit(ready)
    ready_vectors = prepared.transform(ready).select("features", label, WEIGHT).cache()
    fits = CellFits(ready_vectors, sizes.positives + sizes.negatives)
    rows, models = [], {}
    try:
        for c in candidates or default_candidates(label, seed=seed):
            classifier = fits.fit(c.estimator) or _without_summary(c.estimator.fit(ready_vectors), spark)
            fitted = PipelineModel(stages=[imputation.as_stage(), *prepared.stages, classifier])
            found = evaluation.ranking_metrics(
                _scored(fitted, validation, label), label, PROBABILITY
            ).first()
            models[c.algorithm] = fitted
            rows.append(
                {
                    "algorithm": c.algorithm,
                    "imbalance_method": c.imbalance_method,
                    "run_id": f"{c.algorithm}-{seed}",
                    "validation_pr_auc": found.pr_auc,
                    "validation_best_f1": found.best_f1,
                    "classification_threshold": found.threshold,
                    "selected": False,
                    "trained_at": stamp,
                }
            )
    finally:
        ready_vectors.unpersist()
    best = max(rows, key=lambda r: (r["validation_pr_auc"] or 0.0, r["validation_best_f1"]))
    best["selected"] = True
    model, threshold = models[best["algorithm"]], best["classification_threshold"]

    scored = _scored(model, test, label)
    ranking = evaluation.ranking_metrics(scored, label, PROBABILITY).first()
    counts = evaluation.confusion_metrics(scored, label, PROBABILITY, threshold).first()
    metrics = {
        "test_roc_auc": ranking.roc_auc,
        "test_pr_auc": ranking.pr_auc,
        "test_precision": counts.precision,
        "test_recall": counts.recall,
        "test_f1": counts.f1,
        "test_balanced_accuracy": counts.balanced_accuracy,
        "test_positive_rate": counts.positive_rate,
        "test_rows": counts.rows,
    }
    return TrainingResult(model, best["algorithm"], threshold, rows, metrics)


def select_winner(comparison: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The best candidate per group by (validation PR-AUC, F1), as a query over a metric table.

    The algorithm name breaks full ties, so the choice is stable.
    """
    rank = F.struct("validation_pr_auc", "validation_best_f1", "algorithm")
    best = F.max_by(F.struct(*[c for c in comparison.columns if c not in groups]), rank)
    picked = comparison.groupBy(*groups).agg(best.alias("_b")) if groups else comparison.agg(best.alias("_b"))
    return picked.select(*groups, "_b.*")


COMPARISON_SCHEMA = (
    "algorithm string, imbalance_method string, run_id string, validation_pr_auc double, "
    "validation_best_f1 double, classification_threshold double, selected boolean, trained_at timestamp"
)


def comparison_frame(spark, result: TrainingResult) -> DataFrame:
    """The comparison rows as a table, one per candidate."""
    names = [f.split()[0] for f in COMPARISON_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in result.comparison], COMPARISON_SCHEMA)


def candidate_metrics_frame(
    spark, result: TrainingResult, model_name: str, model_version: str
) -> DataFrame:
    """The winner's 18-column row for the candidate metrics table."""
    best = next(r for r in result.comparison if r["selected"])
    row = {
        "run_id": best["run_id"],
        "model_name": model_name,
        "model_version": str(model_version),
        "model_alias": "Candidate",
        "selected_algorithm": result.algorithm,
        "selection_metric": "validation_pr_auc",
        "validation_pr_auc": best["validation_pr_auc"],
        "validation_best_f1": best["validation_best_f1"],
        "trained_at": best["trained_at"],
        **{k: v for k, v in result.test_metrics.items() if k != "test_rows"},
        "test_rows": result.test_metrics["test_rows"],
        "classification_threshold": float(result.threshold),
    }
    types = {"test_rows": "bigint", "trained_at": "timestamp"}
    texts = ("run_id", "model_name", "model_version", "model_alias", "selected_algorithm", "selection_metric")
    ddl = ", ".join(f"{n} {types.get(n, 'string' if n in texts else 'double')}" for n in row)
    return spark.createDataFrame([tuple(row.values())], ddl)


def feature_importances(spark, model: PipelineModel, sample: DataFrame, algorithm: str) -> DataFrame:
    """Importance per vector slot of the fitted classifier, largest first.

    Trees report their split importances, linear models the size and sign of the
    weight of each standardised slot. ``sample`` only supplies the slot names; no row
    of it is read.
    """
    classifier = model.stages[-1]
    linear = hasattr(classifier, "coefficients")
    weights = (classifier.coefficients if linear else classifier.featureImportances).toArray().tolist()
    metadata = PipelineModel(stages=model.stages[:-1]).transform(sample).schema["features"].metadata
    slots = metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a.get("name", str(a["idx"])) for group in slots.values() for a in group}
    rows = [
        (names.get(i, f"slot_{i}"), abs(w), w if linear else None, algorithm) for i, w in enumerate(weights)
    ]
    frame = spark.createDataFrame(
        rows, "feature string, importance double, signed_weight double, selected_algorithm string"
    )
    return frame.orderBy(F.desc("importance"), "feature")
