"""Trees grown on counted cells against those that Spark ML grows on the rows."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewell.operators import cells, training

SHARED = {"featuresCol": "features", "labelCol": "label", "weightCol": "w", "seed": 7}


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(3000):
        a, b, k, m = float(np.floor(rng.normal() * 50)), float(rng.integers(0, 6)), "xyz"[rng.integers(0, 3)], "pq"[rng.integers(0, 2)]
        odds = a / 40 + 2 * (k == "x") * (b > 2) - (m == "p")
        y = int(rng.random() < 1 / (1 + np.exp(-odds)))
        rows.append((a, b, k, m, y, 1.5 if y else 0.75))
    df = spark.createDataFrame(rows, "a double, b double, k string, m string, label int, w double")
    stages = [StringIndexer(inputCols=["k", "m"], outputCols=["ki", "mi"]), OneHotEncoder(inputCols=["ki", "mi"], outputCols=["ko", "mo"], dropLast=False)]
    stages.append(VectorAssembler(inputCols=["ko", "mo", "a", "b"], outputCol="features"))
    return Pipeline(stages=stages).fit(df).transform(df).select("features", "label", "w").cache()


def on_cells(estimator, vectors):
    assert cells.supports(estimator)
    thresholds = cells.find_thresholds(estimator, vectors)
    return cells.fit_cells(estimator, vectors, thresholds, cells.count_cells(estimator, vectors, thresholds).cache())


def scores(model, vectors):
    return np.array([r.p for r in model.transform(vectors).select(vector_to_array("probability")[1].alias("p")).collect()])


def test_without_draws_the_model_is_that_of_spark(vectors):
    forest = RandomForestClassifier(numTrees=2, maxDepth=6, bootstrap=False, featureSubsetStrategy="all", **SHARED)
    boosting = GBTClassifier(maxIter=5, maxDepth=4, stepSize=0.1, **SHARED)
    for estimator in (forest, boosting):
        there, here = estimator.fit(vectors), on_cells(estimator, vectors)
        assert here.totalNumNodes == there.totalNumNodes and here.treeWeights == there.treeWeights and type(here) is type(there)
        assert scores(here, vectors) == pytest.approx(scores(there, vectors), abs=1e-12)


def test_with_draws_the_model_is_alike_and_goes_by_cells_alone(vectors):
    forest = RandomForestClassifier(numTrees=40, maxDepth=8, **SHARED)
    thirds = RandomForestClassifier(numTrees=40, maxDepth=8, bootstrap=False, featureSubsetStrategy="onethird", **SHARED)
    boosting = GBTClassifier(maxIter=10, maxDepth=4, stepSize=0.1, subsamplingRate=0.8, **SHARED)
    for estimator, least in ((forest, 0.98), (thirds, 0.98), (boosting, 0.95)):
        there, here = scores(estimator.fit(vectors), vectors), scores(on_cells(estimator, vectors), vectors)
        assert abs(here - there).mean() < 0.06 and np.corrcoef(here, there)[0, 1] > least
        assert (scores(on_cells(estimator, vectors.repartition(3, "label")), vectors) == here).all()


def test_a_cell_is_drawn_as_its_rows_are(spark):
    # Two cells of many rows: a bootstrap keeps Poisson(n) of them, a subsample Binomial(n, rate).
    df = spark.range(20000).select((F.col("id") % 2).cast("int").alias("label"), F.lit(1.0).alias("w"), (F.col("id") % 2).cast("double").alias("x"))
    vectors = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    for estimator, mean, variance in (
        (RandomForestClassifier(numTrees=60, maxDepth=1, **SHARED), 20000, 20000),
        (GBTClassifier(maxIter=60, maxDepth=1, subsamplingRate=0.8, **SHARED), 16000, 3200),
    ):
        model = on_cells(estimator, vectors)
        path = training.scratch_path(spark, "drawn")
        model.save(path)
        roots = spark.read.parquet(f"{path}/data").where("nodeData.id = 0").select("nodeData.rawCount")
        drawn = np.array([r.rawCount for r in roots.collect()], dtype=float)
        assert len(set(drawn)) > 40 and abs(drawn.mean() - mean) < 6 * (variance / 60) ** 0.5
        assert variance / 2 < drawn.var() < variance * 2


def test_large_tables_are_not_fitted_by_rows(spark, monkeypatch):
    def refuse(self, *_):
        raise AssertionError("fitted on rows")

    monkeypatch.setattr(RandomForestClassifier, "fit", refuse)
    monkeypatch.setattr(GBTClassifier, "fit", refuse)
    rng = np.random.default_rng(3)
    rows = [(f"c{i}", None if i % 40 == 0 else float(rng.normal() + 2 * (i % 3 == 0)), None if i % 50 == 0 else "mo"[i % 2], 5, int(i % 3 == 0)) for i in range(900)]
    df = spark.createDataFrame(rows, "customer_id string, n double, k string, flat int, churned int")
    candidates = training.default_candidates("churned", trees=4, rounds=3)
    with pytest.raises(AssertionError, match="fitted on rows"):  # a small table is
        training.train_and_compare(df, "churned", "customer_id", candidates)
    monkeypatch.setattr(cells, "ROWS", 500)
    result = training.train_and_compare(df, "churned", "customer_id", candidates)
    assert [r["algorithm"] for r in result.comparison] == [c.algorithm for c in candidates]
    assert all(r["validation_pr_auc"] > 0.7 for r in result.comparison)
    assert training.feature_importances(spark, result.model, df, result.algorithm).first().importance > 0
    monkeypatch.setattr(cells, "MOST_BINS", 10)  # too many cells for a task
    with pytest.raises(AssertionError, match="fitted on rows"):
        training.train_and_compare(df, "churned", "customer_id", candidates)


def test_what_the_rules_do_not_cover():
    assert not cells.supports(LogisticRegression())
    assert not cells.supports(RandomForestClassifier(impurity="entropy")) and not cells.supports(RandomForestClassifier(minInstancesPerNode=2))
    assert not cells.supports(RandomForestClassifier(bootstrap=False, subsamplingRate=0.5)) and not cells.supports(GBTClassifier(featureSubsetStrategy="sqrt"))
