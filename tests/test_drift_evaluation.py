import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import drift, evaluation, ordering, split, training
from tidewell.plans import reports

EPS = 1e-6


def np_psi(base, cur):
    edges = np.unique(np.percentile(base, np.linspace(0, 100, 11)))
    if len(edges) < 2:
        return 0.0
    b, c = np.histogram(base, edges)[0], np.histogram(cur, edges)[0]
    b, c = b / b.sum() + EPS, c / c.sum() + EPS
    return float(np.sum((c - b) * np.log(c / b)))


def np_ks(base, cur):
    points = np.sort(np.concatenate([base, cur]))
    at = [np.searchsorted(np.sort(x), points, side="right") / len(x) for x in (base, cur)]
    return float(np.max(np.abs(at[0] - at[1])))


def col(spark, values, name="v"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def measure(spark, base, cur):
    return drift.numeric_drift(col(spark, base), col(spark, cur), ["v"]).first()


@pytest.mark.parametrize("seed", range(4))
def test_random_draws_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    base = np.round(rng.normal(0, 1, 700), 1 if seed % 2 else 9)
    cur = np.round(rng.normal(seed * 0.4, 1 + seed * 0.2, 500), 1 if seed % 2 else 9)
    got = measure(spark, base, cur)
    assert got.psi == pytest.approx(np_psi(base, cur), abs=1e-9) and got.psi >= 0
    assert got.ks_statistic == pytest.approx(np_ks(base, cur), abs=1e-12)
    assert got.baseline_mean == pytest.approx(base.mean()) and got.current_count == 500


def test_edge_cases(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(0, 1, 300)
    assert measure(spark, x, x).psi == pytest.approx(0, abs=1e-12)
    empty = measure(spark, [], x)
    assert (empty.psi, empty.ks_statistic, empty.baseline_count) == (0.0, 0.0, 0)
    nothing = measure(spark, [], [])
    assert (nothing.psi, nothing.ks_statistic, nothing.current_count) == (0.0, 0.0, 0)
    assert measure(spark, [1.0] * 50, [1.0] * 50).psi == 0.0
    assert measure(spark, range(10), range(100, 110)).ks_statistic == 1.0
    assert measure(spark, range(10), range(100, 110)).psi is None  # no current value in range
    noisy = list(x) + [math.nan, None]
    assert measure(spark, noisy, noisy[::-1]).baseline_count == 300


def test_categorical(spark):
    make = lambda pairs: spark.createDataFrame([(k,) for k, n in pairs for _ in range(n)], "c string")
    same = drift.categorical_drift(make([("a", 50), ("b", 50)]), make([("a", 50), ("b", 50)]), ["c"]).first()
    assert same.psi == pytest.approx(0, abs=1e-12)
    moved = drift.categorical_drift(make([("a", 50), ("b", 50)]), make([("a", 10), ("b", 90)]), ["c"]).first()
    want = sum((c - b) * math.log(c / b) for b, c in ((0.5 + EPS, 0.1 + EPS), (0.5 + EPS, 0.9 + EPS)))
    assert moved.psi == pytest.approx(want) and moved.psi > 0.10
    new = drift.categorical_drift(make([("a", 9)]), make([("a", 5), ("new", 4)]), ["c"]).first()
    assert new.psi > 0
    assert drift.categorical_drift(make([]), make([("a", 5)]), ["c"]).first().psi == 0.0


def test_report_and_prediction_row(spark):
    rng = np.random.default_rng(3)
    rows = [("c", float(v), "x" if v > 0 else "y") for v in rng.normal(0, 1, 200)]
    base = spark.createDataFrame(rows, "customer_id string, n double, k string")
    cur = base.withColumn("n", F.col("n") + 3)
    report = {r.feature_name: r for r in drift.drift_report(base, cur, F.lit("2026-01-01")).collect()}
    assert set(report) == {"n", "k"}
    assert report["n"].alert_level == "significant" and report["k"].alert_level == "none"
    assert report["k"].ks_statistic is None and report["k"].feature_type == "categorical"
    labels = spark.createDataFrame([(0,), (1,)], "churned int")
    empty = spark.createDataFrame([], "churn_probability double")
    assert drift.prediction_drift(labels, empty, F.lit("d")).count() == 0


# Ordering


def test_hot_value_and_hot_group(spark):
    rng = np.random.default_rng(1)
    values = {"hot": np.concatenate([np.full(2000, 7.0), rng.normal(0, 5, 1000)]), "small": rng.normal(0, 1, 11)}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs]
    points = [0, 0.1, 0.25, 0.5, 0.9, 1]
    got = ordering.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", points)
    for r in got.collect():
        assert r.quantiles == pytest.approx(list(np.percentile(values[r.g], np.array(points) * 100)))
        assert r.n_values == len(values[r.g])


def test_running_totals_over_many_slices(spark):
    counts = spark.range(5000).select(
        (F.col("id") % 2).cast("string").alias("g"), F.col("id").cast("double").alias("v"), F.lit(1).alias("n")
    )
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        totals = ordering.running_totals(counts, ["g"], "v", ["n"])
        wrong = totals.where((F.col("cum_n") != F.floor(F.col("v") / 2) + 1) | (F.col("all_n") != 2500))
        assert totals.count() == 5000 and wrong.isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


# Evaluation


def scored(spark, labels, scores):
    return spark.createDataFrame([(int(y), float(s)) for y, s in zip(labels, scores)], "y int, s double")


def np_metrics(y, s):
    y, s = np.asarray(y), np.asarray(s)
    thresholds = np.unique(s)[::-1]
    tp = np.array([np.sum((s >= t) & (y == 1)) for t in thresholds])
    fp = np.array([np.sum((s >= t) & (y == 0)) for t in thresholds])
    precision, recall = tp / (tp + fp), tp / max(y.sum(), 1)
    ap = np.sum(np.diff(np.concatenate([[0], recall])) * precision)
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    return ap, auc


def test_golden_threshold(spark):
    best = evaluation.best_threshold(scored(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8]), "y", "s").first()
    assert best.threshold == 0.35 and best.best_f1 == pytest.approx(0.8)


@pytest.mark.parametrize("places", [1, 9])
def test_areas_equal_numpy(spark, places):
    rng = np.random.default_rng(places)
    y = rng.integers(0, 2, 400)
    s = np.round(np.clip(0.4 * y + rng.uniform(0, 0.6, 400), 0, 1), places)
    got = evaluation.ranking_metrics(scored(spark, y, s), "y", "s").first()
    ap, auc = np_metrics(y, s)
    assert got.pr_auc == pytest.approx(ap) and got.roc_auc == pytest.approx(auc)


def test_degenerate_labels(spark):
    none = evaluation.ranking_metrics(scored(spark, [0, 0], [0.2, 0.6]), "y", "s").first()
    assert (none.threshold, none.best_f1, none.roc_auc) == (0.2, 0.0, None)
    empty = evaluation.ranking_metrics(scored(spark, [], []), "y", "s").first()
    assert (empty.threshold, empty.best_f1) == (0.5, 0.0)
    tie = evaluation.best_threshold(scored(spark, [1, 0, 1, 0], [0.9, 0.5, 0.5, 0.5]), "y", "s").first()
    assert tie.threshold == 0.5 or tie.best_f1 == pytest.approx(2 / 3)


def test_confusion(spark):
    c = evaluation.confusion_metrics(scored(spark, [1, 1, 0, 0, 0], [0.9, 0.2, 0.8, 0.1, 0.1]), "y", "s", 0.5).first()
    assert (c.tp, c.fp, c.fn, c.tn) == (1, 1, 1, 2)
    assert c.balanced_accuracy == pytest.approx((0.5 + 2 / 3) / 2) and c.positive_rate == 0.4
    silent = evaluation.confusion_metrics(scored(spark, [1, 0], [0.1, 0.1]), "y", "s", 0.5).first()
    assert (silent.precision, silent.recall, silent.f1) == (0.0, 0.0, 0.0)


def test_split_is_exact_and_layout_free(spark):
    rows = [(i, 1 if i % 10 == 0 else 0) for i in range(1000)] + [(2000, None)]
    df = spark.createDataFrame(rows, "id bigint, y int")
    folds = [
        {r.id: r.fold for r in split.stratified_split(df.repartition(n), "y", "id").collect()} for n in (1, 6)
    ]
    assert folds[0] == folds[1] and folds[0][2000] is None
    for label, n in ((0, 900), (1, 100)):
        of = [folds[0][i] for i, y in rows if y == label]
        assert (of.count("train"), of.count("validation")) == (n * 64 // 100, n * 16 // 100)


def test_split_keeps_copies_of_a_key_together(spark):
    df = spark.createDataFrame([(i % 7 if i < 400 else i, 0) for i in range(600)], "id bigint, y int")
    per_key = split.stratified_split(df, "y", "id").groupBy("id").agg(F.countDistinct("fold").alias("n"))
    assert per_key.where("n > 1").isEmpty()


# Training


def test_imputation_and_winner(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (2.0, "b"), (10.0, "b"), (None, None), (4.0, "a")], "n double, k string"
    )
    learned = training.learn_imputation(df, ["n"], ["k"])
    assert (learned.numbers, learned.texts) == ({"n": 3.0}, {"k": "a"})
    filled = learned.apply(df).where("n IS NULL").first()
    assert (filled.n_filled, filled.k_filled) == (3.0, "a")
    table = spark.createDataFrame(
        [("m", "x", 0.7, 0.5), ("m", "y", 0.7, 0.6), ("m", "z", 0.6, 0.9)],
        "model_name string, algorithm string, validation_pr_auc double, validation_best_f1 double",
    )
    assert training.select_winner(table, ["model_name"]).first().algorithm == "y"


def test_training_end_to_end(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        y = int(rng.uniform() < 0.3)
        rows.append((f"c{i}", float(y * 2 + rng.normal()), None if i % 50 == 0 else ("m" if y else "o"), y))
    df = spark.createDataFrame(rows, "customer_id string, n double, k string, churned int")
    candidates = [training.single_tree("churned"), training.default_candidates("churned")[-1]]
    result = training.train_and_compare(df, "churned", "customer_id", candidates)
    assert result.test_metrics["test_pr_auc"] > 0.8 and sum(r["selected"] for r in result.comparison) == 1
    assert training.comparison_frame(spark, result).count() == 2
    metrics = training.candidate_metrics_frame(spark, result, "churn", "1")
    assert len(metrics.columns) == 18 and metrics.first().model_alias == "Candidate"
    names = training.feature_importances(spark, result.model, df, result.algorithm)
    assert names.count() >= 3 and names.first().importance >= 0
    unseen = spark.createDataFrame([("q", 1.0, "never seen", 0)], df.schema)
    assert 0 <= result.score(unseen).first().churn_probability <= 1
    with pytest.raises(training.TrainingError, match="both classes"):
        training.train_and_compare(df.where("churned = 0"), "churned", "customer_id", candidates)


def test_correlation_with_gaps(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(1e6, 1, 200)
    y = x + rng.normal(0, 1, 200)
    rows = [(float(a), None if i % 9 == 0 else float(b), 3.0) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double, flat double")
    got = {(r.feature_x, r.feature_y): r.correlation for r in reports.correlation_matrix(df, ["x", "y", "flat"]).collect()}
    keep = [i for i in range(200) if i % 9]
    assert got["x", "y"] == got["y", "x"] == pytest.approx(np.corrcoef(x[keep], y[keep])[0, 1], abs=1e-9)
    assert got["x", "flat"] is None and got["x", "x"] == 1.0


def test_category_codes(spark):
    rows = [("b",), ("b",), ("a",), ("a",), ("c",), (None,), ("é",)]
    df = spark.createDataFrame(rows, "k string")
    codes = training.category_codes(df, ["k"])
    assert {r.value: r.code for r in codes.collect()} == {"a": 0, "b": 1, "c": 2, "é": 3}
    got = training.encode_categories(df, codes, "k").collect()
    assert sorted(map(str, got)) == sorted(f"Row(k={v!r}, k_code={c})" for v, c in [("b", 1)] * 2 + [("a", 0)] * 2 + [("c", 2), (None, None), ("é", 3)])
    assert training.category_labels(df, ["k"]) == {"k": ["a", "b", "c", "é"]} and training.category_labels(df, []) == {}
    with pytest.raises(training.TooManyCategories, match="column k has 4 values, more than the 3"):
        training.category_labels(df, ["k"], limit=3)


def test_unseen_categories_encode_as_zeros(spark):
    from pyspark.ml import Pipeline

    seen = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0), ("b", "x", 3.0)], "k_filled string, m_filled string, n_filled double")
    fitted = Pipeline(stages=training.preprocessing_stages(["n"], {"k": ["a", "b"], "m": ["x"]})).fit(seen)
    new = spark.createDataFrame([("z", "z", 2.0), ("b", "x", 3.0)], seen.schema)
    assert [list(r.features) for r in fitted.transform(new).collect()] == [[0.0, 0.0, 0.0, 0.0], [0.0, 1.0, 1.0, 1.0]]
