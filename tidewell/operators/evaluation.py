"""Binary-classifier evaluation on executors: curves, areas, thresholds, confusion counts.

Every operator takes a frame with a 0/1 label and a score, and optional group
columns (model, run, fold) so many models are evaluated in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ordering import running_totals

# Fixed value: guard in the F1 denominator.
F1_EPSILON = 1e-12
_ALL = "_all"


def score_counts(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score; rows without label or score are left out."""
    s, y = F.col(score).cast("double"), F.col(label).cast("int")
    usable = df.where(y.isNotNull() & s.isNotNull() & ~F.isnan(s))
    keys = [F.col(g) for g in groups] or [F.lit(0).alias(_ALL)]
    return usable.select(*keys, s.alias("threshold"), y.alias("_y")).groupBy(
        *(list(groups) or [_ALL]), "threshold"
    ).agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))


def threshold_counts(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """One row per (group, distinct score) with counts at and above that score.

    ``tp``/``fp`` count rows scored at or above the threshold; ``pos``/``neg`` those
    exactly at it; ``p``/``n`` are the group totals.
    """
    keys = list(groups) or [_ALL]
    totals = running_totals(
        score_counts(df, label, score, groups), keys, "threshold", ["pos", "neg"], descending=True
    )
    return totals.select(
        *keys,
        "threshold",
        "pos",
        "neg",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        F.col("all_pos").alias("p"),
        F.col("all_neg").alias("n"),
    )


def _precision() -> Column:
    return F.col("tp") / (F.col("tp") + F.col("fp"))


def _recall() -> Column:
    # With no positive at all, recall counts as one everywhere.
    return F.when(F.col("p") > 0, F.try_divide("tp", "p")).otherwise(F.lit(1.0))


def _f1() -> Column:
    precision, recall = _precision(), _recall()
    return 2 * precision * recall / (precision + recall + F.lit(F1_EPSILON))


def pr_curve(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 at every distinct score."""
    return threshold_counts(df, label, score, groups).select(
        *groups,
        "threshold",
        _precision().alias("precision"),
        _recall().alias("recall"),
        _f1().alias("f1"),
    )


def ranking_metrics(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Average precision, ROC-AUC, and the F1-best threshold per group.

    Average precision steps over distinct scores; ROC-AUC gives tied pairs one half
    and is null when a class is missing. Among equal F1 the lowest threshold wins.
    Without groups an empty input gives threshold 0.5 and F1 0.
    """
    at = threshold_counts(df, label, score, groups)
    step = F.try_divide(F.col("pos") * _precision(), F.col("p"))
    pairs = F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / 2)
    best = F.max(F.struct(_f1().alias("f1"), (-F.col("threshold")).alias("minus")))
    aggs = [
        F.sum(step).alias("pr_auc"),
        F.try_divide(F.sum(pairs), F.max(F.col("p")) * F.max(F.col("n"))).alias("roc_auc"),
        best.alias("_best"),
        F.coalesce(F.max("p"), F.lit(0)).alias("positives"),
        F.coalesce(F.max("n"), F.lit(0)).alias("negatives"),
    ]
    found = at.groupBy(*groups).agg(*aggs) if groups else at.agg(*aggs)
    return found.select(
        *groups,
        "pr_auc",
        "roc_auc",
        F.coalesce(-F.col("_best.minus"), F.lit(0.5)).alias("threshold"),
        F.coalesce(F.col("_best.f1"), F.lit(0.0)).alias("best_f1"),
        "positives",
        "negatives",
    )


def best_threshold(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """The score that maximises F1, and that F1."""
    return ranking_metrics(df, label, score, groups).select(*groups, "threshold", "best_f1")


def confusion_metrics(
    df: DataFrame, label: str, score: str, threshold: Column | float, groups: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall, F1, balanced accuracy and positive rate at a threshold.

    Ratios with an empty denominator are 0, as is the recall of a missing class.
    """
    limit = F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold
    y, hit = F.col(label) == 1, F.col(score) >= limit
    usable = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    aggs = [
        F.count_if(y & hit).alias("tp"),
        F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"),
        F.count_if(~y & ~hit).alias("tn"),
    ]
    counts = usable.groupBy(*groups).agg(*aggs) if groups else usable.agg(*aggs)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0.0)
    recall = F.coalesce(F.try_divide(tp, tp + fn), zero)
    specificity = F.coalesce(F.try_divide(tn, tn + fp), zero)
    return counts.select(
        *groups,
        "tp",
        "fp",
        "fn",
        "tn",
        F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
        recall.alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
        ((recall + specificity) / 2).alias("balanced_accuracy"),
        F.try_divide(tp + fn, tp + fp + fn + tn).alias("positive_rate"),
        (tp + fp + fn + tn).alias("rows"),
    )


def class_balance(df: DataFrame, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """Class counts, number of classes, and negatives per positive."""
    aggs = [
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.countDistinct(label).alias("classes"),
    ]
    counts = df.groupBy(*groups).agg(*aggs) if groups else df.agg(*aggs)
    return counts.withColumn("scale_pos_weight", F.try_divide("negatives", "positives"))
