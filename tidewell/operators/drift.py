"""Drift between two samples: PSI, KS and a report over all shared features.

Both samples are unpivoted to (feature, value), collapsed to counts per distinct
value, and read once more with running totals. Deciles, histograms, both ECDFs and
the means all come from that one table, for all features together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import bands
from tidewell.operators.ordering import quantile_columns, running_totals

# Share added to every bin, number of bins, columns that are no features.
EPSILON = 1e-6
BUCKETS = 10
NOT_FEATURES = ("customer_id", "churn", "churn_label", "snapshot_date", "_transformed_at", "_built_at")
PREDICTION_FEATURE = "_prediction_churn_probability"


def split_features(
    baseline: DataFrame | CountedSample, current: DataFrame, excluded: Sequence[str] = NOT_FEATURES
) -> tuple[list[str], list[str]]:
    """Shared feature columns as (numeric, categorical), by type."""
    shared = [f for f in baseline.schema if f.name not in excluded and f.name in current.columns]
    numeric = [f.name for f in shared if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    categorical = [f.name for f in shared if isinstance(f.dataType, T.StringType)]
    return numeric, categorical


def unpivot(df: DataFrame, columns: Sequence[str], type_name: str, keep: Sequence[str] = ()) -> DataFrame:
    """Long form (``keep``, feature, value) of the given columns, nulls and NaN left out.

    Narrow: one scan, no shuffle.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast(type_name).alias("value"))
            for c in columns
        ]
    )
    long = df.select(*keep, F.inline(pairs)).where(F.col("value").isNotNull())
    return long.where(~F.isnan("value")) if type_name == "double" else long


def value_counts(baseline: DataFrame | CountedSample, current: DataFrame, columns: Sequence[str], type_name: str) -> DataFrame:
    """(feature, value, n_base, n_cur) over both samples, from one tagged union."""
    none = F.lit(0).cast("long")
    sides = _counted(baseline, columns, type_name).select("feature", "value", F.col("n").alias("b"), none.alias("c")).unionAll(
        _counted(current, columns, type_name).select("feature", "value", none.alias("b"), F.col("n").alias("c"))
    )
    return sides.groupBy("feature", "value").agg(F.sum("b").alias("n_base"), F.sum("c").alias("n_cur"))


def feature_counts(df: DataFrame, excluded: Sequence[str] = NOT_FEATURES, per: Sequence[str] = ()) -> DataFrame:
    """(``per``, feature, number, text, n): how often each value of each feature column occurs.

    Numbers and texts have a column each. Counts of several parts of a sample merge by summing ``n``.
    """
    numeric, categorical = split_features(df, df, (*excluded, *per))
    none = {"number": F.lit(None).cast("double"), "text": F.lit(None).cast("string")}
    sides = [
        unpivot(df, columns, kind, per).select(*per, "feature", *[F.col("value").alias(c) if c == name else none[c].alias(c) for c in none])
        for columns, kind, name in ((numeric, "double", "number"), (categorical, "string", "text"))
        if columns
    ]
    if not sides:
        raise ValueError("there is no feature column")
    long = sides[0] if len(sides) == 1 else sides[0].unionAll(sides[1])
    return long.groupBy(*per, "feature", "number", "text").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class CountedSample:
    """A sample given by its stored value counts, to stand for the baseline in a drift report."""

    counts: DataFrame
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def long(self, columns: Sequence[str], type_name: str) -> DataFrame:
        value = "number" if type_name == "double" else "text"
        picked = self.counts.where(F.col("feature").isin(list(columns)) & F.col(value).isNotNull())
        return picked.select("feature", F.col(value).alias("value"), "n")


def _counted(sample: DataFrame | CountedSample, columns: Sequence[str], type_name: str) -> DataFrame:
    if isinstance(sample, CountedSample):
        return sample.long(columns, type_name)
    return unpivot(sample, columns, type_name).select("feature", "value", F.lit(1).cast("long").alias("n"))


def psi_term(base_share: Column, cur_share: Column) -> Column:
    b, c = base_share + F.lit(EPSILON), cur_share + F.lit(EPSILON)
    return (c - b) * F.log(c / b)


def _base_edges(totals: DataFrame, buckets: int) -> DataFrame:
    """Distinct baseline quantiles per feature, ascending; one row per feature."""
    points = [i / buckets for i in range(buckets + 1)]
    quantiles = totals.groupBy("feature").agg(*quantile_columns("value", "n_base", points))
    return quantiles.select(
        "feature",
        F.array_distinct(
            F.array_sort(F.array_compact(F.array(*[F.col(f"q{i}") for i in range(len(points))])))
        ).alias("edges"),
    )


def numeric_drift(
    baseline: DataFrame | CountedSample, current: DataFrame, columns: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """PSI, KS, means and counts for each numeric column.

    PSI: baseline quantile bins with equal edges merged, values outside the baseline
    range dropped before shares are taken; 0 when a side is empty or fewer than two
    edges remain, null when no current value lies in the baseline range.
    """
    counts = value_counts(baseline, current, columns, "double")
    totals = running_totals(counts, ["feature"], "value", ["n_base", "n_cur"])
    # One row per feature, so at most one per column of the table.
    edges = F.broadcast(_base_edges(totals, buckets))
    binned = totals.join(edges, "feature", "left").withColumn("bin", bands.edge_bin(F.col("value"), F.col("edges")))

    gap = F.abs(
        F.try_divide(F.col("cum_n_base"), F.col("all_n_base"))
        - F.try_divide(F.col("cum_n_cur"), F.col("all_n_cur"))
    )
    per_bin = binned.groupBy("feature", "bin").agg(
        F.sum("n_base").alias("bin_base"),
        F.sum("n_cur").alias("bin_cur"),
        F.max(gap).alias("gap"),
        F.sum(F.col("value") * F.col("n_base")).alias("sum_base"),
        F.sum(F.col("value") * F.col("n_cur")).alias("sum_cur"),
        F.max(F.size("edges")).alias("n_edges"),
    )
    # From here on there are at most buckets + 1 rows per feature.
    inside = F.col("bin").isNotNull()
    sums = per_bin.groupBy("feature").agg(
        F.sum("bin_base").alias("baseline_count"),
        F.sum("bin_cur").alias("current_count"),
        F.sum(F.when(inside, F.col("bin_base"))).alias("in_base"),
        F.sum(F.when(inside, F.col("bin_cur"))).alias("in_cur"),
        F.max("gap").alias("ks"),
        F.sum("sum_base").alias("sum_base"),
        F.sum("sum_cur").alias("sum_cur"),
        F.max("n_edges").alias("n_edges"),
        F.collect_list(F.when(inside, F.struct("bin_base", "bin_cur"))).alias("bins"),
    )
    # Bins that no value of either side falls in add nothing to the sum.
    shares = F.transform(
        "bins",
        lambda b: psi_term(
            F.try_divide(b["bin_base"], F.col("in_base")), F.try_divide(b["bin_cur"], F.col("in_cur"))
        ),
    )
    psi = F.aggregate(shares, F.lit(0.0), lambda total, term: total + term)
    comparable = (F.col("baseline_count") > 0) & (F.col("current_count") > 0)
    measured = sums.select(
        F.col("feature").alias("feature_name"),
        F.when(comparable & (F.col("n_edges") >= 2), psi).otherwise(F.lit(0.0)).alias("psi"),
        F.when(comparable, F.col("ks")).otherwise(F.lit(0.0)).alias("ks_statistic"),
        F.try_divide("sum_base", "baseline_count").alias("baseline_mean"),
        F.try_divide("sum_cur", "current_count").alias("current_mean"),
        "baseline_count",
        "current_count",
    )
    return _for_each(columns, measured, "numeric", 0.0)


def categorical_drift(baseline: DataFrame | CountedSample, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PSI over the union of categories, and counts, for each text column."""
    counts = value_counts(baseline, current, columns, "string")
    totals = counts.groupBy("feature").agg(
        F.sum("n_base").alias("baseline_count"), F.sum("n_cur").alias("current_count")
    )
    # One row per feature, so at most one per column of the table.
    terms = counts.join(F.broadcast(totals), "feature").select(
        "feature",
        "baseline_count",
        "current_count",
        psi_term(
            F.try_divide("n_base", "baseline_count"), F.try_divide("n_cur", "current_count")
        ).alias("term"),
    )
    measured = terms.groupBy("feature").agg(
        F.sum("term").alias("psi"),
        F.max("baseline_count").alias("baseline_count"),
        F.max("current_count").alias("current_count"),
    )
    none = F.lit(None).cast("double")
    shaped = measured.select(
        F.col("feature").alias("feature_name"),
        F.coalesce("psi", F.lit(0.0)).alias("psi"),
        none.alias("ks_statistic"),
        none.alias("baseline_mean"),
        none.alias("current_mean"),
        "baseline_count",
        "current_count",
    )
    return _for_each(columns, shaped, "categorical", None)


def _for_each(columns: Sequence[str], measured: DataFrame, kind: str, ks: float | None) -> DataFrame:
    """One row per column, with zeros for a column that has no value on either side."""
    names = F.array(*[F.lit(c) for c in columns])
    listed = measured.sparkSession.range(1).select(F.explode(names).alias("feature_name"))
    # One row per column on both sides.
    return listed.join(F.broadcast(measured), "feature_name", "left").select(
        "feature_name",
        F.lit(kind).alias("feature_type"),
        F.when(F.col("baseline_count").isNull(), F.lit(0.0)).otherwise(F.col("psi")).alias("psi"),
        F.coalesce("ks_statistic", F.lit(ks).cast("double")).alias("ks_statistic"),
        "baseline_mean",
        "current_mean",
        F.coalesce("baseline_count", F.lit(0)).alias("baseline_count"),
        F.coalesce("current_count", F.lit(0)).alias("current_count"),
    )


def _finish(measured: DataFrame, snapshot_date: Column, at: datetime | None) -> DataFrame:
    level = bands.alert_level(F.col("psi"))
    rounded = [
        F.round(c, 6).alias(c) for c in ("psi", "ks_statistic", "baseline_mean", "current_mean")
    ]
    return measured.select(
        snapshot_date.alias("snapshot_date"),
        "feature_name",
        "feature_type",
        *rounded,
        "baseline_count",
        "current_count",
        level.alias("alert_level"),
        (F.lit(at).cast("timestamp") if at else F.current_timestamp()).alias("computed_at"),
    )


def drift_report(
    baseline: DataFrame | CountedSample,
    current: DataFrame,
    snapshot_date: Column,
    excluded: Sequence[str] = NOT_FEATURES,
    at: datetime | None = None,
) -> DataFrame:
    """One row per shared feature: PSI, KS, means, counts and alert level.

    ``baseline`` may be a ``CountedSample``: then no baseline row is read.
    """
    numeric, categorical = split_features(baseline, current, excluded)
    parts = []
    if numeric:
        parts.append(numeric_drift(baseline, current, numeric))
    if categorical:
        parts.append(categorical_drift(baseline, current, categorical))
    if not parts:
        raise ValueError("the two frames share no feature column")
    measured = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _finish(measured, snapshot_date, at)


def prediction_drift(
    labels: DataFrame,
    scores: DataFrame,
    snapshot_date: Column,
    label: str = "churned",
    score: str = "churn_probability",
    at: datetime | None = None,
) -> DataFrame:
    """One row that compares the score distribution with the label distribution.

    No row when either side has no value.
    """
    measured = numeric_drift(
        labels.select(F.col(label).cast("double").alias(PREDICTION_FEATURE)),
        scores.select(F.col(score).cast("double").alias(PREDICTION_FEATURE)),
        [PREDICTION_FEATURE],
    ).withColumn("feature_type", F.lit("prediction"))
    both = (F.col("baseline_count") > 0) & (F.col("current_count") > 0)
    return _finish(measured.where(both), snapshot_date, at)


def latest_date(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """The newest partition date as a one-row frame."""
    return df.agg(F.max(column).alias(column))
