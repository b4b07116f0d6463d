"""Reporting queries over the pipeline tables, each one DataFrame aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import bands
from tidewell.operators.mutation import latest_per_key
from tidewell.operators.ordering import exact_quantiles, global_rank


def share(condition: Column) -> Column:
    """Part of the rows for which the condition holds; null without rows."""
    return F.try_divide(F.count_if(condition), F.count("*"))


# Customers


def customer_kpis(
    snapshots: DataFrame,
    training: DataFrame,
    entity: str = "customer_id",
    tenure: str = "tenure",
    charge: str = "monthly_charges",
    label: str = "churned",
) -> DataFrame:
    """Distinct customers, average tenure and charges, and the labelled churn rate."""
    rate = training.agg(share(F.col(label) == 1).alias("churn_rate"))
    return snapshots.agg(
        F.countDistinct(entity).alias("total_customers"),
        F.avg(tenure).alias("avg_tenure"),
        F.avg(charge).alias("avg_monthly_charges"),
    ).select("*", rate.scalar().alias("churn_rate"))


def binned_by_label(df: DataFrame, value: str, width: float, top: int | None, label: str) -> DataFrame:
    """Histogram with fixed-width bins per label; ``top`` makes the last bin open-ended.

    With tenure: width 12; with charges: width 20, top 5 (100 and more).
    """
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(bands.fixed_width_bin(F.col(value), width, top).alias("bin"), F.col(label).alias("label"))
        .agg(F.count("*").alias("customers"))
    )


def category_by_label(df: DataFrame, category: str, label: str) -> DataFrame:
    return df.groupBy(F.col(category).alias("category"), F.col(label).alias("label")).agg(
        F.count("*").alias("customers")
    )


def rate_by(df: DataFrame, group: str, label: str) -> DataFrame:
    """Rows, positives and positive share per value of a column (snapshot date, senior flag, ...)."""
    positive = F.col(label) == 1
    return df.groupBy(group).agg(
        F.count("*").alias("rows"),
        F.count_if(positive).alias("positives"),
        share(positive).alias("rate"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair as (feature_x, feature_y, correlation).

    A pair uses the rows where both values are present; a constant column gives null.
    Works on sums of products of values shifted by the column means: the means come
    from a first small pass, and plain sums cost a fraction of ``corr`` for all pairs.
    """
    number = {c: F.col(f"`{c}`").cast("double") for c in columns}
    seen = df.agg(
        F.count("*").alias("n"),
        *[F.avg(v).alias(f"m_{c}") for c, v in number.items()],
        *[F.count(v).alias(f"n_{c}") for c, v in number.items()],
    ).first()
    means = [float(seen[f"m_{c}"] or 0.0) for c in columns]
    full = [seen[f"n_{c}"] == seen["n"] for c in columns]
    shifted = [f"(CAST(`{c}` AS DOUBLE) - {m!r}D)" for c, m in zip(columns, means)]

    # SQL text, because the matrix needs many small expressions of a fixed shape.
    sums = {"n": "count(*)"}
    pairs = [f"1.0D AS r_{i}_{i}" for i in range(len(columns))]
    for i, vi in enumerate(shifted):
        for j in range(i + 1, len(columns)):
            vj = shifted[j]
            p = f"p_{i}_{j}"
            sums[p] = f"sum({vi} * {vj})"
            if full[i] and full[j]:
                n, x, y = "n", (f"s_{i}", f"q_{i}"), (f"s_{j}", f"q_{j}")
                present = "true"
            else:
                n, x, y = f"n_{p}", (f"sx_{p}", f"qx_{p}"), (f"sy_{p}", f"qy_{p}")
                present = f"{vi} IS NOT NULL AND {vj} IS NOT NULL"
                sums[n] = f"count_if({present})"
            for (s, q), v in ((x, vi), (y, vj)):
                sums[s] = f"sum({v}) FILTER (WHERE {present})"
                sums[q] = f"sum({v} * {v}) FILTER (WHERE {present})"
            spread = f"sqrt(({n} * {x[1]} - {x[0]} * {x[0]}) * ({n} * {y[1]} - {y[0]} * {y[0]}))"
            pairs.append(f"try_divide({n} * {p} - {x[0]} * {y[0]}, {spread}) AS r_{i}_{j}")
    cells = ", ".join(
        f"named_struct('feature_x', '{x}', 'feature_y', '{y}', 'correlation', r_{min(i, j)}_{max(i, j)})"
        for i, x in enumerate(columns)
        for j, y in enumerate(columns)
    )
    totals = df.agg(*[F.expr(f"{value} AS {name}") for name, value in sums.items()])
    return totals.selectExpr(*pairs).selectExpr(f"inline(array({cells}))")


def box_summary(df: DataFrame, value: str, label: str) -> DataFrame:
    """Minimum, exact quartiles and maximum of a value per label."""
    found = exact_quantiles(df, [label], value, [0.0, 0.25, 0.5, 0.75, 1.0])
    names = ("minimum", "q1", "median", "q3", "maximum")
    return found.select(
        F.col(label).alias("label"),
        F.col("n_values").alias("rows"),
        *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(names)],
    )


def flag_by_label(df: DataFrame, flag: Column, label: str) -> DataFrame:
    """Counts per label and derived flag, such as ``complaint_high_30d > 0``."""
    return df.groupBy(F.col(label).alias("label"), F.coalesce(flag, F.lit(False)).alias("flag")).agg(
        F.count("*").alias("customers")
    )


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and their share of all rows; one row per class."""
    positive, total = F.count_if(F.col(label) == 1), F.count_if(F.col(label).isin(0, 1))
    both = df.agg(positive.alias("p"), total.alias("t"))
    cells = F.array(
        F.struct(F.lit(1).alias("label"), F.col("p").alias("customers"), F.try_divide("p", "t").alias("share")),
        F.struct(
            F.lit(0).alias("label"),
            (F.col("t") - F.col("p")).alias("customers"),
            F.try_divide(F.col("t") - F.col("p"), F.col("t")).alias("share"),
        ),
    )
    return both.select(F.inline(cells)).where(F.col("customers") > 0)


def behaviour_points(
    features: DataFrame,
    labels: DataFrame,
    columns: Sequence[str] = ("support_call_count_30d", "complaint_count_30d", "monthly_charges"),
    entity: str = "customer_id",
    label: str = "churned",
) -> DataFrame:
    """Scatter source: chosen features with the label of the same (entity, snapshot date)."""
    return features.select(entity, "snapshot_date", *columns).join(
        labels.select(entity, "snapshot_date", label), [entity, "snapshot_date"]
    )


# Predictions


def score_kpis(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.count("*").alias("total_customers"),
        share(F.col("churn_prediction") == 1).alias("churn_rate"),
        F.avg("churn_probability").alias("avg_probability"),
        F.count_if(F.col("risk_segment") == "High").alias("high_risk"),
        F.sum("annual_revenue_at_risk").alias("revenue_at_risk"),
    )


def probability_histogram(scores: DataFrame, probability: str = "churn_probability", bins: int = 10) -> DataFrame:
    """Customers per equal bin of [0, 1]; 1.0 belongs to the last bin."""
    index = F.least(F.floor(F.col(probability) * bins).cast("int"), F.lit(bins - 1))
    return (
        scores.where(F.col(probability).isNotNull())
        .groupBy(index.alias("bin"))
        .agg(F.count("*").alias("customers"))
    )


def risk_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("risk_segment").agg(
        F.count("*").alias("customers"),
        F.avg("churn_probability").alias("average_churn_probability"),
        F.sum("annual_revenue_at_risk").alias("annual_revenue_at_risk"),
    )


def segment_by(scores: DataFrame, column: str = "contract") -> DataFrame:
    return scores.groupBy(column, "risk_segment").agg(F.count("*").alias("customers"))


def top_at_risk(scores: DataFrame, n: int = 20) -> DataFrame:
    """The n customers with the highest probability, the lower id first on ties."""
    columns = (
        "customer_id", "churn_probability", "risk_segment", "contract", "tenure", "monthly_charges",
        "annual_revenue_at_risk",
    )
    ordered = scores.orderBy(F.desc("churn_probability"), "customer_id").limit(n)
    return ordered.select(*[c for c in columns if c in scores.columns])


# Drift


def drift_kpis(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count_if(F.col("feature_type") != "prediction").alias("features_monitored"),
        F.count_if(F.col("alert_level") == "significant").alias("significant_drift"),
        F.count_if(F.col("alert_level") == "moderate").alias("moderate_drift"),
        F.max("snapshot_date").alias("latest_snapshot"),
    )


def psi_ranking(metrics: DataFrame) -> DataFrame:
    """All metrics with their ``rank``: highest PSI first, then by feature and date."""
    order = [F.col("psi").desc_nulls_last(), F.col("feature_name").asc(), F.col("snapshot_date").asc()]
    return global_rank(metrics, order, "rank")


def psi_trend(metrics: DataFrame, top: int = 5) -> DataFrame:
    """PSI by date for the features with the highest PSI ever."""
    leaders = (
        metrics.groupBy("feature_name")
        .agg(F.max("psi").alias("_peak"))
        .orderBy(F.desc("_peak"), "feature_name")
        .limit(top)
    )
    kept = metrics.join(F.broadcast(leaders), "feature_name", "left_semi")
    return kept.select("snapshot_date", "feature_name", "psi")


# Operations


def run_kpis(runs: DataFrame) -> DataFrame:
    return runs.agg(
        F.count("*").alias("total_runs"),
        share(F.col("status") == "succeeded").alias("success_rate"),
        F.avg("duration_seconds").alias("avg_duration"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
    )


def runs_by_day(runs: DataFrame) -> DataFrame:
    return runs.groupBy(F.to_date("started_at").alias("day"), "status").agg(F.count("*").alias("runs"))


def duration_trend(runs: DataFrame) -> DataFrame:
    """Mean duration per day and task."""
    return runs.groupBy(F.to_date("started_at").alias("day"), "task_name").agg(
        F.avg("duration_seconds").alias("avg_duration")
    )


def recent_runs(runs: DataFrame, n: int = 50) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


def pass_rate(metrics: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """Passing rows over evaluated rows, overall or per group."""
    rate = F.try_divide(F.sum("passing_rows"), F.sum("total_rows")).alias("pass_rate")
    return metrics.groupBy(*by).agg(rate) if by else metrics.agg(rate)


def pass_rate_by_day(metrics: DataFrame) -> DataFrame:
    return pass_rate(metrics, [F.to_date("evaluated_at").alias("day")])


def violations_by_rule(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("rule_name", "severity").agg(F.sum("violating_rows").alias("violating_rows"))


# Governance


def governance_kpis(history: DataFrame) -> DataFrame:
    """Version and metrics of the newest approval, and the number of promotions."""
    approved = F.col("decision") == "APPROVED"
    newest = F.max_by(
        F.struct("candidate_version", "candidate_pr_auc", "candidate_recall"),
        F.when(approved, F.struct("evaluated_at", "candidate_version")),
    )
    return history.agg(newest.alias("_n"), F.count_if(approved).alias("total_promotions")).select(
        F.col("_n.candidate_version").alias("champion_version"),
        F.col("_n.candidate_pr_auc").alias("latest_pr_auc"),
        F.col("_n.candidate_recall").alias("latest_recall"),
        "total_promotions",
    )


def metrics_by_version(history: DataFrame) -> DataFrame:
    """Candidate and champion metrics of the newest decision on each version."""
    newest = latest_per_key(history, ["candidate_version"], ["evaluated_at"])
    return newest.select(
        "candidate_version", "candidate_pr_auc", "champion_pr_auc", "candidate_recall", "contract_upgrade"
    )


#: Columns of the history table, as reported.
HISTORY = (
    "candidate_version", "previous_champion_version", "candidate_pr_auc", "champion_pr_auc", "candidate_recall",
    "champion_recall", "decision", "decision_reason", "evaluated_at",
)


def promotion_history(history: DataFrame, decisions: Sequence[str] = ()) -> DataFrame:
    """All decisions, or only those named, with their ``position``: the newest first, then by model and version."""
    rows = history.where(F.col("decision").isin(*decisions)) if decisions else history
    order = [F.col("evaluated_at").desc_nulls_last(), F.col("model_name").asc(), F.col("candidate_version").asc()]
    return global_rank(rows.select("model_name", *HISTORY), order, "position")


def contract_compatibility(history: DataFrame) -> DataFrame:
    """Per model the pairs of contracts that met, whether that was an upgrade, and the versions and approvals among them."""
    pair = ["model_name", "candidate_inference_contract", "previous_champion_inference_contract", "contract_upgrade"]
    return history.groupBy(*pair).agg(
        F.count_distinct("candidate_version").alias("versions"),
        F.count_if(F.col("decision") == "APPROVED").alias("approved"),
        F.max("evaluated_at").alias("latest"),
    )
