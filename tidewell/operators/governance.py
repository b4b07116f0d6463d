"""Promotion gate, audit rows, champion resolution and rollback checks over tables.

A decision is a CASE over a candidate row joined with its champion, so a whole
table of candidates is decided in one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.mutation import latest_per_key

# The inference contract tag and the decision texts.
INFERENCE_CONTRACT = "churn_probability_v1"
NO_BASELINE = "Missing a valid positive-rate baseline."
FIRST_OK = "First model exceeds the no-skill PR-AUC baseline and recall requirement."
FIRST_REJECTED = "First model does not meet bootstrap quality requirements."
NO_IMPROVEMENT = "Candidate does not provide the required PR-AUC improvement."
RECALL_LOSS = "Candidate recall degradation exceeds the allowed threshold."
UPGRADE_OK = "Candidate preserves model quality and upgrades the inference contract."
LATER_OK = "Candidate satisfies the promotion requirements."
AUDIT_COLUMNS = (
    "model_name", "candidate_version", "previous_champion_version", "candidate_inference_contract",
    "previous_champion_inference_contract", "contract_upgrade", "candidate_pr_auc",
    "candidate_recall", "champion_pr_auc", "champion_recall", "decision", "decision_reason",
    "evaluated_at",
)


class PromotionBlocked(RuntimeError):
    """No model may serve: the candidate was rejected and there is no champion."""


class RollbackRejected(RuntimeError):
    """A rollback target is unsafe or incomplete; nothing was changed."""


@dataclass(frozen=True)
class Gate:
    """Limits of the promotion gate."""

    first_lift: float = 2.0
    first_recall: float = 0.60
    improvement: float = 0.01
    recall_loss: float = 0.02
    slack: float = 1e-12


def model_keys(metrics: DataFrame) -> list[str]:
    """What names a version: model and version number; a table without model names holds one model."""
    return [c for c in ("model_name", "model_version") if c in metrics.columns]


def latest_metrics(metrics: DataFrame, trained: str = "trained_at") -> DataFrame:
    """The newest metric row of each version of each model; on equal times that with the higher metrics."""
    ties = [c for c in ("test_pr_auc", "test_recall", "test_positive_rate") if c in metrics.columns]
    return latest_per_key(metrics, model_keys(metrics), [trained, *ties])


def decision_reason(
    has_champion: Column,
    upgrade: Column,
    pr_auc: Column,
    recall: Column,
    positive_rate: Column,
    champion_pr_auc: Column,
    champion_recall: Column,
    gate: Gate = Gate(),
) -> Column:
    """The text that explains the decision; it also fixes the decision (see ``is_approved``)."""
    lift_ok = F.try_divide(pr_auc, positive_rate) >= F.lit(gate.first_lift)
    first = (
        F.when(~F.coalesce(positive_rate > 0, F.lit(False)), NO_BASELINE)
        .when(lift_ok & (recall >= F.lit(gate.first_recall)), FIRST_OK)
        .otherwise(FIRST_REJECTED)
    )
    needed = F.when(upgrade, F.lit(0.0)).otherwise(F.lit(gate.improvement))
    later = (
        F.when(pr_auc - champion_pr_auc < needed - F.lit(gate.slack), NO_IMPROVEMENT)
        .when(champion_recall - recall > F.lit(gate.recall_loss), RECALL_LOSS)
        .when(upgrade, UPGRADE_OK)
        .otherwise(LATER_OK)
    )
    return F.when(has_champion, later).otherwise(first)


def is_approved(reason: Column) -> Column:
    return reason.isin(FIRST_OK, UPGRADE_OK, LATER_OK)


def promotion_decisions(pairs: DataFrame, gate: Gate = Gate(), evaluated_at: Column | None = None) -> DataFrame:
    """The 13 audit columns for each candidate.

    ``pairs`` has one row per candidate: model_name, candidate_version,
    candidate_contract, candidate_pr_auc, candidate_recall, candidate_positive_rate,
    and champion_version, champion_contract, champion_pr_auc, champion_recall, which
    are null when there is no champion.
    """
    has_champion = F.col("champion_version").isNotNull()
    old_contract = F.coalesce(F.col("champion_contract"), F.lit(""))
    new_contract = F.coalesce(F.col("candidate_contract"), F.lit(""))
    upgrade = (new_contract == INFERENCE_CONTRACT) & (old_contract != INFERENCE_CONTRACT)
    reason = decision_reason(
        has_champion,
        upgrade,
        F.col("candidate_pr_auc"),
        F.col("candidate_recall"),
        F.col("candidate_positive_rate"),
        F.col("champion_pr_auc"),
        F.col("champion_recall"),
        gate,
    )
    return pairs.select(
        "model_name",
        "candidate_version",
        F.coalesce(F.col("champion_version"), F.lit("")).alias("previous_champion_version"),
        new_contract.alias("candidate_inference_contract"),
        old_contract.alias("previous_champion_inference_contract"),
        upgrade.alias("contract_upgrade"),
        "candidate_pr_auc",
        "candidate_recall",
        "champion_pr_auc",
        "champion_recall",
        F.when(is_approved(reason), "APPROVED").otherwise("REJECTED").alias("decision"),
        reason.alias("decision_reason"),
        (evaluated_at if evaluated_at is not None else F.current_timestamp()).alias("evaluated_at"),
    )


def candidate_pairs(candidates: DataFrame, versions: DataFrame, metrics: DataFrame) -> DataFrame:
    """Input of ``promotion_decisions`` from tables.

    ``candidates``: model_name, candidate_version, champion_version (null if none).
    ``versions``: model_version, inference_contract. ``metrics``: candidate metrics by
    version; the newest row counts, for champions too, so a rollback needs no second table.
    A candidate or champion version without metrics fails the job.
    """
    keys = model_keys(metrics)
    named = [c for c in keys if c == "model_name"]
    newest = latest_metrics(metrics).select(
        *keys, "test_pr_auc", "test_recall", "test_positive_rate", F.lit(True).alias("found")
    )
    tag_keys = [c for c in keys if c in versions.columns]
    tags = versions.select(*tag_keys, "inference_contract")

    def side(prefix: str) -> DataFrame:
        return newest.join(tags, tag_keys, "left").select(
            *named,
            F.col("model_version").alias(f"{prefix}_version"),
            F.col("inference_contract").alias(f"{prefix}_contract"),
            F.col("test_pr_auc").cast("double").alias(f"{prefix}_pr_auc"),
            F.col("test_recall").cast("double").alias(f"{prefix}_recall"),
            F.col("test_positive_rate").cast("double").alias(f"{prefix}_positive_rate"),
            F.col("found").alias(f"{prefix}_found"),
        )

    joined = candidates.join(side("candidate"), [*named, "candidate_version"], "left").join(
        side("champion").drop("champion_positive_rate"), [*named, "champion_version"], "left"
    )

    def checked(prefix: str, needed: Column) -> Column:
        version = F.col(f"{prefix}_version")
        lost = needed & F.col(f"{prefix}_found").isNull()
        message = F.concat(F.lit(f"no metrics for {prefix} version "), version)
        return F.when(lost, F.raise_error(message).cast("string")).otherwise(version).alias(f"{prefix}_version")

    return joined.select(
        "model_name",
        checked("candidate", F.lit(True)),
        "candidate_contract",
        "candidate_pr_auc",
        "candidate_recall",
        "candidate_positive_rate",
        checked("champion", F.col("champion_version").isNotNull()),
        "champion_contract",
        "champion_pr_auc",
        "champion_recall",
    )


def champion_rows(decisions: DataFrame, metrics: DataFrame) -> DataFrame:
    """The metric row of each approved candidate, marked as Champion."""
    keys = [c for c in model_keys(metrics) if c == "model_version" or c in decisions.columns]
    approved = decisions.where(F.col("decision") == "APPROVED").select(
        *[c for c in keys if c == "model_name"],
        F.col("candidate_version").alias("model_version"), F.col("evaluated_at").alias("promoted_at")
    )
    return (
        latest_metrics(metrics)
        .drop("model_alias")
        .join(approved, keys)
        .withColumn("model_alias", F.lit("Champion"))
    )


def current_champion(
    history: DataFrame, decisions: Sequence[str] = ("APPROVED", "ROLLBACK"), by: str = "model_name"
) -> DataFrame:
    """The serving version of each model: that of its newest deciding audit row."""
    decided = history.where(F.col("decision").isin(*decisions))
    newest = latest_per_key(decided, [by], ["evaluated_at", "candidate_version"])
    return newest.select(
        by,
        F.col("candidate_version").alias("champion_version"),
        F.col("candidate_inference_contract").alias("champion_contract"),
        F.col("candidate_pr_auc").alias("champion_pr_auc"),
        F.col("candidate_recall").alias("champion_recall"),
        F.col("evaluated_at").alias("champion_since"),
    )


def rollback_checks(
    requests: DataFrame, versions: DataFrame, metrics: DataFrame, champions: DataFrame
) -> DataFrame:
    """Each requested (model_name, target_version) with ``problem``: null when it may proceed.

    ``versions``: model_name, model_version, inference_contract. ``champions``:
    model_name, champion_version, champion_contract.
    """
    target = F.trim(F.coalesce(F.col("target_version"), F.lit("")))
    known = versions.select(
        "model_name",
        F.col("model_version").alias("target_version"),
        F.coalesce("inference_contract", F.lit("")).alias("target_contract"),
    )
    named = [c for c in model_keys(metrics) if c == "model_name"]
    measured = latest_metrics(metrics).select(
        *named,
        F.col("model_version").alias("target_version"),
        F.col("test_pr_auc").alias("target_pr_auc"),
        F.col("test_recall").alias("target_recall"),
        F.lit(True).alias("has_metrics"),
    )
    previous = latest_metrics(metrics).select(
        *named,
        F.col("model_version").alias("champion_version"),
        F.col("test_pr_auc").alias("previous_pr_auc"),
        F.col("test_recall").alias("previous_recall"),
    )
    serving = champions.select("model_name", "champion_version", "champion_contract")
    joined = (
        requests.withColumn("target_version", target)
        .join(known, ["model_name", "target_version"], "left")
        .join(measured, [*named, "target_version"], "left")
        .join(serving, "model_name", "left")
        .join(previous, [*named, "champion_version"], "left")
    )
    t = F.col("target_version")
    problem = (
        F.when(t == "", F.lit("A target model version is required."))
        .when(F.col("target_contract").isNull(), F.concat(F.lit("Unknown model version "), t))
        .when(
            F.col("target_contract") != INFERENCE_CONTRACT,
            F.concat(F.lit("Incompatible inference contract of version "), t),
        )
        .when(F.col("has_metrics").isNull(), F.concat(F.lit("No metrics for version "), t))
        .when(F.col("champion_version").isNull(), F.lit("There is no champion to roll back."))
        .when(F.col("champion_version") == t, F.concat(F.lit("Champion already is version "), t))
    )
    return joined.select(
        "model_name",
        "target_version",
        "champion_version",
        "champion_contract",
        "target_contract",
        "target_pr_auc",
        "target_recall",
        "previous_pr_auc",
        "previous_recall",
        problem.alias("problem"),
    )


def rollback_audit(checks: DataFrame, evaluated_at: Column | None = None) -> DataFrame:
    """Audit rows with decision ROLLBACK for the requests that passed their checks."""
    reason = F.concat(
        F.lit("Champion alias rolled back from version "),
        F.col("champion_version"),
        F.lit(" to version "),
        F.col("target_version"),
        F.lit("."),
    )
    return checks.where(F.col("problem").isNull()).select(
        "model_name",
        F.col("target_version").alias("candidate_version"),
        F.col("champion_version").alias("previous_champion_version"),
        F.col("target_contract").alias("candidate_inference_contract"),
        F.coalesce("champion_contract", F.lit("")).alias("previous_champion_inference_contract"),
        F.lit(False).alias("contract_upgrade"),
        F.col("target_pr_auc").cast("double").alias("candidate_pr_auc"),
        F.col("target_recall").cast("double").alias("candidate_recall"),
        F.col("previous_pr_auc").cast("double").alias("champion_pr_auc"),
        F.col("previous_recall").cast("double").alias("champion_recall"),
        F.lit("ROLLBACK").alias("decision"),
        reason.alias("decision_reason"),
        (evaluated_at if evaluated_at is not None else F.current_timestamp()).alias("evaluated_at"),
    )


def require_deployable(decision: str, champion_version: str | None) -> None:
    """Stop scoring only when a rejection leaves no model to score with."""
    if decision != "APPROVED" and not champion_version:
        raise PromotionBlocked("candidate rejected and no champion available; scoring stopped")


def roll_back(store, model_name: str, target_version: str, evaluated_at: datetime | None = None) -> str:
    """Check one rollback against the stored tables and append its audit row.

    The champion is what the audit history says, so this single append is the whole
    change: if it fails, the old champion keeps serving. Returns the replaced version.
    """
    spark = store.spark
    request = spark.createDataFrame([(model_name, target_version)], "model_name string, target_version string")
    history = store.read("model_promotion_history", merge=True)
    champions = current_champion(history)
    checks = rollback_checks(
        request, store.read("model_versions"), store.read("model_candidate_metrics", merge=True), champions
    )
    row = checks.first()
    if row.problem:
        raise RollbackRejected(row.problem)
    stamp = F.lit(evaluated_at).cast("timestamp") if evaluated_at else None
    store.append("model_promotion_history", rollback_audit(checks, stamp))
    return row.champion_version
