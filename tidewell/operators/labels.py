"""Delayed outcome labels and the training set built on them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.functions import bands

# Fixed value: default days between the snapshot and the maturity of its label.
HORIZON_DAYS = 30


class ImmatureLabel(ValueError):
    """The label horizon of a snapshot has not passed yet."""


@dataclass(frozen=True)
class LabelSpec:
    entity: str = "customer_id"
    ts: str = "event_ts"
    kind: str = "event_type"
    outcome: str = "cancellation"
    horizon: int = HORIZON_DAYS
    label: str = "churned"


def maturity_date(as_of: date, horizon: int = HORIZON_DAYS) -> date:
    return as_of + timedelta(days=horizon)


def is_mature(as_of: date, today: date, horizon: int = HORIZON_DAYS) -> bool:
    return today >= maturity_date(as_of, horizon)


def delayed_labels(
    events: DataFrame,
    snapshot: DataFrame,
    as_of: date,
    today: date,
    spec: LabelSpec = LabelSpec(),
    labeled_at: datetime | None = None,
) -> DataFrame:
    """Label every entity of one snapshot: 1 if an outcome event falls in (as_of, maturity].

    Raises ``ImmatureLabel`` before the maturity date.
    """
    if not is_mature(as_of, today, spec.horizon):
        raise ImmatureLabel(f"labels for {as_of} mature on {maturity_date(as_of, spec.horizon)}")
    outcomes = (
        events.where(F.col(spec.kind) == spec.outcome)
        .where(bands.outcome_band(events, spec.ts, as_of, spec.horizon))
        .select(spec.entity)
        .distinct()
        .withColumn(spec.label, F.lit(1))
    )
    population = snapshot
    if "snapshot_date" in snapshot.columns:
        population = snapshot.where(F.col("snapshot_date") == F.lit(as_of).cast("date"))
    return (
        population.select(spec.entity)
        .distinct()
        .join(outcomes, spec.entity, "left")
        .select(
            spec.entity,
            F.coalesce(F.col(spec.label), F.lit(0)).alias(spec.label),
            F.lit(as_of).cast("date").alias("snapshot_date"),
            F.lit(spec.horizon).alias("label_horizon_days"),
            F.lit(maturity_date(as_of, spec.horizon)).cast("date").alias("maturity_date"),
            _stamp(labeled_at).alias("_labeled_at"),
        )
    )


def mature_labels(
    events: DataFrame,
    snapshots: DataFrame,
    today: date,
    spec: LabelSpec = LabelSpec(),
    already_labeled: DataFrame | None = None,
    labeled_at: datetime | None = None,
) -> DataFrame:
    """Labels for every mature snapshot row (entity and date) that has none yet, in one job.

    Each outcome day is turned into the snapshot dates whose band it falls in, so
    the match is an equi-join on (entity, date); outcomes shrink to one row per
    entity and day before that.
    """
    last = today - timedelta(days=spec.horizon)
    population = snapshots.where(F.col("snapshot_date") <= F.lit(last)).select(
        spec.entity, "snapshot_date"
    )
    if already_labeled is not None:
        done = already_labeled.select(spec.entity, "snapshot_date")
        population = population.join(done, [spec.entity, "snapshot_date"], "left_anti")
    outcome_days = (
        events.where(F.col(spec.kind) == spec.outcome)
        .select(spec.entity, F.to_date(spec.ts).alias("_day"))
        .distinct()
    )
    hits = (
        outcome_days.select(
            spec.entity,
            F.explode(
                F.sequence(F.date_sub("_day", spec.horizon), F.date_sub("_day", 1))
            ).alias("snapshot_date"),
        )
        .distinct()
        .withColumn(spec.label, F.lit(1))
    )
    return (
        population.distinct()
        .join(hits, [spec.entity, "snapshot_date"], "left")
        .select(
            spec.entity,
            F.coalesce(F.col(spec.label), F.lit(0)).alias(spec.label),
            "snapshot_date",
            F.lit(spec.horizon).alias("label_horizon_days"),
            F.date_add("snapshot_date", spec.horizon).alias("maturity_date"),
            _stamp(labeled_at).alias("_labeled_at"),
        )
    )


def training_set(
    features: DataFrame, labels: DataFrame, entity: str = "customer_id", label: str = "churned"
) -> DataFrame:
    """Features of every labelled (entity, snapshot date), with label and maturity."""
    wanted = labels.select(entity, "snapshot_date", label, "label_horizon_days", "maturity_date")
    return features.join(wanted, [entity, "snapshot_date"])


def label_counts(labels: DataFrame, label: str = "churned") -> DataFrame:
    """Rows, positives and the positive share rounded to 4 places."""
    total, positive = F.count("*"), F.count_if(F.col(label) == 1)
    return labels.agg(
        total.alias("total_customers"),
        positive.alias("churned"),
        F.coalesce(F.round(F.try_divide(positive, total), 4), F.lit(0.0)).alias("churn_rate"),
    )


def stale_snapshot_dates(
    events: DataFrame, snapshots: DataFrame, ts: str = "event_ts", ingested: str = "ingestion_timestamp"
) -> DataFrame:
    """Snapshot dates (with ``_built_at``) that an event on or before them reached after their build.

    One row per date: snapshot_date, built_at, newest_event (the latest arrival among the events
    that count for it). The running maximum is over days, not events.
    """
    arrived = events.groupBy(F.to_date(ts).alias("day")).agg(F.max(F.col(ingested).cast("timestamp")).alias("arrived"))
    built = snapshots.groupBy("snapshot_date").agg(F.min("_built_at").alias("built_at"))
    days = arrived.select("day", "arrived", F.lit(None).cast("timestamp").alias("built_at"))
    days = days.unionByName(built.select(F.col("snapshot_date").alias("day"), F.lit(None).cast("timestamp").alias("arrived"), "built_at"))
    so_far = Window.orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = days.withColumn("newest_event", F.max("arrived").over(so_far)).where("newest_event > built_at")
    return seen.select(F.col("day").alias("snapshot_date"), "built_at", "newest_event")


def stale_label_dates(events: DataFrame, labelled: DataFrame, spec: LabelSpec = LabelSpec(), ingested: str = "ingestion_timestamp") -> DataFrame:
    """Labelled dates whose outcome band holds an outcome that arrived after their labels were made."""
    arrived = (
        events.where(F.col(spec.kind) == spec.outcome)
        .groupBy(F.to_date(spec.ts).alias("_day"))
        .agg(F.max(F.col(ingested).cast("timestamp")).alias("newest_event"))
    )
    band = F.sequence(F.date_sub("_day", spec.horizon), F.date_sub("_day", 1))
    touched = arrived.select(F.explode(band).alias("snapshot_date"), "newest_event")
    touched = touched.groupBy("snapshot_date").agg(F.max("newest_event").alias("newest_event"))
    made = labelled.groupBy("snapshot_date").agg(F.min("_labeled_at").alias("labeled_at"))
    return made.join(touched, "snapshot_date").where("newest_event > labeled_at")


def late_snapshot_dates(
    events: DataFrame,
    snapshot_dates: DataFrame,
    ts: str = "event_ts",
    ingested: str = "ingestion_timestamp",
    reach_days: int | None = None,
) -> DataFrame:
    """Existing snapshot dates whose features a late event changes, with the late rows behind each.

    An event is late for a date when it happened on or before it but was ingested
    after it. With ``reach_days`` only dates that close to the event are listed; by default
    all are, because some features look back without limit. Late events shrink to one row
    per (event day, ingestion day) before they are spread over dates.
    """
    late = (
        events.select(F.to_date(ts).alias("_happened"), F.to_date(ingested).alias("_arrived"))
        .where(F.col("_arrived") > F.col("_happened"))
        .groupBy("_happened", "_arrived")
        .agg(F.count("*").alias("n"))
    )
    last = F.date_sub("_arrived", 1)
    if reach_days is not None:
        last = F.least(last, F.date_add("_happened", reach_days))
    touched = late.select(F.explode(F.sequence("_happened", last)).alias("snapshot_date"), "n")
    per_date = touched.groupBy("snapshot_date").agg(F.sum("n").alias("late_events"))
    return per_date.join(snapshot_dates.select("snapshot_date").distinct(), "snapshot_date", "left_semi")


def _stamp(at: datetime | None) -> Column:
    return F.lit(at).cast("timestamp") if at else F.current_timestamp()
