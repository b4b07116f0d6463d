"""Raw customer rows to a typed snapshot, and the segment summary over it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import clean
from tidewell.operators.mutation import latest_per_key
from tidewell.sources.contract import SEED_COLUMNS
from tidewell.sources.readers import require_columns

# Seed column -> snapshot column for the attributes that are only trimmed.
TRIMMED = {
    "gender": "gender",
    "Partner": "partner",
    "Dependents": "dependents",
    "PhoneService": "phone_service",
    "MultipleLines": "multiple_lines",
    "InternetService": "internet_service",
    "OnlineSecurity": "online_security",
    "OnlineBackup": "online_backup",
    "DeviceProtection": "device_protection",
    "TechSupport": "tech_support",
    "StreamingTV": "streaming_tv",
    "StreamingMovies": "streaming_movies",
    "Contract": "contract",
    "PaperlessBilling": "paperless_billing",
    "PaymentMethod": "payment_method",
}
# Column order of the snapshot table.
SNAPSHOT_COLUMNS = (
    "customer_id", "snapshot_date", "gender", "senior_citizen", "partner", "dependents", "tenure",
    "phone_service", "multiple_lines", "internet_service", "online_security", "online_backup",
    "device_protection", "tech_support", "streaming_tv", "streaming_movies", "contract",
    "paperless_billing", "payment_method", "monthly_charges", "total_charges", "churn",
    "churn_label", "_transformed_at",
)


def conform_customers(bronze: DataFrame, snapshot_date: date, at: datetime | None = None) -> DataFrame:
    """Rename, trim and cast the 21 seed columns to the 24-column snapshot.

    Unparsable numbers become null, so the quality rules can route them.
    """
    require_columns(bronze, SEED_COLUMNS, "bronze")
    built: dict[str, Column] = {new: F.trim(F.col(old)) for old, new in TRIMMED.items()}
    built |= {
        "customer_id": F.trim(F.col("customerID")),
        "snapshot_date": F.lit(snapshot_date).cast("date"),
        "senior_citizen": clean.to_number(F.col("SeniorCitizen"), "int"),
        "tenure": clean.to_number(F.col("tenure"), "int"),
        "monthly_charges": clean.to_number(F.col("MonthlyCharges")),
        "total_charges": clean.to_number(F.col("TotalCharges")),
        "churn": clean.title_case(F.col("Churn")),
        "churn_label": clean.yes_no_flag(F.col("Churn")),
        "_transformed_at": F.lit(at).cast("timestamp") if at else F.current_timestamp(),
    }
    return bronze.select(*[built[name].alias(name) for name in SNAPSHOT_COLUMNS])


def segment_summary(
    snapshots: DataFrame,
    segments: Sequence[str] = ("contract", "internet_service", "payment_method"),
    entity: str = "customer_id",
    snapshot_date: str | None = "snapshot_date",
    label: str = "churn_label",
    charge: str = "monthly_charges",
    tenure: str = "tenure",
) -> DataFrame:
    """Size, labelled share and averages per segment, each entity at its newest snapshot.

    Pass ``snapshot_date=None`` to aggregate all rows as they are.
    """
    rows = snapshots
    if snapshot_date and snapshot_date in snapshots.columns:
        rows = latest_per_key(
            snapshots.select(entity, snapshot_date, *segments, label, charge, tenure),
            [entity],
            [snapshot_date],
        )
    return rows.groupBy(*segments).agg(
        F.count("*").alias("customers"),
        F.sum(label).alias("churned_customers"),
        F.round(F.avg(label), 4).alias("churn_rate"),
        F.avg(charge).alias("avg_monthly_charge"),
        F.avg(tenure).alias("avg_tenure"),
    )
