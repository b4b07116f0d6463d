"""Date windows, value bands and score bands as predicates and labels."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Alert limits on PSI and the share of the threshold where Medium risk starts.
PSI_SIGNIFICANT = 0.25
PSI_MODERATE = 0.10
MEDIUM_SHARE = 0.6


def day_start(df: DataFrame, ts_col: str, day: date) -> Column:
    """Midnight of ``day`` as a literal of the column's own type.

    Matching the type (timestamp with or without zone) keeps the comparison free
    of casts on the column, so it reaches the parquet scan as a pushed filter.
    """
    text = datetime.combine(day, time.min).strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(text).cast(df.schema[ts_col].dataType)


def up_to(df: DataFrame, ts_col: str, as_of: date) -> Column:
    """Event time on or before the as-of date, including its last fraction of a second."""
    return F.col(ts_col) < day_start(df, ts_col, as_of + timedelta(days=1))


def lookback(df: DataFrame, ts_col: str, as_of: date, days: int) -> Column:
    """Event time at or after midnight, ``days`` days before the as-of date.

    The as-of day itself counts too, so N days back spans N + 1 calendar days.
    """
    return F.col(ts_col) >= day_start(df, ts_col, as_of - timedelta(days=days))


def day_band(df: DataFrame, ts_col: str, as_of: date, far: int, near: int) -> Column:
    """Event time in [as_of - far, as_of - near), both at midnight."""
    c = F.col(ts_col)
    return (c >= day_start(df, ts_col, as_of - timedelta(days=far))) & (
        c < day_start(df, ts_col, as_of - timedelta(days=near))
    )


def outcome_band(df: DataFrame, ts_col: str, as_of: date, horizon: int) -> Column:
    """Event time strictly after the as-of day, up to the end of the maturity day."""
    c = F.col(ts_col)
    return (c >= day_start(df, ts_col, as_of + timedelta(days=1))) & (
        c < day_start(df, ts_col, as_of + timedelta(days=horizon + 1))
    )


def check_threshold(threshold: float) -> float:
    if not math.isfinite(threshold) or not 0 < threshold <= 1:
        raise ValueError(f"threshold must lie in (0, 1], got {threshold}")
    return float(threshold)


def risk_segment(probability: Column, threshold: Column | float, strict: bool = True) -> Column:
    """High at or above the threshold, Medium at or above 0.6 of it, else Low.

    ``strict`` fails the job on a null, NaN or out-of-range probability instead
    of calling the row Low.
    """
    limit = F.lit(check_threshold(threshold)) if isinstance(threshold, (int, float)) else threshold
    label = (
        F.when(probability >= limit, "High")
        .when(probability >= limit * F.lit(MEDIUM_SHARE), "Medium")
        .otherwise("Low")
    )
    if not strict:
        return label
    usable = probability.isNotNull() & ~F.isnan(probability) & probability.between(0.0, 1.0)
    problem = F.concat(
        F.lit("probability must be finite and in [0, 1]: "),
        F.coalesce(probability.cast("string"), F.lit("null")),
    )
    return F.when(usable, label).otherwise(F.raise_error(problem).cast("string"))


def alert_level(psi: Column) -> Column:
    return (
        F.when(psi > PSI_SIGNIFICANT, "significant").when(psi > PSI_MODERATE, "moderate").otherwise("none")
    )


def fixed_width_bin(value: Column, width: float, top: int | None = None) -> Column:
    """Zero-based bin number of the given width; ``top`` makes the last bin open-ended."""
    index = F.floor(value / F.lit(float(width))).cast("int")
    return index if top is None else F.least(index, F.lit(top))


def edge_bin(value: Column, edges: Column) -> Column:
    """One-based bin over ascending edges: right-open bins, last one closed, null outside.

    ``edges`` is an array column. Values below the first or above the last edge get null.
    """
    below_or_at = F.size(F.filter(edges, lambda e: e <= value))
    bins = F.size(edges) - 1
    inside = (value >= F.element_at(edges, 1)) & (value <= F.element_at(edges, -1))
    return F.when(inside & (bins >= 1), F.least(below_or_at, bins))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def quoted_all(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]
