"""Declarative quality rules: fail, quarantine or warn, evaluated in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from enum import Enum
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import clean
from tidewell.sources.contract import EVENT_TYPES

FIRST_BROKEN = "_first_broken"
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"


class Severity(str, Enum):
    FAIL = "fail"
    QUARANTINE = "quarantine"
    WARN = "warn"


class RuleFailed(ValueError):
    """A rule of severity ``fail`` has violations."""


@dataclass(frozen=True)
class Rule:
    """``valid`` builds a predicate that is true for good rows; false and null are violations."""

    name: str
    description: str
    severity: Severity
    valid: Callable[[], Column]

    def violated(self) -> Column:
        return ~F.coalesce(self.valid(), F.lit(False))


def plausible_time(column: str, first: str = "2020-01-01", last: str = "2030-01-01") -> Column:
    """Text that parses as an ISO time in [first, last)."""
    ts = F.try_to_timestamp(F.col(column), F.lit(ISO_PATTERN))
    return (ts >= F.lit(first).cast("timestamp")) & (ts < F.lit(last).cast("timestamp"))


def absent_or_non_negative(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) >= 0)


# Rule names, descriptions and severities of the two rule sets.
EVENT_RULES = (
    Rule(
        "event_id_not_null",
        "event_id is required for dedup and lineage",
        Severity.QUARANTINE,
        lambda: clean.has_text(F.col("event_id")),
    ),
    Rule(
        "customer_id_not_null",
        "customer_id is required for attribution",
        Severity.QUARANTINE,
        lambda: clean.has_text(F.col("customer_id")),
    ),
    Rule(
        "event_timestamp_plausible",
        "event_timestamp must parse and be within 2020-2030",
        Severity.QUARANTINE,
        lambda: plausible_time("event_timestamp"),
    ),
    Rule(
        "event_type_in_contract",
        "event_type must be one of the contract-defined values",
        Severity.QUARANTINE,
        lambda: F.col("event_type").isin(*EVENT_TYPES),
    ),
    Rule(
        "amount_non_negative",
        "amount must be >= 0 when present",
        Severity.WARN,
        lambda: absent_or_non_negative("amount"),
    ),
    Rule(
        "usage_gb_non_negative",
        "usage_gb must be >= 0 when present",
        Severity.WARN,
        lambda: absent_or_non_negative("usage_gb"),
    ),
    Rule(
        "schema_version_present",
        "schema_version is required for contract evolution",
        Severity.WARN,
        lambda: F.col("schema_version").isNotNull(),
    ),
)

SNAPSHOT_RULES = (
    Rule(
        "customer_id_not_null",
        "customer_id is the Silver primary key",
        Severity.QUARANTINE,
        lambda: clean.has_text(F.col("customer_id")),
    ),
    Rule(
        "churn_label_valid",
        "churn_label must be 0 or 1",
        Severity.QUARANTINE,
        lambda: F.col("churn_label").isin(0, 1),
    ),
    Rule(
        "senior_citizen_not_null",
        "senior_citizen must be numeric",
        Severity.QUARANTINE,
        lambda: F.col("senior_citizen").isNotNull(),
    ),
    Rule(
        "monthly_charges_not_null",
        "monthly_charges must be numeric",
        Severity.QUARANTINE,
        lambda: F.col("monthly_charges").isNotNull(),
    ),
    Rule(
        "tenure_valid",
        "tenure must be non-negative",
        Severity.QUARANTINE,
        lambda: F.col("tenure") >= 0,
    ),
    Rule(
        "total_charges_consistent",
        "total_charges must be present for nonzero tenure",
        Severity.WARN,
        lambda: (F.col("tenure") == 0) | F.col("total_charges").isNotNull(),
    ),
)


@dataclass(frozen=True)
class QualityCheck:
    """The three results of a rule set over one frame; all lazy, each one scan.

    Rules count in order. A quarantined row leaves the stream at the first
    quarantine rule it breaks, so later rules do not see it.
    """

    df: DataFrame
    rules: Sequence[Rule]
    run_id: str = ""
    stage: str = ""
    at: datetime | None = None

    def _stamp(self) -> Column:
        return F.lit(self.at).cast("timestamp") if self.at else F.current_timestamp()

    def _first_broken(self) -> Column:
        """Index of the first quarantine rule that the row breaks, else null."""
        steps = [(i, r) for i, r in enumerate(self.rules) if r.severity is Severity.QUARANTINE]
        if not steps:
            return F.lit(None).cast("int")
        head, *tail = steps
        chain = F.when(head[1].violated(), F.lit(head[0]))
        return reduce(lambda c, s: c.when(s[1].violated(), F.lit(s[0])), tail, chain)

    def clean(self) -> DataFrame:
        """Rows that break no quarantine rule."""
        return self.df.where(self._first_broken().isNull())

    def quarantine(self) -> DataFrame:
        """Removed rows as JSON, each once, under the first rule it broke."""
        tagged = self.df.withColumn(FIRST_BROKEN, self._first_broken())
        names = F.array(*[F.lit(r.name) for r in self.rules])
        texts = F.array(*[F.lit(r.description) for r in self.rules])
        return tagged.where(F.col(FIRST_BROKEN).isNotNull()).select(
            F.to_json(F.struct(*[F.col(f"`{c}`") for c in self.df.columns])).alias("original_payload"),
            F.get(names, F.col(FIRST_BROKEN)).alias("violated_rule"),
            F.get(texts, F.col(FIRST_BROKEN)).alias("violation_description"),
            F.lit(self.run_id).alias("ingestion_run_id"),
            self._stamp().alias("quarantined_at"),
        )

    def metrics(self) -> DataFrame:
        """One row per rule with its counts, from a single aggregate over the input."""
        flags = self.df.select(
            self._first_broken().alias(FIRST_BROKEN),
            *[r.violated().alias(f"_v{i}") for i, r in enumerate(self.rules)],
        )
        counts = []
        for i in range(len(self.rules)):
            seen = F.col(FIRST_BROKEN).isNull() | (F.col(FIRST_BROKEN) >= i)
            counts.append(F.count_if(seen).alias(f"t{i}"))
            counts.append(F.count_if(seen & F.col(f"_v{i}")).alias(f"b{i}"))
        rows = F.array(
            *[
                F.struct(
                    F.lit(i).alias("rule_order"),
                    F.lit(r.name).alias("rule_name"),
                    F.lit(r.severity.value).alias("severity"),
                    F.col(f"t{i}").alias("total_rows"),
                    (F.col(f"t{i}") - F.col(f"b{i}")).alias("passing_rows"),
                    F.col(f"b{i}").alias("violating_rows"),
                )
                for i, r in enumerate(self.rules)
            ]
        )
        return (
            flags.agg(*counts)
            .select(F.inline(rows))
            .select(
                "rule_order",
                "rule_name",
                "severity",
                "total_rows",
                "passing_rows",
                "violating_rows",
                F.lit(self.stage).alias("stage"),
                F.lit(self.run_id).alias("run_id"),
                self._stamp().alias("evaluated_at"),
            )
        )

    def enforce(self) -> list:
        """Run the metrics; raise for the first broken fail rule, else return them in order."""
        found = self.metrics().orderBy("rule_order").collect()
        described = {r.name: r.description for r in self.rules}
        for row in found:
            if row.severity == Severity.FAIL.value and row.violating_rows:
                raise RuleFailed(
                    f"rule '{row.rule_name}' violated by {row.violating_rows} rows: "
                    f"{described[row.rule_name]}"
                )
        return found


def apply_rules(store, df: DataFrame, rules: Sequence[Rule], run_id: str, stage: str, at: datetime | None = None):
    """Check, write quarantine and metrics to their tables, and return (clean, metric rows)."""
    check = QualityCheck(df, rules, run_id, stage, at)
    found = check.enforce()
    if any(r.severity == Severity.QUARANTINE.value and r.violating_rows for r in found):
        store.append("quarantine", check.quarantine())
    schema = check.metrics().drop("rule_order").schema
    rows = [tuple(r)[1:] for r in found]
    store.append("data_quality_metrics", store.spark.createDataFrame(rows, schema))
    return check.clean(), found
