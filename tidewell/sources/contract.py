"""The versioned customer-event contract and its checks as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import clean

# Version, enum domains and fields of the event contract.
CONTRACT_VERSION = 1
SUPPORTED_VERSIONS = (1,)
EVENT_TYPES = ("billing", "cancellation", "complaint", "payment", "plan_change", "support_call", "usage")
PAYMENT_STATUSES = ("failed", "succeeded")
COMPLAINT_SEVERITIES = ("high", "medium")
SUPPORT_TOPICS = ("billing", "connectivity", "service_quality", "technical")

_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    type_name: str = "string"
    required: bool = False


@dataclass(frozen=True)
class Contract:
    """Ordered fields, enum domains per field and the accepted versions."""

    fields: tuple[Field, ...]
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    version_field: str | None = "schema_version"
    versions: tuple[int, ...] = SUPPORTED_VERSIONS

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return sorted(f.name for f in self.fields if f.required)

    def struct_type(self, relaxed: bool = False) -> T.StructType:
        """The contract as a Spark schema. ``relaxed`` makes every field nullable, for reading."""
        return T.StructType(
            [T.StructField(f.name, _TYPES[f.type_name], relaxed or not f.required) for f in self.fields]
        )


EVENT_CONTRACT = Contract(
    fields=(
        Field("schema_version", "integer", True),
        Field("event_id", "string", True),
        Field("generation_id"),
        Field("event_type", "string", True),
        Field("event_timestamp", "string", True),
        Field("event_date", "string", True),
        Field("customer_id", "string", True),
        Field("amount", "double"),
        Field("usage_gb", "double"),
        Field("payment_status"),
        Field("support_topic"),
        Field("plan_from"),
        Field("plan_to"),
        Field("complaint_severity"),
        Field("cancellation_reason"),
    ),
    domains={
        "event_type": EVENT_TYPES,
        "payment_status": PAYMENT_STATUSES,
        "complaint_severity": COMPLAINT_SEVERITIES,
        "support_topic": SUPPORT_TOPICS,
    },
)

# The columns of the customer seed file, in file order.
SEED_COLUMNS = (
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling",
    "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
)


def parse_with_rescue(raw: DataFrame, contract: Contract, text: str = "value") -> DataFrame:
    """Parse a JSON text column by contract; keep unknown fields as JSON in ``_rescued_data``.

    Other columns of ``raw`` are carried along. A malformed line gives nulls in
    every contract field and keeps its text in ``_rescued_data``.
    """
    held = {"_event": F.from_json(F.col(text), contract.struct_type(relaxed=True)), "_event_map": F.from_json(F.col(text), "map<string,string>")}
    # A column of its own: an expression used in several places would parse the line again in each.
    parsed = raw.withColumns(held).withColumn("_event_unknown", F.map_filter("_event_map", lambda k, _: ~k.isin(*contract.names)))
    malformed = F.col("_event_map").isNull() & F.col(text).isNotNull()
    carried = [c for c in raw.columns if c != text]
    return parsed.select(
        *[F.col(f"_event.{n}").alias(n) for n in contract.names],
        F.when(malformed, F.col(text))
        .when(F.size("_event_unknown") > 0, F.to_json("_event_unknown"))
        .alias("_rescued_data"),
        *carried,
    )


def violation_messages(
    contract: Contract,
    present: Iterable[str] | None = None,
    field_names: Column | None = None,
) -> Column:
    """All contract violations of a row as an array of messages; empty when it conforms.

    ``present`` names the columns the frame has; fields outside it count as missing.
    ``field_names`` is an array column with the raw field names, to report unknown ones.
    """
    have = set(contract.names if present is None else present)
    checks: list[Column] = []
    for name in contract.required:
        message = F.lit(f"missing required field: {name}")
        checks.append(F.when(F.col(name).isNull(), message) if name in have else message)
    for name, allowed in sorted(contract.domains.items()):
        if name in have:
            value = F.col(name)
            bad = value.isNotNull() & (value != "") & ~value.isin(*allowed)
            checks.append(F.when(bad, F.concat(F.lit(f"invalid {name}: "), value)))
    if contract.version_field in have:
        version = F.col(contract.version_field)
        bad = version.isNotNull() & ~version.isin(*contract.versions)
        checks.append(F.when(bad, F.concat(F.lit("unsupported schema_version: "), version.cast("string"))))
    messages = F.filter(F.array(*checks), lambda m: m.isNotNull())
    if field_names is None:
        return messages
    known = F.array(*[F.lit(n) for n in contract.names])
    strangers = F.transform(
        F.array_sort(F.array_except(field_names, known)),
        lambda n: F.concat(F.lit("unknown field: "), n),
    )
    return F.concat(messages, F.coalesce(strangers, F.array().cast("array<string>")))


def raw_field_names(text: Column) -> Column:
    """The top-level field names of a JSON object in text form."""
    return F.json_object_keys(text)


@dataclass(frozen=True)
class StateColumns:
    """Columns of an entity snapshot that the state check reads."""

    entity: str = "customer_id"
    tenure: str = "tenure"
    charge: str = "monthly_charges"
    label: str = "churn_label"
    texts: Sequence[str] = ("contract", "internet_service", "payment_method", "tech_support")


def validate_entity_state(df: DataFrame, columns: StateColumns = StateColumns()) -> DataFrame:
    """Clean an entity snapshot and add ``state_errors``, an array of messages.

    Blank texts become 'Unknown'; ids are trimmed. Rows are kept, so a caller can
    route the ones with errors.
    """
    c = columns
    entity = clean.blank_to_null(F.col(c.entity).cast("string"))
    checks = [
        F.when(entity.isNull(), F.lit(f"{c.entity} is required")),
        F.when(~F.coalesce(F.col(c.tenure) >= 0, F.lit(False)), F.lit("tenure must be non-negative")),
        F.when(
            ~F.coalesce(F.col(c.charge) >= 0, F.lit(False)), F.lit("monthly_charges must be non-negative")
        ),
        F.when(
            ~F.coalesce(F.col(c.label).isin(0, 1), F.lit(False)), F.lit("churn_label must be 0 or 1")
        ),
    ]
    replaced = {t: clean.known_or(F.col(t)) for t in c.texts}
    replaced["state_errors"] = F.filter(F.array(*checks), lambda m: m.isNotNull())
    if dict(df.dtypes)[c.entity] == "string":
        replaced[c.entity] = F.trim(F.col(c.entity))
    return df.withColumns(replaced)
