"""Point-in-time feature snapshots from an event table.

A snapshot for one as-of date is a single conditional aggregate: one scan, one
shuffle with map-side partial results, whatever the number of features. Many
dates at once first collapse events to (entity, day) and then use range frames
over days, so no event is copied per date.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import bands, keys
from tidewell.operators.mutation import latest_per_key


@dataclass(frozen=True)
class Count:
    """Events of one kind, optionally with a column equal to a value."""

    name: str
    kind: str
    column: str | None = None
    equals: str | None = None

    def match(self, kind_col: str) -> Column:
        hit = F.col(kind_col) == self.kind
        if self.column is None:
            return hit
        return hit & F.coalesce(F.col(self.column) == self.equals, F.lit(False))


@dataclass(frozen=True)
class Ratio:
    """numerator / denominator per window; null where the denominator is 0."""

    name: str
    numerator: str
    denominator: str


@dataclass(frozen=True)
class Level:
    """A measured value: latest, mean of the last ``days``, mean of the days before, % change."""

    kind: str
    value: str
    latest: str
    mean: str
    prior_mean: str
    delta: str
    days: int = 30


@dataclass(frozen=True)
class FeatureSpec:
    """What to compute, and the columns to compute it from."""

    entity: str = "customer_id"
    ts: str = "event_ts"
    kind: str = "event_type"
    event_id: str = "event_id"
    windows: tuple[int, ...] = (7, 30, 90)
    counts: tuple[Count, ...] = ()
    ratios: tuple[Ratio, ...] = ()
    level: Level | None = None
    recency: str | None = "days_since_last_activity"
    attributes: tuple[str, ...] = ()
    attribute_date: str = "snapshot_date"


# The features of the customer snapshot.
CUSTOMER_FEATURES = FeatureSpec(
    counts=(
        Count("payment_count", "payment"),
        Count("payment_failures", "payment", "payment_status", "failed"),
        Count("support_call_count", "support_call"),
        Count("complaint_count", "complaint"),
        Count("complaint_high", "complaint", "complaint_severity", "high"),
        Count("plan_change_count", "plan_change"),
        Count("billing_count", "billing"),
        Count("cancellation_count", "cancellation"),
    ),
    ratios=(Ratio("payment_failure_rate", "payment_failures", "payment_count"),),
    level=Level(
        "usage", "usage_gb", "latest_usage_gb", "avg_usage_30d", "avg_usage_prior_30d", "usage_delta_pct"
    ),
    attributes=(
        "tenure", "monthly_charges", "total_charges", "contract",
        "internet_service", "payment_method", "tech_support", "senior_citizen",
    ),
)


def _order_key(events: DataFrame, spec: FeatureSpec) -> Column:
    """Newest-first key of an event: time, then id.

    Integer ids are packed with the time. Other ids go by length, then by text, so that numbered ids
    (``e9``, ``e10``) are in the order of their numbers; that key makes the aggregate sort-based.
    """
    if dict(events.dtypes)[spec.event_id] in ("bigint", "int", "smallint", "tinyint"):
        return keys.recency_key(F.col(spec.ts), F.col(spec.event_id))
    text = F.col(spec.event_id).cast("string")
    return F.struct(F.col(spec.ts).cast("timestamp").alias("ts"), F.length(text).alias("length"), text.alias("id"))


def _ratio_columns(spec: FeatureSpec) -> list[Column]:
    out = []
    for r in spec.ratios:
        for days in spec.windows:
            below = F.col(f"{r.denominator}_{days}d")
            out.append(
                bands.safe_ratio(F.col(f"{r.numerator}_{days}d"), below).alias(f"{r.name}_{days}d")
            )
    return out


def _delta_column(level: Level) -> Column:
    prior = F.col(level.prior_mean)
    return F.when(prior > 0, (F.col(level.mean) - prior) / prior * 100).alias(level.delta)


def feature_names(spec: FeatureSpec) -> list[str]:
    """Output features in table order."""
    names = [f"{c.name}_{d}d" for d in spec.windows for c in spec.counts]
    if spec.level:
        lv = spec.level
        names += [lv.latest, lv.mean, lv.prior_mean, lv.delta]
    if spec.recency:
        names.append(spec.recency)
    names += [f"{r.name}_{d}d" for r in spec.ratios for d in spec.windows]
    return names + list(spec.attributes)


def aggregate_events(events: DataFrame, as_of: date, spec: FeatureSpec) -> DataFrame:
    """Event features of every entity with an event on or before ``as_of``; nothing later is read."""
    past = events.where(bands.up_to(events, spec.ts, as_of))
    aggs: list[Column] = []
    for days in spec.windows:
        recent = bands.lookback(events, spec.ts, as_of, days)
        for c in spec.counts:
            aggs.append(F.count_if(recent & c.match(spec.kind)).alias(f"{c.name}_{days}d"))
    if spec.level:
        lv = spec.level
        hit = F.col(spec.kind) == lv.kind
        value = F.col(lv.value)
        recent = hit & bands.lookback(events, spec.ts, as_of, lv.days)
        before = hit & bands.day_band(events, spec.ts, as_of, 2 * lv.days, lv.days)
        aggs += [
            F.max_by(value, F.when(hit, _order_key(events, spec))).alias(lv.latest),
            F.avg(F.when(recent, value)).alias(lv.mean),
            F.avg(F.when(before, value)).alias(lv.prior_mean),
        ]
    if spec.recency:
        aggs.append(F.max(spec.ts).alias("_last_ts"))
    grouped = past.groupBy(spec.entity).agg(*aggs)
    extra = _ratio_columns(spec)
    if spec.level:
        extra.append(_delta_column(spec.level))
    if spec.recency:
        extra.append(F.datediff(F.lit(as_of), F.col("_last_ts")).alias(spec.recency))
    return grouped.select("*", *extra).drop("_last_ts")


def attributes_as_of(
    snapshots: DataFrame, spec: FeatureSpec, as_of: date | None, entity: str | None = None
) -> DataFrame:
    """Static attributes per entity from its newest snapshot.

    With ``as_of`` only snapshots up to that date count, so a backfill does not see
    later states; with None the newest of all is used.
    """
    key = entity or spec.entity
    rows = snapshots
    if spec.attribute_date in snapshots.columns:
        if as_of is not None:
            rows = rows.where(F.col(spec.attribute_date) <= F.lit(as_of))
        rows = latest_per_key(
            rows.select(key, spec.attribute_date, *spec.attributes), [key], [spec.attribute_date]
        )
    return rows.select(F.col(key).alias(spec.entity), *spec.attributes)


def feature_snapshot(
    events: DataFrame,
    as_of: date,
    spec: FeatureSpec = CUSTOMER_FEATURES,
    snapshots: DataFrame | None = None,
    attributes_known_by_as_of: bool = True,
    built_at: datetime | None = None,
) -> DataFrame:
    """One row per entity: event features, attributes, ``snapshot_date`` and ``_built_at``."""
    rows = aggregate_events(events, as_of, spec)
    names = [n for n in feature_names(spec) if n not in spec.attributes]
    if snapshots is not None and spec.attributes:
        limit = as_of if attributes_known_by_as_of else None
        rows = rows.join(attributes_as_of(snapshots, spec, limit), spec.entity, "left")
        names += list(spec.attributes)
    return rows.select(
        spec.entity,
        *names,
        F.lit(as_of).cast("date").alias("snapshot_date"),
        (F.lit(built_at).cast("timestamp") if built_at else F.current_timestamp()).alias("_built_at"),
    )


def feature_snapshots(
    events: DataFrame,
    start: date,
    end: date,
    spec: FeatureSpec = CUSTOMER_FEATURES,
    built_at: datetime | None = None,
) -> DataFrame:
    """Event features for every as-of date in [start, end], in one job.

    Equal to ``feature_snapshot`` date by date, without attributes (join those with
    ``attributes_for_dates``). Events shrink to one row per entity and day before
    anything is ordered, so an entity holds at most as many rows as it has days.
    """
    past = events.where(bands.up_to(events, spec.ts, end))
    return snapshots_from_days(entity_days(past, spec), start, end, spec, built_at)


def entity_days(events: DataFrame, spec: FeatureSpec = CUSTOMER_FEATURES, day: str = "_day") -> DataFrame:
    """One row per entity and day: counts, the newest value with its order key, sum and number of values, last time.

    The rows of different days, or of any split of the events by day, can be merged.
    """
    partial = [F.count_if(c.match(spec.kind)).alias(f"_n_{c.name}") for c in spec.counts]
    if spec.level:
        hit = F.col(spec.kind) == spec.level.kind
        value = F.col(spec.level.value)
        key = F.when(hit, _order_key(events, spec))
        partial += [
            F.max_by(value, key).alias("_latest"),
            F.max(key).alias("_latest_key"),
            F.count_if(hit).alias("_measured"),
            F.sum(F.when(hit, value)).alias("_sum"),
            F.count(F.when(hit, value)).alias("_values"),
        ]
    partial.append(F.max(spec.ts).alias("_last_ts"))
    return events.where(F.col(spec.ts).isNotNull()).groupBy(spec.entity, F.to_date(F.col(spec.ts)).alias(day)).agg(*partial)


def carried_state(days: DataFrame, state: DataFrame | None, as_of: date, spec: FeatureSpec = CUSTOMER_FEATURES) -> DataFrame:
    """One row per entity: the last time and the newest value up to ``as_of``.

    ``days`` are entity days after those that ``state`` covers, up to ``as_of``.
    """
    names = _state_columns(spec)
    rows = days.select(spec.entity, *names)
    if state is not None:
        rows = rows.unionByName(state.select(spec.entity, *names))
    return rows.groupBy(spec.entity).agg(*_merged_state(spec)).withColumn("state_day", F.lit(as_of).cast("date"))


def _state_columns(spec: FeatureSpec) -> list[str]:
    return ["_last_ts", *(["_latest", "_latest_key"] if spec.level else [])]


def _merged_state(spec: FeatureSpec) -> list[Column]:
    merged = [F.max("_last_ts").alias("_last_ts")]
    if spec.level:
        merged += [F.max_by("_latest", "_latest_key").alias("_latest"), F.max("_latest_key").alias("_latest_key")]
    return merged


def reach(spec: FeatureSpec = CUSTOMER_FEATURES) -> int:
    """How many days before the as-of date the windows look at."""
    return max([*spec.windows, *([2 * spec.level.days] if spec.level else [])])


def snapshot_from_days(
    days: DataFrame,
    state: DataFrame | None,
    as_of: date,
    spec: FeatureSpec = CUSTOMER_FEATURES,
    built_at: datetime | None = None,
    day: str = "_day",
) -> DataFrame:
    """``feature_snapshot`` without attributes, from the entity days within reach and the state before them.

    ``days`` holds the days from ``as_of - reach`` to ``as_of`` and may hold others; ``state`` may cover
    some of these days too, but none after ``as_of``. One aggregate over both, so one shuffle.
    """
    near = lambda n: F.col(day) >= F.lit(as_of - timedelta(days=n))
    rows = days.where(F.col(day) <= F.lit(as_of))
    if state is not None:
        rows = rows.unionByName(state.select(spec.entity, *_state_columns(spec)), allowMissingColumns=True)
    out: list[Column] = []
    for n in spec.windows:
        out += [F.coalesce(F.sum(F.when(near(n), F.col(f"_n_{c.name}"))), F.lit(0)).alias(f"{c.name}_{n}d") for c in spec.counts]
    if spec.level:
        lv = spec.level

        def mean(inside: Column) -> Column:
            return F.try_divide(F.sum(F.when(inside, F.col("_sum"))), F.sum(F.when(inside, F.col("_values"))))

        out += [mean(near(lv.days)).alias(lv.mean), mean(near(2 * lv.days) & ~near(lv.days)).alias(lv.prior_mean)]
    grouped = rows.groupBy(spec.entity).agg(*out, *_merged_state(spec))
    extra = _ratio_columns(spec)
    if spec.level:
        extra += [F.col("_latest").alias(spec.level.latest), _delta_column(spec.level)]
    if spec.recency:
        extra.append(F.datediff(F.lit(as_of), F.col("_last_ts")).alias(spec.recency))
    names = [n for n in feature_names(spec) if n not in spec.attributes]
    stamp = F.lit(built_at).cast("timestamp") if built_at else F.current_timestamp()
    return grouped.select("*", *extra).select(
        spec.entity, *names, F.lit(as_of).cast("date").alias("snapshot_date"), stamp.alias("_built_at")
    )


def snapshots_from_days(
    daily: DataFrame, start: date, end: date, spec: FeatureSpec = CUSTOMER_FEATURES, built_at: datetime | None = None
) -> DataFrame:
    """The snapshots of every date in [start, end] from all entity days up to ``end``."""
    # Each entity's first day carries the probe rows for the requested dates; the
    # windows before and after share the entity partitioning, so this adds no shuffle.
    by_entity = Window.partitionBy(spec.entity)
    first = F.col("_day") == F.min("_day").over(by_entity)
    probes = F.sequence(F.greatest(F.col("_day"), F.lit(start)), F.lit(end))
    tag = lambda d, is_probe: F.struct(d.alias("day"), F.lit(is_probe).alias("probe"))
    with_probes = (
        daily.withColumn("_first", first)
        .withColumn(
            "_slot",
            F.explode(
                F.when(
                    F.col("_first"),
                    F.concat(F.array(tag(F.col("_day"), False)), F.transform(probes, lambda d: tag(d, True))),
                ).otherwise(F.array(tag(F.col("_day"), False)))
            ),
        )
        .withColumns({"_day": F.col("_slot.day"), "_probe": F.col("_slot.probe")})
    )
    real = ~F.col("_probe")
    number = F.unix_date("_day")
    ordered = by_entity.orderBy(number)
    so_far = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def over_days(column: str, far: int, near: int = 0) -> Column:
        frame = ordered.rangeBetween(-far, -near)
        return F.sum(F.when(real, F.col(column))).over(frame)

    out: list[Column] = []
    for days in spec.windows:
        for c in spec.counts:
            total = F.coalesce(over_days(f"_n_{c.name}", days), F.lit(0))
            out.append(total.alias(f"{c.name}_{days}d"))
    if spec.level:
        lv = spec.level
        seen = real & (F.col("_measured") > 0)
        latest = F.last(F.when(seen, F.struct(F.col("_latest").alias("v"))), ignorenulls=True)
        prior_far, prior_near = 2 * lv.days, lv.days + 1
        out += [
            latest.over(so_far)["v"].alias(lv.latest),
            F.try_divide(over_days("_sum", lv.days), over_days("_values", lv.days)).alias(lv.mean),
            F.try_divide(
                over_days("_sum", prior_far, prior_near), over_days("_values", prior_far, prior_near)
            ).alias(lv.prior_mean),
        ]
    if spec.recency:
        last_day = F.max(F.when(real, F.col("_day"))).over(so_far)
        out.append(F.datediff(F.col("_day"), last_day).alias(spec.recency))
    wide = with_probes.select(spec.entity, F.col("_day").alias("snapshot_date"), "_probe", *out)
    extra = _ratio_columns(spec)
    if spec.level:
        extra.append(_delta_column(spec.level))
    names = [n for n in feature_names(spec) if n not in spec.attributes]
    return (
        wide.where("_probe")
        .select("*", *extra)
        .select(
            spec.entity,
            *names,
            "snapshot_date",
            (F.lit(built_at).cast("timestamp") if built_at else F.current_timestamp()).alias("_built_at"),
        )
    )


def attributes_for_dates(
    features: DataFrame, snapshots: DataFrame, spec: FeatureSpec, date_col: str = "snapshot_date"
) -> DataFrame:
    """Join each (entity, date) row with the newest attribute snapshot on or before that date.

    An as-of join by a tagged union and a running last value per entity, so no range
    join is needed. An entity holds one row per date on either side.
    """
    attrs = F.struct(*spec.attributes)
    left = features.select(F.struct(*features.columns).alias("_row"), spec.entity, F.col(date_col).alias("_d"))
    facts = left.withColumns({"_a": F.lit(None).cast(snapshots.select(attrs.alias("a")).schema["a"].dataType), "_side": F.lit(1)})
    dims = snapshots.select(
        F.lit(None).cast(facts.schema["_row"].dataType).alias("_row"),
        F.col(spec.entity),
        F.col(spec.attribute_date).alias("_d"),
        attrs.alias("_a"),
        F.lit(0).alias("_side"),
    )
    upto = (
        Window.partitionBy(spec.entity)
        .orderBy("_d", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        facts.unionByName(dims)
        .withColumn("_known", F.last("_a", ignorenulls=True).over(upto))
        .where(F.col("_side") == 1)
        .select("_row.*", *[F.col(f"_known.{a}").alias(a) for a in spec.attributes])
    )


def dates_in(start: date, end: date) -> Sequence[date]:
    """Every date in [start, end]; empty when start is after end."""
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]
