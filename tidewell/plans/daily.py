"""The daily flow, the scoring flow and the backfill, on top of the operators.

Each function does one task: read its tables, build one lazy plan, write the result
and log the run. They are meant to be called by whatever scheduler is in place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import bands
from tidewell.operators import conform, drift, features, governance, labels, quality, scoring
from tidewell.operators.mutation import latest_per_key, require_unique
from tidewell.operators.runlog import track_run
from tidewell.session import staged
from tidewell.sources.readers import read_seed_csv
from tidewell.sources.tables import TableStore, WriteResult
from tidewell.streaming.ingest import ARRIVALS, BRONZE, DAY, IngestSettings, ingest_events, ingest_summary

EVENTS = BRONZE
DAYS = "entity_days"
STATE = "entity_state"
CUSTOMERS_RAW = "customer_bronze"
CUSTOMERS = "customer_silver"
SUMMARY = "churn_summary"
FEATURES = "gold_feature_snapshot"
LABELS = "gold_labels"
HISTORY = "prediction_history"
RUNS = "prediction_runs"
CURRENT = "customer_current"
BASELINE = "training_value_counts"
DRIFT = "drift_metrics"
CANDIDATES = "model_candidate_metrics"
CHAMPION = "model_validation_metrics"
PROMOTIONS = "model_promotion_history"
SNAPSHOT_KEY = ("customer_id", "snapshot_date")


def seed_customers(store: TableStore, csv_path: str) -> WriteResult:
    """Load the seed file once."""
    with track_run(store, "seed") as run:
        result = store.seed(CUSTOMERS_RAW, read_seed_csv(store.spark, csv_path), "csv_seed")
        run.output = {"status": result.status, "rows": result.rows}
    return result


def ingest(store: TableStore, landing: str, checkpoint: str, settings: IngestSettings = IngestSettings()) -> DataFrame:
    """Drain the landing folder into the bronze and reject tables; returns bronze."""
    with track_run(store, "ingest_events") as run:
        ingest_events(store, landing, checkpoint, settings)
        bronze = store.read(EVENTS)
        summary = ingest_summary(bronze).first()
        run.output = summary.asDict()
        if summary.rescued_rows:
            # The producer is ahead of the contract.
            run.output["warning"] = "rows carry fields outside the contract"
    return bronze


def check_events(store: TableStore, events: DataFrame, run_id: str) -> DataFrame:
    """Apply the event rules: quarantine and metrics to their tables, clean rows returned."""
    clean, metrics = quality.apply_rules(store, events, quality.EVENT_RULES, run_id, "bronze_events")
    total = metrics[0].total_rows
    lost = sum(m.violating_rows for m in metrics if m.severity == "quarantine")
    if total == lost:
        raise quality.RuleFailed("no event survived the quality rules")
    return clean


def build_customer_snapshot(store: TableStore, snapshot_date: date, run_id: str | None = None) -> WriteResult:
    """Bronze to typed snapshot with quarantine, upsert, and the segment summary."""
    run_id = run_id or f"transform-{snapshot_date.isoformat()}"
    with track_run(store, "transform", run_id) as run:
        now = datetime.now(timezone.utc)
        conformed = conform.conform_customers(store.read(CUSTOMERS_RAW), snapshot_date, now)
        # Rules, uniqueness check and upsert all read the one conformed copy.
        with staged(conformed, "conformed") as typed:
            clean, metrics = quality.apply_rules(store, typed, quality.SNAPSHOT_RULES, run_id, "silver", now)
            if clean.isEmpty():
                raise quality.RuleFailed("no row survived the quality rules")
            require_unique(clean, ["customer_id"])
            result = store.upsert(CUSTOMERS, clean, SNAPSHOT_KEY, "snapshot_date")
            merge_current(store, clean)
        store.overwrite(SUMMARY, conform.segment_summary(store.read(CURRENT), snapshot_date=None))
        run.output = {
            "status": result.status,
            "snapshot_date": snapshot_date,
            "silver_rows": result.rows,
            "quarantined_rows": sum(m.violating_rows for m in metrics if m.severity == "quarantine"),
            "quality_rules_evaluated": len(metrics),
        }
    return result


def build_feature_snapshot(
    store: TableStore, events: DataFrame, as_of: date, built_at: datetime | None = None
) -> WriteResult:
    """Features of one as-of date into their partition; skipped when there is no event yet."""
    with track_run(store, "build_features", f"build-features-{as_of.isoformat()}") as run:
        customers = customers_known_by(store, as_of) if store.exists(CUSTOMERS) else None
        if events.where(bands.up_to(events, "event_ts", as_of)).isEmpty():
            run.status, run.output = "skipped", {"reason": "no events on or before as_of_date"}
            return WriteResult("skipped", 0)
        rows = features.feature_snapshot(events, as_of, snapshots=customers, built_at=built_at)
        result = store.replace_partition(FEATURES, rows, "snapshot_date", as_of)
        run.output = {"as_of_date": as_of, "customers": result.rows, "features": len(rows.columns) - 3}
    return result


def clean_events(store: TableStore, days: Sequence[date] | None = None) -> DataFrame:
    """Bronze events that break no quarantine rule, of all days or of those given."""
    events = store.read(EVENTS) if days is None else store.read_partitions(EVENTS, DAY, days)
    return quality.QualityCheck(events, quality.EVENT_RULES).clean()


def pending_arrivals(store: TableStore, consumer: str) -> tuple[DataFrame, dict[str, int]]:
    """Arrivals that a table does not cover yet, and the marks to store with it once it does.

    A batch counts when bronze has it. Batches are told by the folders of the log, so neither events
    nor older arrivals are read.
    """
    bronze, log, seen = store.version(EVENTS), store.version(ARRIVALS), store.version(consumer)
    have = seen.marks if seen else {}
    marks = {s: n for s, n in bronze.marks.items() if n > have.get(s, -1)} if bronze else {}

    def fresh(path: str) -> bool:
        source, batch = (part.split("=", 1)[1] for part in path.split("/"))
        return have.get(source, -1) < int(batch) <= marks.get(source, -1)

    return store.scan(ARRIVALS, log.only(p for ps in log.parts.values() for p in ps if fresh(p))), marks


def refresh_days(store: TableStore) -> Sequence[date]:
    """Bring the entity days up to what bronze holds: only days with new events are read and replaced.

    Stored states from the first of these days on are dropped. Returns the days; a second call finds none.
    """
    if not store.exists(EVENTS):
        return []
    arrivals, marks = pending_arrivals(store, DAYS)
    if not marks:
        return []
    days = sorted(r[0] for r in arrivals.where(F.col(DAY).isNotNull()).select(DAY).distinct().collect())
    stale = [d for d in stored_dates(store, STATE, "state_day") if days and d >= days[0]]
    if stale:
        store.replace_partitions(STATE, store.read(STATE).limit(0), "state_day", stale)
    rows = features.entity_days(clean_events(store, days), day=DAY)
    store.replace_partitions(DAYS, rows, DAY, days, marks)
    return days


def state_before(store: TableStore, as_of: date) -> DataFrame | None:
    """A state that, with the days within reach, tells all about the entities as of a date.

    Any stored state of the last ``reach + 1`` days will do. Otherwise one is made for the day before
    the reach, from the newest older state and the days since, and stored.
    """
    spec, edge = features.CUSTOMER_FEATURES, as_of - timedelta(days=features.reach() + 1)
    stored = [d for d in stored_dates(store, STATE, "state_day") if d <= as_of]
    if stored and stored[-1] >= edge:
        return store.read_partitions(STATE, "state_day", [stored[-1]])
    older = stored[-1] if stored else None
    days = [d for d in stored_dates(store, DAYS, DAY) if d <= edge and (older is None or d > older)]
    if older is None and not days:
        return None
    state = store.read_partitions(STATE, "state_day", [older]) if older else None
    store.replace_partition(STATE, features.carried_state(store.read_partitions(DAYS, DAY, days), state, edge, spec), "state_day", edge)
    return store.read_partitions(STATE, "state_day", [edge])


def build_snapshot_from_days(store: TableStore, as_of: date, built_at: datetime | None = None) -> WriteResult:
    """Features of one date from the entity days within reach and a carried state; events are not read.

    The state as of the date is stored as well, so the next snapshot reads at most ``reach + 1`` days.
    """
    with track_run(store, "build_features", f"build-features-{as_of.isoformat()}") as run:
        spec = features.CUSTOMER_FEATURES
        first = as_of - timedelta(days=features.reach())
        state = state_before(store, as_of)
        held = state.first() if state is not None else None
        within = [d for d in stored_dates(store, DAYS, DAY) if first <= d <= as_of]
        days = store.read_partitions(DAYS, DAY, within)
        rows = features.snapshot_from_days(days, state, as_of, spec, built_at, DAY)
        if store.exists(CUSTOMERS):
            rows = features.attributes_for_dates(rows, store.read(CUSTOMERS), spec)
        rows = rows.select(*_feature_order(rows), "snapshot_date", "_built_at")
        covered = store.version(DAYS).marks if not stored_dates(store, FEATURES) else None
        result = store.replace_partitions(FEATURES, rows, "snapshot_date", [as_of], covered)
        if held is None or held.state_day < as_of:
            since = store.read_partitions(DAYS, DAY, [d for d in within if held is None or d > held.state_day])
            store.replace_partition(STATE, features.carried_state(since, state, as_of, spec), "state_day", as_of)
        run.output = {"as_of_date": as_of, "customers": result.rows}
    return result


def repair_features(store: TableStore, built_at: datetime | None = None) -> Sequence[date]:
    """Redo the rows of stored snapshots that events arrived since touch; returns the dates rewritten.

    Touched are the entities of the new arrivals, on every stored date from the first new event's day on.
    Their entity days are read, no events. The marks go with the rows: a second call finds nothing.
    """
    refresh_days(store)
    if not store.exists(FEATURES):
        return []
    arrivals, marks = pending_arrivals(store, FEATURES)
    if not marks:
        return []
    spec = features.CUSTOMER_FEATURES
    with staged(arrivals.where(F.col(DAY).isNotNull()).groupBy(spec.entity).agg(F.min(DAY).alias("_first")), "touched") as touched:
        first = touched.agg(F.min("_first")).first()[0]
        dates = [d for d in stored_dates(store, FEATURES) if first and d >= first]
        old = store.read_partitions(FEATURES, "snapshot_date", dates)
        if not dates:
            store.replace_partitions(FEATURES, old.limit(0), "snapshot_date", [], marks)
            return []
        days = store.read_partitions(DAYS, DAY, [d for d in stored_dates(store, DAYS, DAY) if d <= dates[-1]])
        days = days.join(touched, spec.entity, "left_semi").withColumnRenamed(DAY, "_day")
        rows = features.snapshots_from_days(days, dates[0], dates[-1], spec, built_at)
        rows = rows.join(touched, spec.entity).where(F.col("snapshot_date").isin(dates) & (F.col("snapshot_date") >= F.col("_first")))
        if store.exists(CUSTOMERS):
            rows = features.attributes_for_dates(rows, store.read(CUSTOMERS), spec)
        rows = rows.select(*_feature_order(rows), "snapshot_date", "_built_at")
        with staged(rows, "repaired") as redone:
            kept = old.join(redone, [spec.entity, "snapshot_date"], "left_anti")
            store.replace_partitions(FEATURES, kept.unionByName(redone, allowMissingColumns=True), "snapshot_date", dates, marks)
    return dates


def repair_labels(store: TableStore, horizon: int = labels.HORIZON_DAYS, labeled_at: datetime | None = None) -> Sequence[date]:
    """Set the labels whose outcome band got an outcome since; returns the dates rewritten.

    An event is never taken back, so a late one can only turn a label to 1. Only the arrivals and
    the labels of the dates in reach are read. A second call finds nothing.
    """
    if not (store.exists(LABELS) and store.exists(EVENTS)):
        return []
    arrivals, marks = pending_arrivals(store, LABELS)
    if not marks:
        return []
    spec = labels.LabelSpec(horizon=horizon)
    outcomes = arrivals.where((F.col(spec.kind) == spec.outcome) & F.col(DAY).isNotNull()).select(spec.entity, DAY)
    band = F.sequence(F.date_sub(DAY, horizon), F.date_sub(DAY, 1))
    with staged(outcomes.select(spec.entity, F.explode(band).alias("snapshot_date")).distinct(), "late-outcomes") as hits:
        reached = {r[0] for r in hits.select("snapshot_date").distinct().collect()}
        old = store.read_partitions(LABELS, "snapshot_date", [d for d in stored_dates(store, LABELS) if d in reached])
        stamp = F.lit(labeled_at).cast("timestamp") if labeled_at else F.current_timestamp()
        late = (F.col(spec.label) == 0) & F.col("_late").isNotNull()
        marked = old.join(hits.withColumn("_late", F.lit(1)), [spec.entity, "snapshot_date"], "left")
        changed = marked.where(late).select("snapshot_date").distinct().collect()
        dates = sorted(r[0] for r in changed)
        new = marked.where(F.col("snapshot_date").isin(dates)).withColumns(
            {spec.label: F.when(late, F.lit(1)).otherwise(F.col(spec.label)), "_labeled_at": F.when(late, stamp).otherwise(F.col("_labeled_at"))}
        )
        store.replace_partitions(LABELS, new.select(old.columns), "snapshot_date", dates, marks)
    return dates


def build_labels(
    store: TableStore,
    events: DataFrame,
    as_of: date,
    today: date,
    horizon: int = labels.HORIZON_DAYS,
    labeled_at: datetime | None = None,
) -> WriteResult:
    """Labels of one snapshot date; skipped before maturity or without a snapshot."""
    with track_run(store, "generate_labels", f"labels-{as_of.isoformat()}") as run:
        if not labels.is_mature(as_of, today, horizon):
            run.status, run.output = "skipped", {"reason": "label not yet mature"}
            return WriteResult("skipped", 0)
        snapshot = store.read_partitions(FEATURES, "snapshot_date", [as_of])
        if snapshot.isEmpty():
            run.status, run.output = "skipped", {"reason": "no feature snapshot"}
            return WriteResult("skipped", 0)
        spec = labels.LabelSpec(horizon=horizon)
        rows = labels.delayed_labels(events, snapshot, as_of, today, spec, labeled_at)
        result = store.replace_partition(LABELS, rows, "snapshot_date", as_of)
        run.output = {"as_of_date": as_of, "total_customers": result.rows}
    return result


def label_mature_snapshots(
    store: TableStore,
    events: DataFrame,
    today: date,
    horizon: int = labels.HORIZON_DAYS,
    labeled_at: datetime | None = None,
) -> WriteResult:
    """Label every mature snapshot row that has no label yet, also on dates labelled before.

    Only the dates that have matured are read, and a second call appends nothing.
    """
    spec = labels.LabelSpec(horizon=horizon)
    mature = [d for d in stored_dates(store, FEATURES) if labels.is_mature(d, today, horizon)]
    snapshots = store.read_partitions(FEATURES, "snapshot_date", mature)
    done = None
    if store.exists(LABELS):
        done = store.read_partitions(LABELS, "snapshot_date", mature)
    rows = labels.mature_labels(events, snapshots, today, spec, done, labeled_at)
    return store.insert_new(LABELS, rows, [spec.entity, "snapshot_date"], ["snapshot_date"])


def stored_dates(store: TableStore, name: str, column: str = "snapshot_date") -> list[date]:
    """The dates a table has partitions for, told by its version; no job, no scan."""
    version = store.version(name)
    folders = {f for ps in version.parts.values() for p in ps for f in p.split("/")} if version else set()
    found = (f.split("=", 1)[1] for f in folders if f.startswith(f"{column}="))
    return sorted(date.fromisoformat(v) for v in found if v[:1].isdigit())


def training_set(store: TableStore) -> DataFrame:
    """Features of all labelled snapshots, also as the view ``training_dataset``."""
    return store.view("training_dataset", labels.training_set(store.read(FEATURES), store.read(LABELS)))


def backfill(
    store: TableStore, events: DataFrame, start: date, end: date, dry_run: bool = False, built_at: datetime | None = None
) -> Sequence[date]:
    """Rebuild the feature snapshots of every date in [start, end] in one job.

    Returns the dates; none when start is after end. Attributes are those known at
    each date. A date that now has no rows is emptied. ``built_at`` states the build time.
    """
    dates = features.dates_in(start, end)
    if dry_run or not dates:
        return dates
    with track_run(store, "backfill", f"backfill-{start.isoformat()}-{end.isoformat()}") as run:
        rows = features.feature_snapshots(events, start, end, built_at=built_at)
        if store.exists(CUSTOMERS):
            rows = features.attributes_for_dates(rows, store.read(CUSTOMERS), features.CUSTOMER_FEATURES)
        names = [*_feature_order(rows), "snapshot_date", "_built_at"]
        result = store.replace_partitions(FEATURES, rows.select(*names), "snapshot_date", dates)
        run.output = {"dates": len(dates), "rows": result.rows}
    return dates


def _feature_order(rows: DataFrame) -> list[str]:
    spec = features.CUSTOMER_FEATURES
    return [spec.entity, *[n for n in features.feature_names(spec) if n in rows.columns]]


def rebuild_late_snapshots(store: TableStore, events: DataFrame, built_at: datetime | None = None) -> Sequence[date]:
    """Rebuild the snapshots that events ingested after their build touch, one date span at a time.

    However old the event is, it counts. A rebuilt snapshot has a newer build time, so that a second
    call finds nothing. Only the list of dates comes to the driver.
    """
    late = labels.stale_snapshot_dates(events, store.read(FEATURES))
    dates = sorted(r.snapshot_date for r in late.select("snapshot_date").collect())
    for first, last in contiguous(dates):
        backfill(store, events, first, last, built_at=built_at)
    return dates


def relabel_late_outcomes(
    store: TableStore,
    events: DataFrame,
    today: date,
    horizon: int = labels.HORIZON_DAYS,
    labeled_at: datetime | None = None,
) -> Sequence[date]:
    """Redo the labels of the dates whose outcome band got an event after they were labelled."""
    spec = labels.LabelSpec(horizon=horizon)
    done = store.read(LABELS)
    late = labels.stale_label_dates(events, done, spec).select("snapshot_date")
    dates = sorted(r.snapshot_date for r in late.collect())
    if dates:
        again = store.read_partitions(FEATURES, "snapshot_date", dates)
        rows = labels.mature_labels(events, again, today, spec, labeled_at=labeled_at)
        store.replace_partitions(LABELS, rows, "snapshot_date", dates)
    return dates


def contiguous(dates: Sequence[date]) -> list[tuple[date, date]]:
    """Ascending dates as (first, last) spans without gaps."""
    spans: list[tuple[date, date]] = []
    for d in dates:
        if spans and d - spans[-1][1] == timedelta(days=1):
            spans[-1] = (spans[-1][0], d)
        else:
            spans.append((d, d))
    return spans


#: Buckets of a new table of current states; a table keeps the number it was made with.
BUCKETS = 64


def merge_current(
    store: TableStore, rows: DataFrame, key: str = "customer_id", newest: str = "snapshot_date", name: str = CURRENT, buckets: int = BUCKETS
) -> WriteResult:
    """Bring a table of one row per key up to date; only the buckets that hold a key of ``rows`` are read and rewritten.

    The row with the highest ``newest`` stays, so batches may come in any order, and again. ``rows`` has
    one row per key.
    """
    version = store.version(name)
    buckets = version.marks["buckets"] if version else buckets
    with staged(rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")), "current") as fresh:
        touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]
        both = fresh.withColumn("_fresh", F.lit(1))
        if version:
            both = both.unionByName(store.read_partitions(name, "bucket", touched).withColumn("_fresh", F.lit(0)), allowMissingColumns=True)
        one = latest_per_key(both, [key], [newest, "_fresh"]).drop("_fresh")
        return store.replace_partitions(name, one, "bucket", touched, {"buckets": buckets})


def current_customers(store: TableStore) -> DataFrame:
    """The newest snapshot of each customer; no history is read."""
    return store.read(CURRENT).drop("bucket")


def customers_known_by(store: TableStore, as_of: date) -> DataFrame:
    """Snapshots that tell each customer's attributes as of a date: the current states where none is newer."""
    dates = stored_dates(store, CUSTOMERS)
    if store.exists(CURRENT) and (not dates or dates[-1] <= as_of):
        return current_customers(store)
    return store.read_partitions(CUSTOMERS, "snapshot_date", [d for d in dates if d <= as_of])


def current_predictions(store: TableStore) -> DataFrame:
    """Predictions of the latest run: found in the index of runs, read from its own partition."""
    run = scoring.latest_run(store.read(RUNS)).first()
    if run is None:
        return store.read(HISTORY).limit(0)
    rows = store.read_partitions(HISTORY, "scoring_run_id", [run.scoring_run_id])
    return rows.where(F.col("scoring_run_id") == run.scoring_run_id)


def store_predictions(store: TableStore, scores: DataFrame) -> WriteResult:
    """Add predictions to the history, partitioned by run, and the runs to their index; repeated ones add nothing."""
    result = store.insert_new(HISTORY, scores, scoring.HISTORY_KEY, ["scoring_run_id"])
    runs = scores.groupBy("scoring_run_id").agg(F.max("scored_at").alias("scored_at"), F.count("*").alias("predictions"))
    store.insert_new(RUNS, runs, ["scoring_run_id"])
    return result


def refresh_baseline(store: TableStore) -> Sequence[date]:
    """Bring the value counts of the training set up to date, one partition per snapshot date; the dates counted anew.

    A date is counted again when its features or labels were written since, told by a mark of their
    write folders that its partition carries. Nothing else of the training set is read.
    """
    sides = [store.version(FEATURES), store.version(LABELS)]
    made = {d: _mark_of(sides, d) for d in set(stored_dates(store, FEATURES)) & set(stored_dates(store, LABELS))}
    version = store.version(BASELINE)
    have = dict(_dated_mark(p) for ps in version.parts.values() for p in ps) if version else {}
    due = sorted(d for d, mark in made.items() if have.get(d) != mark)
    gone = sorted(have.keys() - made.keys())
    if not due and not gone:
        return []
    training = labels.training_set(
        store.read_partitions(FEATURES, "snapshot_date", due), store.read_partitions(LABELS, "snapshot_date", due)
    )
    # One row per date, so the joined side is bounded by the number of dates.
    marks = store.spark.createDataFrame([(d, made[d]) for d in due], "snapshot_date date, made_of string")
    counts = drift.feature_counts(training, per=["snapshot_date"]).join(F.broadcast(marks), "snapshot_date")
    store.create_if_absent(BASELINE, counts, ["snapshot_date", "made_of"])
    store.replace_partitions(BASELINE, counts, "snapshot_date", [*due, *gone])
    return due


def _mark_of(versions: Sequence, day: date) -> str:
    """Tells the writes that a date's partitions come from."""
    folder = f"snapshot_date={day.isoformat()}"
    writes = [sorted(w for w, ps in v.parts.items() if any(folder in p.split("/") for p in ps)) for v in versions]
    return hashlib.sha256(repr(writes).encode()).hexdigest()[:16]


def _dated_mark(path: str) -> tuple[date, str]:
    day, mark = (part.split("=", 1)[1] for part in path.split("/"))
    return date.fromisoformat(day), f"{mark}"


def counted_baseline(store: TableStore) -> drift.CountedSample:
    """The training set as value counts; only new dates are counted."""
    refresh_baseline(store)
    return drift.CountedSample(store.read(BASELINE).drop("snapshot_date", "made_of"), training_set(store).schema)


def champion_for_scoring(store: TableStore, model_name: str):
    """Version, contract and metrics of the serving model, checked; one row."""
    champion = (
        governance.current_champion(store.read(PROMOTIONS, merge=True)).where(F.col("model_name") == model_name).first()
    )
    if champion is None:
        raise governance.PromotionBlocked("there is no champion; promote an approved candidate first")
    if champion.champion_contract != governance.INFERENCE_CONTRACT:
        raise governance.PromotionBlocked(f"champion {champion.champion_version} has a legacy contract")
    newest = governance.latest_metrics(store.read(CANDIDATES, merge=True))
    if "model_name" in newest.columns:
        newest = newest.where(F.col("model_name") == model_name)
    metrics = newest.where(F.col("model_version") == champion.champion_version).first()
    if metrics is None:
        raise governance.PromotionBlocked(f"no metrics for champion {champion.champion_version}")
    return metrics


def score_batch(
    store: TableStore,
    prediction: Column,
    scoring_run_id: str,
    model_name: str,
    customers: DataFrame | None = None,
    scored_at: datetime | None = None,
) -> WriteResult:
    """Score every customer with the champion's prediction column; a repeated run id adds nothing."""
    with track_run(store, "batch_score", scoring_run_id) as run:
        metrics = champion_for_scoring(store, model_name)
        scores = scoring.score_customers(
            customers if customers is not None else current_customers(store),
            prediction,
            float(metrics.classification_threshold),
            scoring_run_id,
            metrics.selected_algorithm,
            model_name,
            metrics.model_version,
            metrics.run_id,
            scored_at or datetime.now(timezone.utc),
        )
        result = store_predictions(store, scores)
        store.view("current_customer_churn_scores", current_predictions(store))
        run.output = {"model_version": metrics.model_version, "customers_scored": result.rows}
    return result


def promote(
    store: TableStore,
    model_name: str,
    candidate_version: str,
    gate: governance.Gate = governance.Gate(),
    evaluated_at: datetime | None = None,
):
    """Decide on a candidate, append the audit row, refresh the champion table if approved."""
    spark = store.spark
    with track_run(store, "promote", f"promote-v{candidate_version}") as run:
        champion = None
        if store.exists(PROMOTIONS):
            serving = governance.current_champion(store.read(PROMOTIONS, merge=True))
            champion = serving.where(F.col("model_name") == model_name).first()
        old = champion.champion_version if champion else None
        request = spark.createDataFrame(
            [(model_name, candidate_version, old)],
            "model_name string, candidate_version string, champion_version string",
        )
        metrics = store.read(CANDIDATES, merge=True)
        pairs = governance.candidate_pairs(request, store.read("model_versions"), metrics)
        stamp = F.lit(evaluated_at or datetime.now(timezone.utc)).cast("timestamp")
        with staged(governance.promotion_decisions(pairs, gate, stamp), "decision") as decisions:
            store.append(PROMOTIONS, decisions)
            row = decisions.first()
            if row.decision == "APPROVED":
                store.overwrite(CHAMPION, governance.champion_rows(decisions, metrics))
        governance.require_deployable(row.decision, old)
        run.output = {"decision": row.decision, "reason": row.decision_reason}
    return row


def monitor_drift(store: TableStore, at: datetime | None = None) -> WriteResult:
    """Drift of the newest feature snapshot against the training set, plus prediction drift."""
    with track_run(store, "drift_monitor") as run:
        dates = stored_dates(store, FEATURES)
        newest = dates[-1] if dates else None
        if newest is None or training_set(store).isEmpty():
            run.status, run.output = "skipped", {"reason": "no baseline or no snapshot"}
            return WriteResult("skipped", 0)
        current = store.read_partitions(FEATURES, "snapshot_date", [newest])
        on = F.lit(newest)
        rows = drift.drift_report(counted_baseline(store), current, on, at=at)
        if store.exists(HISTORY):
            rows = rows.unionByName(drift.prediction_drift(store.read(LABELS), current_predictions(store), on, at=at))
        result = store.replace_partition(DRIFT, rows, "snapshot_date", newest)
        run.output = {"snapshot_date": newest, "features_monitored": result.rows}
    return result
