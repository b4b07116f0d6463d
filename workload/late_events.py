"""Incremental features, and repair of features and labels when events arrive late."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from tidewell.operators import features
from tidewell.plans import daily
from tidewell.session import scratch_path
from tidewell.sources import tables
from tidewell.streaming import ingest
from workload.snapshots import COUNT_NAMES, FEATURE_SNAPSHOT_SQL, FINISHED, LEVELS, RATES, snapshot_sql
from workload.streams_models import landing_rows
from workload.tables import AS_OF, CONTRACT_EVENTS, contract_events, customer_snapshots, rounded

DATES = (date(2024, 1, 9), date(2024, 1, 20), date(2024, 1, 28))


def feature_snapshot_incremental(spark, sf):
    """Four snapshots in a row from stored entity days, each with the state of the one before; the last one's rows."""
    store = tables.TableStore(spark, scratch_path(spark, "incremental"))
    store.overwrite(daily.DAYS, features.entity_days(contract_events(spark, sf), day=ingest.DAY), [ingest.DAY])
    store.overwrite(daily.CUSTOMERS, customer_snapshots(spark, sf))
    for back in (5, 2, 1, 0):
        daily.build_snapshot_from_days(store, AS_OF - timedelta(days=back))
    rows = store.read_partitions(daily.FEATURES, "snapshot_date", [AS_OF]).drop("_built_at")
    return rounded(rows, 6, "avg_usage_30d", "avg_usage_prior_30d", "usage_delta_pct", *RATES)


def _land_in_two(spark, sf, between):
    """Ingest the events that are in time, do ``between(store)``, ingest the late tenth of them."""
    base = scratch_path(spark, "late")
    store = tables.TableStore(spark, f"{base}/tables")
    rows = landing_rows(spark, sf)
    late = F.col("k") % 10 == 3
    for part in (rows.where(~late), rows.where(late)):
        tables.land_json_by_day(part.drop("k"), f"{base}/landing", "event_date")
        ingest.ingest_events(store, f"{base}/landing", f"{base}/checkpoint")
        daily.refresh_days(store)
        if between is not None:
            between(store)
            between = None
    return store


def _only_once(repair):
    """The repair, and proof that a second call has nothing to do."""
    dates = repair()
    if again := repair():
        raise RuntimeError(f"a second repair rewrote {again}")
    return dates


def late_rebuild_features(spark, sf):
    store = _land_in_two(spark, sf, lambda store: [daily.build_snapshot_from_days(store, d) for d in DATES])
    _only_once(lambda: daily.repair_features(store))
    rows = store.read(daily.FEATURES).select("customer_id", "snapshot_date", *COUNT_NAMES, *LEVELS, "days_since_last_activity", *RATES)
    return rounded(rows, 6, *LEVELS[1:], *RATES)


IN_TIME = f"{CONTRACT_EVENTS}, e AS (SELECT * REPLACE (date_trunc('second', event_ts) AS event_ts) FROM ev WHERE k <> 0)"
LATE_FEATURES_SQL = f"""
WITH {IN_TIME}, f AS ({" UNION ALL ".join(
    f"SELECT *, DATE '{d}' AS snapshot_date FROM ({snapshot_sql('e', chr(39) + d.isoformat() + chr(39), 'customer_id')})" for d in DATES)})
{FINISHED}"""


def late_rebuild_labels(spark, sf):
    """Labels made before a tenth of the events came, repaired from the arrivals alone."""

    def label(store):
        for d in DATES[:2]:
            daily.build_snapshot_from_days(store, d)
        daily.label_mature_snapshots(store, daily.clean_events(store), date(2024, 2, 1), horizon=7)

    store = _land_in_two(spark, sf, label)
    dates = _only_once(lambda: daily.repair_labels(store, horizon=7))
    rows = store.read(daily.LABELS).select("customer_id", "snapshot_date", "churned", "maturity_date")
    return rows.withColumn("dates_repaired", F.lit(len(dates)))


LATE_LABELS_SQL = f"""
WITH {IN_TIME},
d AS (SELECT unnest([DATE '{DATES[0]}', DATE '{DATES[1]}']) AS snapshot_date),
p AS (SELECT DISTINCT customer_id, snapshot_date FROM e JOIN d ON event_ts < snapshot_date + 1 WHERE k % 10 <> 3),
c AS (SELECT customer_id, CAST(event_ts AS DATE) AS day, bool_and(k % 10 = 3) AS late FROM e WHERE event_type = 'cancellation' GROUP BY ALL),
h AS (SELECT p.*, count(day) AS hits, coalesce(bool_and(late), false) AS only_late
      FROM p LEFT JOIN c ON p.customer_id = c.customer_id AND day > snapshot_date AND day <= snapshot_date + 7 GROUP BY p.customer_id, snapshot_date)
SELECT customer_id, snapshot_date, CAST(hits > 0 AS INTEGER) AS churned, CAST(snapshot_date + 7 AS DATE) AS maturity_date,
       (SELECT CAST(count(DISTINCT snapshot_date) AS INTEGER) FROM h WHERE only_late) AS dates_repaired
FROM h"""

QUERIES = {
    "feature_snapshot_incremental": (feature_snapshot_incremental, FEATURE_SNAPSHOT_SQL),
    "late_rebuild_features": (late_rebuild_features, LATE_FEATURES_SQL),
    "late_rebuild_labels": (late_rebuild_labels, LATE_LABELS_SQL),
}
