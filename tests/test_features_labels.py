from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidewell.operators import features, labels
from tidewell.operators.features import CUSTOMER_FEATURES

DDL = (
    "event_id string, customer_id string, event_type string, ts string, usage_gb double, "
    "payment_status string, complaint_severity string"
)
AS_OF = date(2026, 3, 31)


def ev(i, customer, kind, ts, usage=None, status=None, severity=None):
    return (f"e{i}", customer, kind, ts, usage, status, severity)


ROWS = [
    ev(1, "a", "payment", "2026-03-24 00:00:00", status="failed"),  # first instant of the 7-day window
    ev(2, "a", "payment", "2026-03-23 23:59:59.999999", status="succeeded"),  # just before it
    ev(3, "a", "usage", "2026-03-31 23:59:59.5", usage=5.0),  # last second of the as-of day
    ev(4, "a", "usage", "2026-02-10 00:00:00", usage=10.0),  # prior 30 days
    ev(5, "a", "complaint", "2026-03-30 10:00:00", severity="high"),
    ev(6, "a", "complaint", "2026-03-30 11:00:00", severity="medium"),
    ev(7, "b", "usage", "2025-01-01 00:00:00", usage=1.0),  # older than every window
    ev(8, "b", "usage", "2026-03-30 00:00:00", usage=2.0),
    ev(9, "b", "usage", "2026-03-30 00:00:00", usage=2.0),  # tie on time, same value
    ev(10, "c", "cancellation", "2026-04-01 00:00:00"),  # after the as-of date
    ev(11, "d", "usage", "2026-03-05 00:00:00", usage=None),  # latest usage is null
    ev(12, "d", "usage", "2026-03-04 00:00:00", usage=4.0),
]


def make(spark, rows):
    return spark.createDataFrame(rows, DDL).withColumn("event_ts", F.col("ts").cast("timestamp")).drop("ts")


@pytest.fixture
def events(spark):
    return make(spark, ROWS)


def by_customer(df):
    return {r.customer_id: r.asDict() for r in df.drop("_built_at").collect()}


def test_windows_and_boundaries(events):
    got = by_customer(features.feature_snapshot(events, AS_OF))
    assert set(got) == {"a", "b", "d"}
    a = got["a"]
    assert (a["payment_count_7d"], a["payment_count_30d"], a["payment_failures_7d"]) == (1, 2, 1)
    assert (a["payment_failure_rate_7d"], a["payment_failure_rate_30d"]) == (1.0, 0.5)
    assert (a["complaint_count_7d"], a["complaint_high_7d"]) == (2, 1)
    assert (a["latest_usage_gb"], a["avg_usage_30d"], a["avg_usage_prior_30d"]) == (5.0, 5.0, 10.0)
    assert a["usage_delta_pct"] == -50.0
    assert a["days_since_last_activity"] == 0
    b = got["b"]
    assert b["payment_failure_rate_90d"] is None and b["usage_delta_pct"] is None
    assert b["latest_usage_gb"] == 2.0
    assert got["d"]["latest_usage_gb"] is None and got["d"]["avg_usage_30d"] == 4.0


def test_forty_features(events, spark):
    attrs = spark.createDataFrame(
        [("a", date(2026, 1, 1), 1, 1.0, 1.0, "m", "f", "p", "n", 0)],
        "customer_id string, snapshot_date date, tenure int, monthly_charges double, total_charges double, "
        "contract string, internet_service string, payment_method string, tech_support string, senior_citizen int",
    )
    snap = features.feature_snapshot(events, AS_OF, snapshots=attrs)
    assert len(snap.columns) == 40 + 3
    assert features.feature_names(CUSTOMER_FEATURES) == snap.columns[1:-2]


@pytest.mark.parametrize("kind", ["usage", "payment", "cancellation", "complaint"])
def test_future_events_change_nothing(spark, events, kind):
    before = by_customer(features.feature_snapshot(events, AS_OF))
    late = [ev(100 + i, c, kind, "2026-04-01 00:00:00", 99.0, "failed", "high") for i, c in enumerate("abdz")]
    after = by_customer(features.feature_snapshot(events.unionByName(make(spark, late)), AS_OF))
    assert before == after


def test_latest_tie_is_broken_by_id_not_layout(spark):
    rows = [ev(i, "a", "usage", "2026-03-30 00:00:00", usage=float(i)) for i in range(50)]
    got = {
        features.feature_snapshot(make(spark, rows).repartition(n), AS_OF).first().latest_usage_gb for n in (1, 3, 7)
    }
    assert len(got) == 1


def test_backfill_equals_single_dates(spark, events):
    start, end = date(2026, 2, 1), date(2026, 4, 5)
    many = features.feature_snapshots(events, start, end).drop("_built_at")
    got = {(r.customer_id, r.snapshot_date): r.asDict() for r in many.collect()}
    seen = 0
    for d in (start, date(2026, 3, 3), date(2026, 3, 12), AS_OF, end):
        for c, row in by_customer(features.feature_snapshot(events, d)).items():
            assert got[c, d] == row
            seen += 1
    assert seen and {k[1] for k in got if k[0] == "c"} == {date(2026, 4, 1) + timedelta(days=i) for i in range(5)}


def test_backfill_range(events):
    assert features.dates_in(date(2026, 1, 1), date(2026, 1, 3)) == [date(2026, 1, d) for d in (1, 2, 3)]
    assert features.dates_in(date(2026, 1, 2), date(2026, 1, 1)) == []


def test_attributes_do_not_come_from_the_future(spark, events):
    ddl = (
        "customer_id string, snapshot_date date, tenure int, monthly_charges double, total_charges double, "
        "contract string, internet_service string, payment_method string, tech_support string, senior_citizen int"
    )
    rows = [("a", date(2026, m, 1), m, 1.0, 1.0, "m", "f", "p", "n", 0) for m in (1, 3, 6)]
    snaps = spark.createDataFrame(rows, ddl)
    known = by_customer(features.feature_snapshot(events, AS_OF, snapshots=snaps))
    newest = by_customer(
        features.feature_snapshot(events, AS_OF, snapshots=snaps, attributes_known_by_as_of=False)
    )
    assert (known["a"]["tenure"], newest["a"]["tenure"], known["b"]["tenure"]) == (3, 6, None)
    dated = features.feature_snapshots(events, date(2026, 2, 27), date(2026, 3, 2))
    joined = features.attributes_for_dates(dated, snaps, CUSTOMER_FEATURES)
    assert {r.snapshot_date.isoformat(): r.tenure for r in joined.where("customer_id = 'a'").collect()} == {
        "2026-02-27": 1, "2026-02-28": 1, "2026-03-01": 3, "2026-03-02": 3,
    }


def test_feature_plan_is_one_hash_aggregate(events):
    plan = features.aggregate_events(events, AS_OF, CUSTOMER_FEATURES)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "SortAggregate" not in physical and physical.count("Exchange") == 1 and "Join" not in physical


# Labels


def outcomes(spark):
    times = {"in": "2026-04-01 00:00:00", "edge": "2026-04-30 23:59:59.9", "before": "2026-03-31 23:59:59.9",
             "after": "2026-05-01 00:00:00", "none": None}
    rows = [ev(i, c, "cancellation" if t else "usage", t or "2026-03-01 00:00:00") for i, (c, t) in enumerate(times.items())]
    return make(spark, rows), spark.createDataFrame([(c,) for c in times], "customer_id string")


def test_label_band(spark):
    events, population = outcomes(spark)
    got = labels.delayed_labels(events, population, AS_OF, date(2026, 4, 30)).collect()
    assert {r.customer_id: r.churned for r in got} == {"in": 1, "edge": 1, "before": 0, "after": 0, "none": 0}
    assert {(r.label_horizon_days, r.maturity_date) for r in got} == {(30, date(2026, 4, 30))}


def test_immature_labels_are_refused(spark):
    events, population = outcomes(spark)
    with pytest.raises(labels.ImmatureLabel):
        labels.delayed_labels(events, population, AS_OF, date(2026, 4, 29))


def test_mature_labels_equal_single_dates_and_skip_done(spark):
    events, population = outcomes(spark)
    dates = [date(2026, 3, 1), date(2026, 3, 31), date(2026, 4, 1), date(2026, 4, 20)]
    snaps = population.withColumn("snapshot_date", F.explode(F.array(*[F.lit(d) for d in dates])))
    today = date(2026, 5, 1)
    got = {(r.customer_id, r.snapshot_date): r.churned for r in labels.mature_labels(events, snaps, today).collect()}
    assert {d for _, d in got} == set(dates[:3])
    for d in dates[:3]:
        single = labels.delayed_labels(events, population, d, today).collect()
        assert {r.customer_id: r.churned for r in single} == {c: v for (c, x), v in got.items() if x == d}
    done = snaps.where(F.col("snapshot_date") == F.lit(dates[0]))
    rest = labels.mature_labels(events, snaps, today, already_labeled=done)
    assert {r.snapshot_date for r in rest.collect()} == set(dates[1:3])


def test_training_set_has_only_labelled_rows(spark):
    events, population = outcomes(spark)
    snap = features.feature_snapshot(events, AS_OF)
    lab = labels.delayed_labels(events, snap, AS_OF, date(2026, 5, 1))
    joined = labels.training_set(snap, lab)
    assert joined.count() == lab.count() == 2
    counts = labels.label_counts(lab).first()
    assert (counts.total_customers, counts.churned, counts.churn_rate) == (2, 0, 0.0)


def test_late_dates(spark):
    rows = [(date(2026, 1, 1), date(2026, 1, 3)), (date(2026, 1, 2), date(2026, 1, 2))]
    e = spark.createDataFrame(rows, "event_ts date, ingestion_timestamp date")
    dates = spark.createDataFrame([(date(2026, 1, d),) for d in (1, 2, 3, 4)], "snapshot_date date")
    got = labels.late_snapshot_dates(e, dates).collect()
    assert sorted((r.snapshot_date.day, r.late_events) for r in got) == [(1, 1), (2, 1)]


def test_stale_dates_have_no_reach_and_converge(spark):
    e = spark.createDataFrame([("2023-01-01", "2024-01-20")], "event_ts string, ingestion_timestamp string")
    built = spark.createDataFrame([("2024-01-10", "2024-01-11"), ("2022-12-31", "2023-01-01")], "snapshot_date string, _built_at string")
    built = built.selectExpr("CAST(snapshot_date AS date) snapshot_date", "CAST(_built_at AS timestamp) _built_at")
    assert [r.snapshot_date for r in labels.stale_snapshot_dates(e, built).collect()] == [date(2024, 1, 10)]
    again = built.selectExpr("snapshot_date", "CAST('2024-01-21' AS timestamp) _built_at")
    assert labels.stale_snapshot_dates(e, again).count() == 0
