import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewell.operators import features
from tidewell.plans import daily
from tidewell.sources.contract import EVENT_CONTRACT
from tidewell.sources.readers import read_json_lines
from tidewell.streaming import ingest

START = date(2026, 1, 1)


def event(i, day, customer="c1", kind="usage", **more):
    when = START + timedelta(days=day)
    return json.dumps(
        {
            "schema_version": 1, "event_id": f"e{i}", "event_type": kind, "customer_id": customer,
            "event_timestamp": f"{when}T{i % 24:02d}:00:00Z", "event_date": f"{when}", **more,
        }
    )


@pytest.fixture
def land(spark, store, tmp_path):
    numbers = iter(range(100))

    def run(*lines):
        n = next(numbers)
        folder = tmp_path / f"landing-{n}"
        folder.mkdir()
        (folder / "a.jsonl").write_text("\n".join(lines) + "\n")
        raw = read_json_lines(spark, str(folder), EVENT_CONTRACT).withColumn("_source_file", F.lit("a"))
        ingest.land_batch(store, ingest.enrich(raw, ingest.IngestSettings()), "s", n)
        return daily.refresh_days(store)

    return run


def direct(store, as_of):
    rows = features.feature_snapshot(daily.clean_events(store), as_of)
    return shown(rows)


def stored(store, as_of):
    return shown(store.read_partitions(daily.FEATURES, "snapshot_date", [as_of]))


def shown(rows):
    names = [n for n in features.feature_names(features.CUSTOMER_FEATURES) if n in rows.columns]
    cells = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in rows.select("customer_id", *names).dtypes]
    return sorted(map(str, rows.select(*cells).collect()))


def usage(i, day, gb, customer="c1"):
    return event(i, day, customer, usage_gb=gb)


def test_snapshots_from_days_equal_those_from_events(spark, store, land, monkeypatch):
    land(
        *[usage(i, i * 7, 1.0 + i, f"c{i % 3}") for i in range(40)], usage(50, 5, 9.0, "old"),
        event(60, 150, "c1", "payment", amount=5.0, payment_status="failed"), event(61, 151, "c1", "payment", amount=5.0, payment_status="succeeded"),
    )
    read = []
    pick = type(store).read_partitions

    def watched(self, name, column, values):
        read.append((name, list(values)))
        return pick(self, name, column, values)

    for day in (60, 160, 161, 200):
        as_of = START + timedelta(days=day)
        with monkeypatch.context() as m:
            m.setattr(type(store), "read_partitions", watched)
            read.clear()
            daily.build_snapshot_from_days(store, as_of)
        assert stored(store, as_of) == direct(store, as_of)
        if day == 161:  # the state of the day before serves; no event is read
            assert {n for n, _ in read} == {daily.STATE, daily.DAYS}
            assert sum(len(v) for n, v in read if n == daily.STATE) == 1
            assert all(as_of - timedelta(days=90) <= d for n, v in read if n == daily.DAYS for d in v)


def test_many_days_read_at_most_91_partitions(spark, store):
    days = [(f"c{d % 5}", START + timedelta(days=d)) for d in range(200)]
    events = spark.createDataFrame([(str(k), c, "usage", datetime.combine(d, datetime.min.time()), 1.0, None, None) for k, (c, d) in enumerate(days)],
        "event_id string, customer_id string, event_type string, event_ts timestamp, usage_gb double, payment_status string, complaint_severity string")
    store.overwrite(daily.DAYS, features.entity_days(events, day=ingest.DAY), [ingest.DAY])
    as_of = START + timedelta(days=199)
    daily.build_snapshot_from_days(store, as_of - timedelta(days=1))
    version = store.version(daily.DAYS)
    within = store.read_partitions(daily.DAYS, ingest.DAY, [as_of - timedelta(days=n) for n in range(features.reach() + 1)])
    assert len(within.inputFiles()) <= 91 < sum(map(len, version.parts.values()))
    rows = features.snapshot_from_days(within, daily.state_before(store, as_of), as_of, day=ingest.DAY)
    assert shown(rows) == shown(features.feature_snapshot(events, as_of))


def test_late_events_converge(spark, store, land):
    dates = [START + timedelta(days=d) for d in (10, 20, 130)]
    land(*[usage(i, i, float(i), f"c{i % 2}") for i in range(9)], usage(30, 19, 3.0))
    for d in dates:
        daily.build_snapshot_from_days(store, d)
    assert daily.repair_features(store) == []
    touched = land(usage(40, 12, 77.0, "c0"), usage(41, 12, 5.0, "new"), event(42, 12, "c0", "complaint", complaint_severity="high"))
    assert touched == [START + timedelta(days=12)]
    # c1 is untouched on every date, and the first date is not rewritten.
    before = {d: [r for r in stored(store, d) if "c1" in r] for d in dates}
    assert daily.repair_features(store, datetime(2027, 1, 1)) == dates[1:]
    assert daily.repair_features(store) == []
    for d in dates:
        assert stored(store, d) == direct(store, d)
        assert [r for r in stored(store, d) if "c1" in r] == before[d]
    built = {r.customer_id: r._built_at for r in store.read_partitions(daily.FEATURES, "snapshot_date", dates[1:2]).collect()}
    assert built["c0"] == built["new"] == datetime(2027, 1, 1) and built["c1"] < datetime(2027, 1, 1)
    # Dropped states are made again.
    daily.build_snapshot_from_days(store, START + timedelta(days=131))
    assert stored(store, START + timedelta(days=131)) == direct(store, START + timedelta(days=131))


def test_late_outcomes_turn_labels(spark, store, land):
    land(*[usage(i, i, 1.0, f"c{i % 2}") for i in range(9)])
    for d in (5, 8):
        daily.build_snapshot_from_days(store, START + timedelta(days=d))
    daily.label_mature_snapshots(store, daily.clean_events(store), START + timedelta(days=30), horizon=7)
    assert store.read(daily.LABELS).agg(F.sum("churned")).first()[0] == 0
    land(event(50, 13, "c1", "cancellation"), event(51, 8, "c0", "cancellation"), event(52, 40, "c0", "cancellation"))
    at = datetime(2026, 3, 1)
    assert daily.repair_labels(store, 7, at) == [START + timedelta(days=5), START + timedelta(days=8)]
    assert daily.repair_labels(store, 7) == []
    got = {((r.snapshot_date - START).days, r.customer_id): (r.churned, r._labeled_at == at) for r in store.read(daily.LABELS).collect()}
    assert got == {(5, "c0"): (1, True), (5, "c1"): (0, False), (8, "c0"): (0, False), (8, "c1"): (1, True)}


def test_unclean_events_do_not_count(spark, store, land):
    assert land(usage(1, 3, 2.0), event(2, 4, kind="teleportation"), "{broken") == [START + timedelta(days=3)]
    daily.build_snapshot_from_days(store, START + timedelta(days=5))
    row = store.read(daily.FEATURES).first()
    assert (row.latest_usage_gb, row.days_since_last_activity) == (2.0, 2)
    assert store.read(ingest.BRONZE).count() == 2  # bronze keeps what has a key


def test_of_events_at_one_time_the_highest_number_is_newest(spark, store, land):
    def at_noon(i, customer):
        return json.dumps({**json.loads(usage(i, 3, float(i), customer)), "event_timestamp": f"{START + timedelta(days=3)}T12:00:00Z"})

    land(*[at_noon(i, f"c{i % 6}") for i in range(120) if i % 5])
    as_of = START + timedelta(days=4)
    daily.build_snapshot_from_days(store, as_of)
    want = {f"c{c}": max(float(i) for i in range(120) if i % 5 and i % 6 == c) for c in range(6)}
    assert {r.customer_id: r.latest_usage_gb for r in store.read(daily.FEATURES).collect()} == want
    land(*[at_noon(i, f"c{i % 6}") for i in range(120, 126)], *[at_noon(i, f"c{i % 6}") for i in range(0, 6, 5)])
    assert daily.repair_features(store) == [as_of]
    assert {r.customer_id: r.latest_usage_gb for r in store.read(daily.FEATURES).collect()} == {f"c{i % 6}": float(i) for i in range(120, 126)}
    assert stored(store, as_of) == direct(store, as_of)
