import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewell.operators import features, labels, runlog, training
from tidewell.plans import daily, modeling
from tidewell.sources.contract import SEED_COLUMNS
from tidewell.sources.readers import read_json_lines
from tidewell.sources.contract import EVENT_CONTRACT
from tidewell.streaming import ingest


def line(i, day="01", **extra):
    return json.dumps(
        {
            "schema_version": 1, "event_id": i, "event_type": "usage", "customer_id": "c",
            "event_timestamp": f"2026-01-{day}T10:00:00Z", "event_date": f"2026-01-{day}", **extra,
        }
    )


@pytest.fixture
def zone(store, tmp_path):
    class Zone:
        landing, checkpoint = (str(tmp_path / n) for n in ("landing", "cp"))

        def land(self, name, *lines):
            folder = tmp_path / "landing" / "year=2026" / "month=01" / "day=01"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{name}.jsonl").write_text("\n".join(lines) + "\n")

        def run(self, spark, settings=ingest.IngestSettings()):
            ingest.ingest_events(store, self.landing, self.checkpoint, settings)
            return store.read(ingest.BRONZE), store.read(ingest.REJECTS)

    return Zone()


def test_ingest_dedups_over_runs_and_keeps_bad_lines(spark, zone):
    zone.land("a", line("e1"), line("e1"), line("e2", rogue="x"), "{broken", "{also broken", line(""), line(None))
    bronze, rejects = zone.run(spark)
    assert sorted(r.event_id for r in bronze.collect()) == ["e1", "e2"]
    assert rejects.count() == 4
    assert {r._rescued_data for r in rejects.collect()} >= {"{broken", "{also broken"}
    row = bronze.where("event_id = 'e2'").first()
    assert json.loads(row._rescued_data) == {"rogue": "x"}
    assert row.event_ts == datetime(2026, 1, 1, 10) and row._source_file.endswith("a.jsonl")
    assert not {"year", "month", "day"} & set(bronze.columns)
    summary = ingest.ingest_summary(bronze).first()
    assert (summary.total_rows, summary.rescued_rows) == (2, 1)

    bronze, _ = zone.run(spark)  # nothing new
    assert bronze.count() == 2
    zone.land("b", line("e1"), line("e3"))
    bronze, rejects = zone.run(spark)
    assert sorted(r.event_id for r in bronze.collect()) == ["e1", "e2", "e3"] and rejects.count() == 4


def test_dedup_with_bounded_state(spark, zone, tmp_path):
    settings = ingest.IngestSettings(watermark="2 days", max_files_per_trigger=1)
    out = str(tmp_path / "out")
    for name, ids in (("a", ("e1", "e1", "e2")), ("b", ("e2", "e4"))):
        zone.land(name, *map(line, ids))
        stream = ingest.deduplicated(ingest.read_event_stream(spark, zone.landing, settings), settings)
        ingest.append_stream(stream, out, zone.checkpoint).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["e1", "e2", "e4"]


def test_a_repeated_batch_completes_what_is_missing(spark, store, zone, monkeypatch):
    zone.land("a", line("e1"), line("e2", day="02"), line("e2", day="02"), "{broken")
    parsed = ingest.enrich(read_json_lines(spark, zone.landing, EVENT_CONTRACT).withColumn("_source_file", F.lit("a")), ingest.IngestSettings())
    append, dead = type(store).append, []

    def dies(self, name, *rest, **more):
        if name == ingest.BRONZE and not dead:
            dead.append(name)
            raise RuntimeError("lost")
        return append(self, name, *rest, **more)

    monkeypatch.setattr(type(store), "append", dies)
    with pytest.raises(RuntimeError, match="lost"):
        ingest.land_batch(store, parsed, "s", 0)
    for _ in range(3):
        ingest.land_batch(store, parsed, "s", 0)
    assert sorted(r.event_id for r in store.read(ingest.BRONZE).collect()) == ["e1", "e2"]
    assert store.read(ingest.REJECTS).count() == 1 and store.read(ingest.ARRIVALS).agg(F.sum("events")).first()[0] == 2
    ingest.land_batch(store, parsed, "s", 1)  # the same events in a later batch
    assert store.read(ingest.BRONZE).count() == 2 and store.read(ingest.ARRIVALS).count() == 2
    assert [d.day for d in daily.stored_dates(store, ingest.BRONZE, ingest.DAY)] == [1, 2]


def test_batch_reader_equals_stream_parse(spark, zone):
    zone.land("a", line("e1"), "{broken")
    rows = read_json_lines(spark, zone.landing, EVENT_CONTRACT).collect()
    assert {r.event_id for r in rows} == {"e1", None}


def seed_csv(path, rows):
    base = dict.fromkeys(SEED_COLUMNS, "No") | {
        "SeniorCitizen": "0", "tenure": "5", "MonthlyCharges": "70.5", "TotalCharges": "300", "Churn": "No",
        "Contract": "One year", "InternetService": "DSL", "PaymentMethod": "Check",
    }
    lines = [",".join(SEED_COLUMNS)] + [",".join((base | r)[c] for c in SEED_COLUMNS) for r in rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def events(spark):
    rows = []
    for i, c in enumerate(("c1", "c2", "c3")):
        for d in range(1, 29):
            rows.append((f"{c}-{d}", c, "usage", datetime(2026, 1, d, 12), float(d + i), None, None))
    rows.append(("x1", "c2", "cancellation", datetime(2026, 1, 25), None, None, None))
    rows.append(("x2", "c1", "payment", datetime(2026, 1, 10), None, "failed", None))
    ddl = (
        "event_id string, customer_id string, event_type string, event_ts timestamp, usage_gb double, "
        "payment_status string, complaint_severity string"
    )
    return spark.createDataFrame(rows, ddl).withColumn("ingestion_timestamp", F.col("event_ts"))


def test_whole_flow(spark, store, tmp_path):
    csv = seed_csv(
        tmp_path / "seed.csv",
        [{"customerID": "c1"}, {"customerID": " c2 ", "Churn": "Yes"}, {"customerID": "c3", "TotalCharges": " "},
         {"customerID": "bad", "MonthlyCharges": "n/a"}],
    )
    assert daily.seed_customers(store, csv).status == "created"
    assert daily.seed_customers(store, csv).status == "skipped"
    day = date(2026, 1, 1)
    assert daily.build_customer_snapshot(store, day).status == "created"
    assert daily.build_customer_snapshot(store, day).status == "merged"
    silver = {r.customer_id: r for r in store.read(daily.CUSTOMERS).collect()}
    assert set(silver) == {"c1", "c2", "c3"} and silver["c3"].total_charges is None
    assert (silver["c2"].churn, silver["c2"].churn_label, silver["c1"].tenure) == ("Yes", 1, 5)
    assert store.read(daily.SUMMARY).first().customers == 3
    assert store.read("quarantine").select("violated_rule").distinct().first()[0] == "monthly_charges_not_null"

    e = events(spark)
    as_of = date(2026, 1, 20)
    assert daily.build_feature_snapshot(store, e, date(2025, 12, 1)).status == "skipped"
    for _ in range(2):
        assert daily.build_feature_snapshot(store, e, as_of).rows == 3
    assert store.read(daily.FEATURES).count() == 3
    assert daily.build_labels(store, e, as_of, date(2026, 1, 26), horizon=7).status == "skipped"
    assert daily.build_labels(store, e, as_of, date(2026, 1, 27), horizon=7).rows == 3
    training = {r.customer_id: r for r in daily.training_set(store).collect()}
    assert {c: r.churned for c, r in training.items()} == {"c1": 0, "c2": 1, "c3": 0}
    assert training["c1"].payment_failure_rate_30d == 1.0 and training["c1"].contract == "One year"

    assert daily.backfill(store, e, date(2026, 1, 9), date(2026, 1, 8)) == []
    assert len(daily.backfill(store, e, date(2026, 1, 9), date(2026, 1, 10), dry_run=True)) == 2
    daily.backfill(store, e, date(2026, 1, 18), date(2026, 1, 22))
    stored = store.read(daily.FEATURES)
    assert stored.count() == 15
    single = features.feature_snapshot(e, as_of, snapshots=store.read(daily.CUSTOMERS)).drop("_built_at")
    again = stored.where(F.col("snapshot_date") == F.lit(as_of)).select(single.columns)
    assert sorted(map(str, again.collect())) == sorted(map(str, single.collect()))
    assert daily.label_mature_snapshots(store, e, date(2026, 1, 28), horizon=7).rows == 9  # 18, 19, 21; 20 is done
    assert daily.label_mature_snapshots(store, e, date(2026, 1, 28), horizon=7).rows == 0
    assert store.read(daily.LABELS).count() == 12
    assert {r.snapshot_date.day for r in store.read(daily.LABELS).collect()} >= {18, 19, 20, 21}

    result = daily.monitor_drift(store)
    drift_rows = store.read(daily.DRIFT)
    assert result.rows == drift_rows.count() == 40
    statuses = {r.task_name: r.status for r in store.read(runlog.TABLE).orderBy("finished_at").collect()}
    assert statuses["drift_monitor"] == "succeeded"


def test_ingest_and_event_rules(spark, store, zone):
    zone.land("a", line("e1"), line("e2", event_type="teleportation"), line("e3", rogue=1))
    bronze = daily.ingest(store, zone.landing, zone.checkpoint)
    clean = daily.check_events(store, bronze, "run-1")
    assert sorted(r.event_id for r in clean.collect()) == ["e1", "e3"]
    assert store.read("quarantine").first().violated_rule == "event_type_in_contract"
    log = store.read(runlog.TABLE).first()
    assert json.loads(log.output_summary)["rescued_rows"] == 1 and "warning" in log.output_summary


def test_train_promote_and_score(spark, store):
    rows = [
        (f"c{i}", date(2026, 1, 1 + i % 3), float(i % 7 + 5 * (i % 4 == 0)), "m" if i % 3 else None, 10.0, i % 40,
         int(i % 4 == 0))
        for i in range(400)
    ]
    ddl = "customer_id string, snapshot_date date, usage double, contract string, monthly_charges double, tenure int, y int"
    data = spark.createDataFrame(rows, ddl)
    store.overwrite(daily.FEATURES, data.drop("y"), ["snapshot_date"])
    store.overwrite(
        daily.LABELS,
        data.select("customer_id", "snapshot_date", F.col("y").alias("churned"), F.lit(30).alias("label_horizon_days"),
                    F.date_add("snapshot_date", 30).alias("maturity_date")),
        ["snapshot_date"],
    )
    result = modeling.train_candidate(store, "churn", "1", [training.single_tree("churned")])
    assert result.test_metrics["test_recall"] > 0.6
    assert daily.promote(store, "churn", "1").decision == "APPROVED"
    modeling.score_with_champion(store, "churn", "run-1")
    modeling.score_with_champion(store, "churn", "run-1")
    current = spark.table("current_customer_churn_scores")
    assert current.count() == 400 and current.first().selected_algorithm == "decision_tree"
    assert store.read(daily.CHAMPION).first().model_alias == "Champion"


def test_late_events_rebuild_their_snapshots(spark, store):
    e = events(spark)
    daily.backfill(store, e, date(2026, 1, 18), date(2026, 1, 20), built_at=datetime(2026, 1, 20, 18))
    daily.backfill(store, e, date(2026, 1, 21), date(2026, 1, 22), built_at=datetime(2026, 1, 22, 18))
    late = e.limit(1).select(
        F.lit("late").alias("event_id"), F.lit("c1").alias("customer_id"), F.lit("payment").alias("event_type"),
        F.lit(datetime(2026, 1, 19)).alias("event_ts"), F.lit(None).cast("double").alias("usage_gb"),
        F.lit("failed").alias("payment_status"), F.lit(None).cast("string").alias("complaint_severity"),
        F.lit(datetime(2026, 1, 21)).alias("ingestion_timestamp"),
    )
    everything = e.unionByName(late)
    dates = daily.rebuild_late_snapshots(store, everything, built_at=datetime(2026, 1, 29))
    assert [d.day for d in dates] == [19, 20]
    assert daily.rebuild_late_snapshots(store, everything) == []
    counts = {
        r.snapshot_date.day: r.payment_failures_30d
        for r in store.read(daily.FEATURES).where("customer_id = 'c1'").collect()
    }
    assert counts == {18: 1, 19: 2, 20: 2, 21: 1, 22: 1}  # 21 and 22 were built after it came, from events without it


def test_spans():
    d = lambda n: date(2026, 1, n)
    assert daily.contiguous([d(1), d(2), d(4)]) == [(d(1), d(2)), (d(4), d(4))]


def test_label_spec_defaults():
    assert labels.LabelSpec().horizon == 30 and labels.is_mature(date(2026, 1, 1), date(2026, 1, 31))
