from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewell.operators import mutation, runlog
from tidewell.sources import tables
from tidewell.sources.tables import WriteConflict, land_json_by_day

D1, D2 = date(2026, 1, 1), date(2026, 1, 2)
DDL = "customer_id string, snapshot_date date, v int"
KEYS = ["customer_id", "snapshot_date"]


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def content(df):
    return sorted((r.customer_id, r.snapshot_date, r.v) for r in df.collect())


def test_upsert_updates_inserts_and_is_idempotent(spark, store):
    first = frame(spark, [("a", D1, 1), ("b", D1, 2), ("a", D2, 3)])
    assert store.upsert("t", first, KEYS, "snapshot_date").status == "created"
    change = frame(spark, [("b", D1, 20), ("c", D1, 30)])
    want = [("a", D1, 1), ("a", D2, 3), ("b", D1, 20), ("c", D1, 30)]
    for _ in range(2):
        result = store.upsert("t", change, KEYS, "snapshot_date")
        assert (result.status, result.rows) == ("merged", 2)
        assert content(store.read("t")) == want


def test_upsert_refuses_duplicate_source_keys(spark, store):
    with pytest.raises(mutation.DuplicateKeys):
        store.upsert("t", frame(spark, [("a", D1, 1), ("a", D1, 2)]), KEYS, "snapshot_date")


def test_upsert_with_new_column(spark, store):
    store.upsert("t", frame(spark, [("a", D1, 1), ("z", D2, 9)]), KEYS, "snapshot_date")
    wider = frame(spark, [("a", D1, 5)]).withColumn("w", F.lit("x"))
    assert store.upsert("t", wider, KEYS, "snapshot_date", on_new_columns="merge").status == "merged"
    assert {(r.customer_id, r.v, r.w) for r in store.read("t", merge=True).collect()} == {("a", 5, "x"), ("z", 9, None)}
    again = wider.withColumn("u", F.lit(1))
    assert store.upsert("t", again, KEYS, "snapshot_date", on_new_columns="recreate").status == "recreated"
    assert store.read("t").count() == 1


def test_partition_replace_touches_one_partition(spark, store):
    store.overwrite("t", frame(spark, [("a", D1, 1), ("a", D2, 2)]), ["snapshot_date"])
    assert store.replace_partition("t", frame(spark, [("b", D2, 7)]), "snapshot_date", D2).rows == 1
    assert content(store.read("t")) == [("a", D1, 1), ("b", D2, 7)]
    assert store.replace_partition("t", frame(spark, []), "snapshot_date", D2).rows == 0
    assert content(store.read("t")) == [("a", D1, 1)]


def test_partition_replace_may_read_itself(spark, store):
    store.overwrite("t", frame(spark, [("a", D1, 1), ("a", D2, 2)]), ["snapshot_date"])
    bumped = store.read("t").where(F.col("snapshot_date") == F.lit(D1)).withColumn("v", F.col("v") + 1)
    store.replace_partition("t", bumped.select("customer_id", "snapshot_date", "v"), "snapshot_date", D1)
    assert content(store.read("t")) == [("a", D1, 2), ("a", D2, 2)]


def test_partition_replace_rejects_stray_rows(spark, store):
    store.overwrite("t", frame(spark, [("a", D1, 1)]), ["snapshot_date"])
    with pytest.raises(Exception, match="row outside partition"):
        store.replace_partition("t", frame(spark, [("a", D2, 1)]), "snapshot_date", D1)
    assert content(store.read("t")) == [("a", D1, 1)]


def test_insert_new_keeps_existing_rows(spark, store):
    assert store.insert_new("h", frame(spark, [("a", D1, 1)]), KEYS).rows == 1
    assert store.insert_new("h", frame(spark, [("a", D1, 99), ("b", D1, 2)]), KEYS).rows == 1
    assert content(store.read("h")) == [("a", D1, 1), ("b", D1, 2)]


def test_seed_statuses(spark, store):
    rows = frame(spark, [("a", D1, 1)]).withColumn("_source_type", F.lit("csv_seed"))
    assert store.seed("s", rows, "csv_seed").status == "created"
    assert store.seed("s", rows, "csv_seed").status == "skipped"
    assert store.seed("s", rows.withColumn("_source_type", F.lit("other")), "other").status == "appended"
    assert store.read("s").count() == 2


def test_publish_once(spark, store):
    batch = frame(spark, [("a", D1, 1), ("a", D1, 1), ("b", D1, 2)])
    assert store.publish_once("p", batch).status == "created"
    assert store.publish_once("p", batch.repartition(3)).status == "unchanged"
    with pytest.raises(WriteConflict):
        store.publish_once("p", batch.distinct())  # the same rows, one copy less
    assert store.read("p").count() == 3


def test_append_with_new_column_merges_on_read(spark, store):
    store.append("m", frame(spark, [("a", D1, 1)]))
    store.append("m", frame(spark, [("b", D1, 2)]).withColumn("extra", F.lit(1.5)))
    assert {(r.customer_id, r.extra) for r in store.read("m", merge=True).collect()} == {("a", None), ("b", 1.5)}


def test_create_if_absent(spark, store):
    like = frame(spark, [("a", D1, 1)])
    assert store.create_if_absent("c", like).status == "created"
    assert store.create_if_absent("c", like).status == "exists"
    assert store.read("c").count() == 0 and store.read("c").columns == like.columns


def test_insert_new_into_partitions(spark, store):
    first = frame(spark, [("a", D1, 1), ("b", D2, 2), ("n", None, 5)])
    assert store.insert_new("h", first, KEYS, ["snapshot_date"]).rows == 3
    more = frame(spark, [("a", D1, 99), ("a", D2, 3), ("c", date(2026, 1, 3), 4), ("n", None, 6)])
    # A null key matches nothing, as in MERGE.
    assert [store.insert_new("h", more, KEYS).rows for _ in range(2)] == [3, 1]
    rows = [tuple(r) for r in store.read("h").where("snapshot_date is not null").collect()]
    assert sorted(rows) == [("a", D1, 1), ("a", D2, 3), ("b", D2, 2), ("c", date(2026, 1, 3), 4)]
    store.append("h", frame(spark, [("z", D1, 7)]))  # goes by the table's own layout
    assert {r.customer_id for r in store.read_partitions("h", "snapshot_date", [D1]).collect()} == {"a", "z"}
    with pytest.raises(ValueError):
        store.append("h", more, ["customer_id"])


def test_insert_new_reads_only_touched_partitions(spark, store, monkeypatch):
    store.insert_new("h", frame(spark, [(str(d), date(2026, 1, d), d) for d in range(1, 21)]), KEYS, ["snapshot_date"])
    scanned = []
    scan = type(store).scan
    monkeypatch.setattr(type(store), "scan", lambda self, name, v: scanned.append(v.parts) or scan(self, name, v))
    assert store.insert_new("h", frame(spark, [("1", D1, 0), ("x", D2, 0)]), KEYS).rows == 1
    assert sorted(scanned[0].popitem()[1]) == ["snapshot_date=2026-01-01", "snapshot_date=2026-01-02"]


def test_a_failed_write_leaves_the_old_rows(spark, store):
    rows = frame(spark, [(f"k{i}", D1 if i % 2 else D2, i) for i in range(100)])
    store.overwrite("t", rows, ["snapshot_date"])
    before = content(store.read("t"))
    bad = rows.withColumn("v", F.when(F.col("v") == 63, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v") + 1))
    for write in (
        lambda: store.overwrite("t", bad, ["snapshot_date"]),
        lambda: store.append("t", bad),
        lambda: store.replace_partitions("t", bad, "snapshot_date"),
        lambda: store.replace_partition("t", bad.where(F.col("snapshot_date") == F.lit(D1)), "snapshot_date", D1),
        lambda: store.upsert("t", bad, KEYS, "snapshot_date"),
    ):
        with pytest.raises(Exception, match="lost"):
            write()
        assert content(store.read("t")) == before
    store.vacuum("t", keep=1)
    assert content(store.read("t")) == before


def test_readers_keep_their_version(spark, store):
    store.overwrite("t", frame(spark, [("a", D1, 1)]))
    old = store.read("t")
    store.overwrite("t", store.read("t").withColumn("v", F.col("v") + 1))  # reads what it replaces
    assert content(old) == [("a", D1, 1)] and content(store.read("t")) == [("a", D1, 2)]
    store.overwrite("t", frame(spark, []), ["snapshot_date"])
    assert store.read("t").count() == 0 and store.read("t").columns == old.columns


def test_a_second_writer_is_refused(spark, store):
    store.overwrite("t", frame(spark, [("a", D1, 1)]))
    seen = store.version("t")
    store.append("t", frame(spark, [("b", D1, 1)]))
    with pytest.raises(tables.ConcurrentWrite):
        store._commit("t", seen, seen)
    assert store.read("t").count() == 2


def test_numbered_batches_are_added_once(spark, store):
    for number, status in ((0, "appended"), (0, "skipped"), (1, "appended"), (0, "skipped")):
        assert store.append("b", frame(spark, [("a", D1, number)]), batch=("s", number)).status == status
    assert content(store.read("b")) == [("a", D1, 0), ("a", D1, 1)]


def test_partition_values_with_odd_characters(spark, store):
    rows = spark.createDataFrame([("a/b=c", 1), ("100%", 2), ("", 3), (None, 4), ("é", 5)], "k string, v int")
    store.overwrite("t", rows, ["k"])
    assert [r.v for r in store.read_partitions("t", "k", ["a/b=c", "é"]).orderBy("v").collect()] == [1, 5]
    store.replace_partitions("t", rows.limit(0), "k", ["100%", None])  # an empty text is a null partition in Spark
    assert sorted(r.v for r in store.read("t").collect()) == [1, 5]


def test_columns_may_not_change_their_type(spark, store):
    store.append("t", frame(spark, [("a", D1, 1)]))
    with pytest.raises(TypeError, match="column v"):
        store.append("t", frame(spark, [("a", D1, 1)]).withColumn("v", F.lit("x")))
    assert content(store.read("t")) == [("a", D1, 1)]


def test_vacuum_keeps_what_versions_need(spark, store):
    store.overwrite("t", frame(spark, [("a", D1, 1), ("a", D2, 2)]), ["snapshot_date"])
    for v in (3, 4):
        store.replace_partition("t", frame(spark, [("a", D2, v)]), "snapshot_date", D2)
    assert store.vacuum("t", keep=1) == 1  # the write of 3; the first one still holds D1
    assert content(store.read("t")) == [("a", D1, 1), ("a", D2, 4)]


def test_landing_layout(spark, tmp_path):
    land_json_by_day(frame(spark, [("a", D1, 1)]), str(tmp_path / "land"), "snapshot_date")
    assert list((tmp_path / "land" / "year=2026" / "month=01" / "day=01").glob("*.json"))


def test_latest_and_dedup_do_not_depend_on_layout(spark):
    rows = [("hot", D1, i) for i in range(300)] + [("x", D1, 1)]
    for n in (1, 5):
        df = frame(spark, rows).repartition(n)
        assert content(mutation.latest_per_key(df, ["customer_id"], ["snapshot_date", "v"])) == [("hot", D1, 299), ("x", D1, 1)]
        assert content(mutation.deduplicate(df, ["customer_id"], ["v"])) == [("hot", D1, 0), ("x", D1, 1)]


def test_latest_ranks_before_the_shuffle(spark):
    df = frame(spark, [("a", D1, 1)]).repartition(2)
    plan = mutation.latest_per_key(df, ["customer_id"], ["v"])._jdf.queryExecution().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_run_log(store):
    with runlog.track_run(store, "job", "r1") as run:
        run.output = {"rows": 3}
    with pytest.raises(RuntimeError):
        with runlog.track_run(store, "job", "r2"):
            raise RuntimeError("x" * 5000)
    skipped = runlog.RunRecorder(store, "job", "r3", status="skipped")
    skipped.started_at, skipped.finished_at = datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 0, 2)
    skipped.append()
    rows = {r.run_id: r for r in store.read(runlog.TABLE).collect()}
    assert (rows["r1"].status, rows["r1"].output_summary) == ("succeeded", '{"rows": 3}')
    assert rows["r2"].status == "failed" and rows["r2"].error_message == "x" * 5000
    assert (rows["r3"].status, rows["r3"].duration_seconds) == ("skipped", 2.0)
