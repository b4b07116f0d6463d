import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewell.operators import conform, drift, ordering, scoring
from tidewell.plans import daily

D = [date(2026, 1, 1) + timedelta(days=n) for n in range(10)]


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_offsets_of_many_groups_are_not_broadcast(spark):
    many = spark.range(300_000).select((F.col("id") % 100_000).alias("g"), F.col("id").alias("v"), F.lit(1).alias("n"))
    totals = ordering.running_totals(many, ["g"], "v", ["n"])
    assert "Broadcast" not in plan(totals) and "SortMergeJoin" in plan(totals)
    worst = totals.agg(F.max("all_n"), F.min("all_n"), F.sum(F.when(F.col("cum_n") == 1, 1)), F.max("cum_n")).first()
    assert tuple(worst) == (3, 3, 100_000, 3)


@pytest.mark.parametrize("hot", [False, True])
def test_global_rank(spark, hot):
    r = random.Random(1)
    rows = [(None if i % 50 == 0 else (7 if hot else r.randint(0, 30)), f"k{r.randint(0, 200)}", i % 3) for i in range(3000)] + [(1, "k1", 0)] * 5
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(6)
    got = ordering.global_rank(df, [F.col("a").desc_nulls_last(), F.col("b").asc()]).orderBy("position").collect()
    assert [x.position for x in got] == list(range(1, len(rows) + 1))
    assert [(x.a, x.b) for x in got] == [t[:2] for t in sorted(rows, key=lambda t: (t[0] is None, -(t[0] or 0), t[1]))]
    assert sorted((x.a or -1, x.b, x.c) for x in got) == sorted((a or -1, b, c) for a, b, c in rows)
    assert ordering.global_rank(df.limit(0), [F.col("a").asc()]).count() == 0


def test_equal_order_keys_are_spread_over_ranges(spark, monkeypatch):
    kept = []
    stage = ordering.stage
    monkeypatch.setattr(ordering, "stage", lambda df, purpose: kept.append(stage(df, purpose)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one range
    try:
        ordering.global_rank(spark.range(80_000).withColumn("same", F.lit(1)), [F.col("same").asc()]).count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in kept[0].groupBy(ordering.SLICE).count().collect()]
    assert max(sizes) < 30_000


def customers(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, snapshot_date date, contract string, churn_label int, monthly_charges double, tenure int")


def test_current_states(spark, store, monkeypatch):
    def row(c, d, contract):
        return (c, D[d], contract, d % 2, float(d), d)

    daily.merge_current(store, customers(spark, [row(f"c{i}", 1, "a") for i in range(200)]), buckets=16)
    read = []
    pick = type(store).read_partitions
    monkeypatch.setattr(type(store), "read_partitions", lambda self, n, c, v: read.append(list(v)) or pick(self, n, c, v))
    before = store.version(daily.CURRENT).parts
    daily.merge_current(store, customers(spark, [row("c5", 3, "b"), row("c6", 0, "old"), row("new", 2, "c")]))
    after = store.version(daily.CURRENT).parts
    assert len(read[0]) <= 3 < len(before.popitem()[1])  # of the 16 buckets only those of the three keys
    assert sum(len(p) for p in after.values()) == 16 and min(len(p) for p in after.values()) <= 3
    state = {r.customer_id: r.contract for r in daily.current_customers(store).collect()}
    assert len(state) == 201 and (state["c5"], state["c6"], state["new"]) == ("b", "a", "c")
    for _ in range(2):  # the same batch again changes nothing
        daily.merge_current(store, customers(spark, [row("c5", 3, "b2")]))
    assert daily.current_customers(store).where("customer_id = 'c5'").first().contract == "b2"
    summary = conform.segment_summary(daily.current_customers(store), segments=["contract"], snapshot_date=None)
    assert {r.contract: r.customers for r in summary.collect()} == {"a": 199, "b2": 1, "c": 1}


def test_attributes_come_from_current_states_where_none_is_newer(spark, store):
    rows = customers(spark, [("c1", D[1], "a", 0, 1.0, 1), ("c1", D[4], "b", 0, 1.0, 1)])
    store.overwrite(daily.CUSTOMERS, rows, ["snapshot_date"])
    daily.merge_current(store, rows.where(F.col("snapshot_date") == F.lit(D[4])))
    known = daily.customers_known_by(store, D[5])
    assert [r.contract for r in known.collect()] == ["b"] and all(daily.CUSTOMERS not in f for f in known.inputFiles())
    assert [r.contract for r in daily.customers_known_by(store, D[3]).collect()] == ["a"]


def predictions(spark, run, at, n):
    rows = [(run, f"c{i}", 0.5, at) for i in range(n)]
    return spark.createDataFrame(rows, "scoring_run_id string, customer_id string, churn_probability double, scored_at timestamp")


def test_latest_run_is_read_through_its_index(spark, store):
    runs = [("r1", datetime(2026, 1, 1), 3), ("r9", datetime(2026, 1, 2), 2), ("r5", datetime(2026, 1, 2), 4), ("r1", datetime(2026, 1, 9), 3)]
    added = [daily.store_predictions(store, predictions(spark, *r)).rows for r in runs]
    assert added == [3, 2, 4, 0]
    current = daily.current_predictions(store)
    assert {r.scoring_run_id for r in current.collect()} == {"r9"} and current.count() == 2  # the higher id of the newest two
    assert all("scoring_run_id=r9" in f for f in current.inputFiles())
    assert "PartitionFilters: [isnotnull(scoring_run_id" in plan(current)
    assert sorted(map(str, current.collect())) == sorted(map(str, scoring.current_scores(store.read(daily.HISTORY)).select(current.columns).collect()))


def training_rows(spark, days, shift=0):
    rows = [(f"c{i}", D[d], float((i * 7 + shift) % 13) if i % 5 else None, "x" if (i + shift) % 3 else "y") for d in days for i in range(60)]
    return spark.createDataFrame(rows, "customer_id string, snapshot_date date, usage double, plan string")


def labelled(spark, days):
    rows = [(f"c{i}", i % 2, D[d], 7, D[d] + timedelta(days=7)) for d in days for i in range(60)]
    return spark.createDataFrame(rows, "customer_id string, churned int, snapshot_date date, label_horizon_days int, maturity_date date")


def test_stored_baseline_counts_only_new_dates(spark, store):
    store.overwrite(daily.FEATURES, training_rows(spark, range(4)), ["snapshot_date"])
    store.overwrite(daily.LABELS, labelled(spark, range(3)), ["snapshot_date"])
    assert daily.refresh_baseline(store) == D[:3] and daily.refresh_baseline(store) == []
    store.append(daily.LABELS, labelled(spark, [3]))
    assert daily.refresh_baseline(store) == [D[3]]
    store.replace_partitions(daily.FEATURES, training_rows(spark, [1], shift=4), "snapshot_date")
    store.replace_partition(daily.LABELS, labelled(spark, [2]).limit(0), "snapshot_date", D[2])
    assert daily.refresh_baseline(store) == [D[1]]
    current, on = training_rows(spark, [5], shift=2), F.lit(D[5])

    def report(baseline):
        return sorted(map(str, drift.drift_report(baseline, current, on).drop("computed_at").collect()))

    assert report(daily.counted_baseline(store)) == report(daily.training_set(store))
    assert daily.monitor_drift(store).rows > 0


def test_a_staged_copy_leaves_the_setting_as_it_was(spark):
    from tidewell import session

    before = spark.conf.get(session.SHUFFLE_CLEANUP)
    with session.staged(spark.range(100).repartition(4).groupBy("id").count(), "setting") as rows:
        assert rows.count() == 100 and spark.conf.get(session.SHUFFLE_CLEANUP) == before
    with pytest.raises(Exception, match="no"):
        session.stage(spark.range(2).select(F.raise_error(F.lit("no")).cast("int").alias("x")), "setting")
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == before
