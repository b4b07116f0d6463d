"""Upsert, insert-only merge, partition replacement, latest rows and dedup queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidewell.operators import mutation
from tidewell.operators.ordering import global_rank
from tidewell.session import scratch_path
from tidewell.sources.tables import TableStore, WriteConflict
from workload.tables import load

KEYS = ["o_orderkey", "month"]


def _orders(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey",
        F.trunc(F.to_date("o_orderdate"), "month").alias("month"),
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
    )


def _target(spark, sf):
    """Orders up to the middle of 1999, as stored."""
    return _orders(spark, sf).where(F.col("month") < F.lit(date(1999, 7, 1)))


def _source(spark, sf):
    """Orders from 1999 on, with a revised status; the first half of 1999 overlaps the target."""
    return (
        _orders(spark, sf)
        .where(F.col("month") >= F.lit(date(1999, 1, 1)))
        .withColumn("o_orderstatus", F.concat(F.col("o_orderstatus"), F.lit("-revised")))
    )


TARGET_SOURCE = """
o AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_custkey, o_orderstatus, o_totalprice FROM orders),
tgt AS (SELECT * FROM o WHERE month < DATE '1999-07-01'),
src AS (SELECT * REPLACE (o_orderstatus || '-revised' AS o_orderstatus) FROM o WHERE month >= DATE '1999-01-01')"""


def upsert_merge(spark, sf):
    return mutation.upsert(_target(spark, sf), _source(spark, sf), KEYS, "month")


def upsert_table(spark, sf):
    """The same merge through stored tables: write, upsert by touched partition, read all back."""
    store = TableStore(spark, scratch_path(spark, "upsert-table"))
    store.overwrite("orders", _target(spark, sf), ["month"])
    store.upsert("orders", _source(spark, sf), KEYS, "month")
    return store.read("orders").groupBy("month", "o_orderstatus").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


def insert_only_merge(spark, sf):
    return mutation.insert_only(_target(spark, sf), _source(spark, sf), KEYS)


def insert_only_table(spark, sf):
    """Insert-only merge into a stored history; the second, repeated batch adds nothing."""
    store = TableStore(spark, scratch_path(spark, "history"))
    store.insert_new("history", _target(spark, sf), KEYS)
    store.insert_new("history", _source(spark, sf), KEYS)
    store.insert_new("history", _source(spark, sf), KEYS)
    return store.read("history").groupBy("month", "o_orderstatus").agg(F.count("*").alias("orders"))


def insert_only_partitioned(spark, sf):
    """Insert-only merge into a table partitioned by month, the batch given twice; no row is lost or doubled."""
    store = TableStore(spark, scratch_path(spark, "history-by-month"))
    store.insert_new("history", _target(spark, sf), KEYS, ["month"])
    for _ in range(2):
        store.insert_new("history", _source(spark, sf), KEYS)
    return store.read("history").select("o_orderkey", "month", "o_orderstatus", "o_totalprice")


class Interrupted(RuntimeError):
    """Stands for a job that dies while it writes."""


def overwrite_versions(spark, sf):
    """A table replaced by a frame that reads it, then by a write that fails, then one month replaced and one emptied."""
    store = TableStore(spark, scratch_path(spark, "versions"))
    store.overwrite("orders", _target(spark, sf), ["month"])
    first = store.read("orders")
    store.overwrite("orders", first.withColumn("o_totalprice", F.col("o_totalprice") + 1), ["month"])
    dies = F.when(F.col("o_orderkey") % 3 == 0, F.raise_error(F.lit("interrupted")).cast("double")).otherwise(0.0)
    try:
        store.overwrite("orders", store.read("orders").withColumn("o_totalprice", dies), ["month"])
        raise Interrupted("the write should have failed")
    except Interrupted:
        raise
    except Exception as error:
        if "interrupted" not in str(error):
            raise
    march = first.where(F.col("month") == F.lit(date(1998, 3, 1)))
    store.replace_partitions("orders", march, "month", [date(1998, 3, 1), date(1998, 4, 1)])
    # ``first`` is still what it was.
    old = first.groupBy("month").agg(F.count("*").alias("orders_before"), F.round(F.sum("o_totalprice"), 2).alias("total_before"))
    new = store.read("orders").groupBy("month").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return old.join(new, "month", "left")


REPLACED = date(2024, 1, 12)


def partition_replace(spark, sf):
    """Daily event totals stored by day; one day is replaced by other numbers, another emptied."""
    daily = (
        load(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("snapshot_date"), "user_id")
        .agg(F.count("*").alias("n"))
    )
    store = TableStore(spark, scratch_path(spark, "replace"))
    store.overwrite("daily", daily, ["snapshot_date"])
    revised = daily.where(F.col("snapshot_date") == F.lit(REPLACED)).withColumn("n", F.col("n") + 1000)
    store.replace_partition("daily", revised, "snapshot_date", REPLACED)
    store.replace_partition("daily", daily.limit(0), "snapshot_date", date(2024, 1, 13))
    return store.read("daily").select("snapshot_date", "user_id", "n")


def append_new_column(spark, sf):
    """Later orders bring a column that stored rows lack; those read null there."""
    store, orders = TableStore(spark, scratch_path(spark, "append")), _orders(spark, sf)
    later = orders.where(F.col("month") >= F.lit(date(1999, 7, 1))).withColumn("half", F.quarter("month") > 2)
    store.append("orders", _target(spark, sf), partition_by=["month"])
    store.append("orders", later)
    return store.read("orders").select(*orders.columns, "half")


def seed_sources(spark, sf):
    """Two sources seed one table, each of them twice; the second time is skipped."""
    store, orders = TableStore(spark, scratch_path(spark, "seed")), _orders(spark, sf)
    for status in ("F", "O", "F", "O"):
        store.seed("orders", orders.where(F.col("o_orderstatus") == status).withColumn("_source_type", F.lit(status)), status)
    return store.read("orders").select("o_orderkey", "month", "o_totalprice", "_source_type")


def published_once(spark, sf):
    """A batch published twice with its rows dealt out otherwise; changed rows are refused and leave it as it is."""
    store, orders = TableStore(spark, scratch_path(spark, "publish")), _orders(spark, sf)
    said = [store.publish_once("orders", rows).status for rows in (orders, orders.repartition("o_custkey"))]
    try:
        said.append(store.publish_once("orders", orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)).status)
    except WriteConflict:
        said.append("refused")
    return store.read("orders").withColumn("said", F.lit(",".join(said)))


def latest_per_key(spark, sf):
    newest = mutation.latest_per_key(load(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


def dedup_events(spark, sf):
    """Two overlapping deliveries of ``events``; the copy with the lower value survives."""
    e = load(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    resent = e.where(F.col("event_type") != "click").withColumn("value", F.col("value") - 1)
    return mutation.deduplicate(e.unionByName(resent), ["event_id"], ["value"])


def write_once_check(spark, sf):
    o = _orders(spark, sf)
    changed = o.withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    return mutation.content_difference(o, changed)


def ordered_events(spark, sf):
    """All events with their position in the total order on (type, time, user, id)."""
    events = load(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    order = [F.col(c).asc() for c in ("event_type", "ts", "user_id", "event_id")]
    return global_rank(events, order).select("position", "event_id", "user_id", "event_type")


QUERIES = {
    "upsert_merge": (
        upsert_merge,
        f"WITH {TARGET_SOURCE} SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE month IN (SELECT month FROM src) "
        "AND o_orderkey NOT IN (SELECT o_orderkey FROM src)",
    ),
    "upsert_table": (
        upsert_table,
        f"WITH {TARGET_SOURCE}, r AS (SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE o_orderkey NOT IN "
        "(SELECT o_orderkey FROM src)) SELECT month, o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total "
        "FROM r GROUP BY ALL",
    ),
    "insert_only_merge": (
        insert_only_merge,
        f"WITH {TARGET_SOURCE} SELECT * FROM tgt UNION ALL SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)",
    ),
    "insert_only_table": (
        insert_only_table,
        f"WITH {TARGET_SOURCE}, r AS (SELECT * FROM tgt UNION ALL SELECT * FROM src WHERE o_orderkey NOT IN "
        "(SELECT o_orderkey FROM tgt)) SELECT month, o_orderstatus, count(*) AS orders FROM r GROUP BY ALL",
    ),
    "insert_only_partitioned": (
        insert_only_partitioned,
        f"WITH {TARGET_SOURCE} SELECT o_orderkey, month, o_orderstatus, o_totalprice FROM tgt UNION ALL "
        "SELECT o_orderkey, month, o_orderstatus, o_totalprice FROM src WHERE NOT EXISTS "
        "(SELECT 1 FROM tgt WHERE tgt.o_orderkey = src.o_orderkey AND tgt.month = src.month)",
    ),
    "overwrite_versions": (
        overwrite_versions,
        f"""WITH {TARGET_SOURCE},
a AS (SELECT month, count(*) AS orders_before, round(sum(o_totalprice), 2) AS total_before FROM tgt GROUP BY month),
b AS (SELECT month, count(*) AS orders, round(sum(o_totalprice + CASE WHEN month = DATE '1998-03-01' THEN 0 ELSE 1 END), 2) AS total
      FROM tgt WHERE month <> DATE '1998-04-01' GROUP BY month)
SELECT month, orders_before, total_before, orders, total FROM a LEFT JOIN b USING (month)""",
    ),
    "partition_replace": (
        partition_replace,
        "SELECT CAST(ts AS DATE) AS snapshot_date, user_id, count(*) + CASE WHEN CAST(ts AS DATE) = DATE '2024-01-12' "
        "THEN 1000 ELSE 0 END AS n FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-13' GROUP BY CAST(ts AS DATE), user_id",
    ),
    "append_new_column": (
        append_new_column,
        "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_custkey, o_orderstatus, o_totalprice, "
        "CASE WHEN o_orderdate >= DATE '1999-07-01' THEN quarter(o_orderdate) > 2 END AS half FROM orders",
    ),
    "seed_sources": (
        seed_sources,
        "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_totalprice, o_orderstatus AS _source_type "
        "FROM orders WHERE o_orderstatus IN ('F', 'O')",
    ),
    "published_once": (
        published_once,
        "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_custkey, o_orderstatus, o_totalprice, "
        "'created,unchanged,refused' AS said FROM orders",
    ),
    "latest_per_key": (
        latest_per_key,
        "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER "
        "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    ),
    "dedup_events": (
        dedup_events,
        "SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'click' THEN value - 1 ELSE value END AS value FROM events",
    ),
    "write_once_check": (
        write_once_check,
        "WITH o AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_custkey, o_orderstatus, "
        "o_totalprice FROM orders WHERE o_orderstatus = 'P') SELECT *, CAST(1 AS BIGINT) AS surplus FROM o UNION ALL "
        "SELECT * REPLACE (o_totalprice + 1 AS o_totalprice), CAST(-1 AS BIGINT) FROM o",
    ),
    "ordered_events": (ordered_events, "SELECT row_number() OVER (ORDER BY event_type, ts, user_id, event_id) AS position, event_id, user_id, event_type FROM events"),
}
