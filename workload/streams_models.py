"""Streaming ingestion and Spark ML queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewell.operators import training
from tidewell.operators.drift import split_features
from tidewell.session import scratch_path, stage
from tidewell.sources import tables
from tidewell.sources.contract import EVENT_CONTRACT, parse_with_rescue
from tidewell.streaming import ingest
from workload.tables import CONTRACT_EVENTS, CUSTOMER_SNAPSHOTS, contract_events, customer_snapshots, load, rounded


def landing_rows(spark, sf):
    """Contract events as they are landed: text ids and times, a stranger field on some."""
    e = contract_events(spark, sf)
    iso = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    shaped = e.withColumns(
        {
            "event_id": F.when(F.col("k") == 0, F.lit(None)).otherwise(F.concat(F.lit("e"), F.col("event_id").cast("string"))),
            "event_timestamp": iso,
            "event_date": F.date_format("event_ts", "yyyy-MM-dd"),
            "rogue": F.when(F.col("k") == 7, F.lit("x")),
        }
    )
    names = [n for n in EVENT_CONTRACT.names if n in shaped.columns]
    return shaped.select(*names, "rogue", "k")


def _ingest_twice(spark, sf):
    """Land all events, ingest, land the payments a second time, ingest again."""
    base = scratch_path(spark, "stream")
    store = tables.TableStore(spark, f"{base}/tables")
    rows = landing_rows(spark, sf)
    tables.land_json_by_day(rows.drop("k"), f"{base}/landing", "event_date")
    ingest.ingest_events(store, f"{base}/landing", f"{base}/checkpoint")
    again = rows.where(F.col("event_type") == "payment").drop("k")
    tables.land_json_by_day(again, f"{base}/landing", "event_date")
    ingest.ingest_events(store, f"{base}/landing", f"{base}/checkpoint")
    return store, f"{base}/landing", f"{base}/checkpoint"


def _bronze(spark, sf):
    return _ingest_twice(spark, sf)[0].read(ingest.BRONZE)


def stream_ingest_dedup(spark, sf):
    return _bronze(spark, sf).select(
        "event_id", "event_type", "customer_id", "amount", "usage_gb", "payment_status", "complaint_severity",
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        F.get_json_object("_rescued_data", "$.rogue").alias("rogue"),
    )


def stream_rejects(spark, sf):
    rejects = _ingest_twice(spark, sf)[0].read(ingest.REJECTS)
    return rejects.groupBy("event_type").agg(F.count("*").alias("rejected"))


def stream_summary(spark, sf):
    return ingest.ingest_summary(_bronze(spark, sf))


def stream_replay_noop(spark, sf):
    """Rows by table and event day after the stream ran again and each old batch was delivered once more."""
    store, landing, checkpoint = _ingest_twice(spark, sf)
    ingest.ingest_events(store, landing, checkpoint)
    lines = spark.read.schema("value string").option("recursiveFileLookup", "true").text(landing)
    parsed = parse_with_rescue(lines.select("value", F.col("_metadata.file_path").alias("_source_file")), EVENT_CONTRACT)
    settings = ingest.IngestSettings()
    for source, newest in store.version(ingest.BRONZE).marks.items():
        for number in range(newest + 1):
            ingest.land_batch(store, ingest.enrich(parsed, settings), source, number)
    bronze = store.read(ingest.BRONZE).groupBy("event_day").agg(F.count("*").alias("events"))
    arrived = store.read(ingest.ARRIVALS).groupBy("event_day").agg(F.sum("events").alias("arrived"))
    return bronze.join(arrived, "event_day", "left")


STREAM_SQL = f"""
WITH {CONTRACT_EVENTS}
SELECT 'e' || event_id AS event_id, event_type, customer_id, amount, usage_gb, payment_status, complaint_severity,
       strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_time, CASE WHEN k = 7 THEN 'x' END AS rogue
FROM ev WHERE k <> 0"""


def _labelled(spark, sf):
    """Customer snapshots with a label to learn: one row per customer and order day."""
    snap = customer_snapshots(spark, sf)
    row_id = F.concat_ws("@", "customer_id", "snapshot_date")
    return snap.withColumn("row_id", row_id).withColumnRenamed("churn_label", "label")


def ml_preprocess(spark, sf):
    """Learned fill values: exact medians and most frequent categories."""
    data = _labelled(spark, sf).drop("row_id", "snapshot_date", "label", "customer_id")
    numeric, categorical = split_features(data, data)
    medians = training.median_values(data, numeric).select("feature", F.col("fill").cast("string").alias("fill"))
    modes = training.most_frequent_values(data, categorical)
    return medians.unionByName(modes)


_NUMBERS = ("tenure", "monthly_charges", "total_charges", "senior_citizen")
_TEXTS = ("contract", "internet_service", "payment_method", "tech_support")
ML_PREPROCESS_SQL = f"WITH {CUSTOMER_SNAPSHOTS} " + " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, CAST(quantile_cont({c}::DOUBLE, 0.5) AS VARCHAR) AS fill FROM snap" for c in _NUMBERS]
    + [
        f"SELECT '{c}', fill FROM (SELECT {c} AS fill FROM snap GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        for c in _TEXTS
    ]
)


def ml_preprocess_vectors(spark, sf):
    """What the vectors hold: the rows in each one-hot position, and mean and deviation behind each scaled number."""
    data = _labelled(spark, sf).drop("row_id", "snapshot_date", "label", "customer_id")
    numeric, categorical = split_features(data, data)
    filled = training.learn_imputation(data, numeric, categorical).apply(data)
    labels = training.category_labels(filled.select(*[F.col(f"{c}_filled").alias(c) for c in categorical]), categorical)
    fitted = Pipeline(stages=training.preprocessing_stages(numeric, labels)).fit(filled)
    positions = fitted.transform(filled).select(F.posexplode(vector_to_array("features")).alias("position", "x"))
    sums = positions.groupBy("position").agg(F.sum("x").alias("total"), F.sum(F.col("x") * F.col("x")).alias("squares"))
    scaler = next(s for s in fitted.stages if hasattr(s, "std"))
    names = [(c, v, None, None) for c, vs in labels.items() for v in vs]
    names += [(c, None, float(m), float(d)) for c, m, d in zip(numeric, scaler.mean, scaler.std)]
    ddl = "position int, feature string, value string, mean double, deviation double"
    named = spark.createDataFrame([(i, *n) for i, n in enumerate(names)], ddl)
    clear = {c: F.round(F.col(c), 3) + F.lit(0.0) for c in ("total", "squares")}
    return rounded(named.join(sums, "position").withColumns(clear), 6, "mean", "deviation")


def category_codes(spark, sf):
    """Part names, types and brands coded by falling count; every part has the code of its name."""
    part = load(spark, sf, "part")
    codes = stage(training.category_codes(part, ["p_name", "p_type", "p_brand"]), "codes")
    return training.encode_categories(part.select("p_partkey", "p_name"), codes, "p_name").select("p_partkey", "p_name_code").join(
        training.encode_categories(part.select("p_partkey", "p_type"), codes, "p_type").select("p_partkey", "p_type_code"), "p_partkey"
    )


def _filled_sql() -> str:
    texts = [f"coalesce({c}, (SELECT {c} FROM snap GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}" for c in _TEXTS]
    numbers = [f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM snap)) AS {c}" for c in _NUMBERS]
    return f"SELECT {', '.join(texts + numbers)} FROM snap"


def _vectors_sql() -> str:
    onehot = " UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature, {c} AS value, count(*) AS n FROM t GROUP BY {c}" for i, c in enumerate(_TEXTS))
    scaled = " UNION ALL ".join(
        f"SELECT {i} AS f, '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS deviation FROM t" for i, c in enumerate(_NUMBERS)
    )
    return f"""
WITH {CUSTOMER_SNAPSHOTS}, t AS ({_filled_sql()}), o AS ({onehot}), s AS ({scaled}),
k AS (SELECT *, row_number() OVER (ORDER BY f, n DESC, value) - 1 AS position FROM o)
SELECT CAST(position AS INTEGER) AS position, feature, value, NULL::DOUBLE AS mean, NULL::DOUBLE AS deviation,
       n::DOUBLE AS total, n::DOUBLE AS squares FROM k
UNION ALL
SELECT CAST((SELECT count(*) FROM o) + f AS INTEGER), feature, NULL, round(mean, 6), round(deviation, 6), 0.0,
       CASE WHEN deviation > 0 THEN (SELECT count(*) - 1 FROM t)::DOUBLE ELSE 0.0 END FROM s"""


#: The last comparison, by application and input; both queries use the same fit.
_LAST: dict = {}


def _compare(spark, sf):
    """All candidates with the operator's defaults, fitted once for both queries of an application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LAST:
        data = stage(_labelled(spark, sf), "ml-input")
        result = training.train_and_compare(data, "label", "row_id", training.default_candidates("label"))
        _LAST.clear()
        _LAST[key] = result
    return _LAST[key]


def ml_candidates(spark, sf):
    result = _compare(spark, sf)
    return training.comparison_frame(spark, result).drop("trained_at")


def ml_scores(spark, sf):
    """Class probabilities of the winning model for every snapshot."""
    result = _compare(spark, sf)
    scored = result.score(_labelled(spark, sf))
    return rounded(scored.select("row_id", "label", training.PROBABILITY), 6, training.PROBABILITY)


QUERIES = {
    "stream_ingest_dedup": (stream_ingest_dedup, STREAM_SQL),
    "stream_rejects": (
        stream_rejects,
        f"WITH {CONTRACT_EVENTS} SELECT event_type, CAST(sum(CASE WHEN event_type = 'payment' THEN 2 ELSE 1 END) AS BIGINT) AS rejected "
        "FROM ev WHERE k = 0 GROUP BY event_type",
    ),
    "stream_replay_noop": (
        stream_replay_noop,
        f"WITH {CONTRACT_EVENTS} SELECT CAST(event_ts AS DATE) AS event_day, count(*) AS events, count(*) AS arrived FROM ev WHERE k <> 0 GROUP BY ALL",
    ),
    "stream_summary": (
        stream_summary,
        f"WITH {CONTRACT_EVENTS} SELECT count(*) AS total_rows, count(*) FILTER (WHERE k = 7) AS rescued_rows FROM ev WHERE k <> 0",
    ),
    "ml_preprocess": (ml_preprocess, ML_PREPROCESS_SQL),
    "ml_preprocess_vectors": (ml_preprocess_vectors, _vectors_sql()),
    "category_codes": (
        category_codes,
        "WITH n AS (SELECT p_name, CAST(row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS INTEGER) AS p_name_code FROM part GROUP BY p_name), "
        "t AS (SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS INTEGER) AS p_type_code FROM part GROUP BY p_type) "
        "SELECT p_partkey, p_name_code, p_type_code FROM part LEFT JOIN n USING (p_name) LEFT JOIN t USING (p_type)",
    ),
    "ml_candidates": (ml_candidates, None),
    "ml_scores": (ml_scores, None),
}
