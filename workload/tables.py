"""Views of the driver tables in the shape the operators expect, in Spark and in SQL.

Every view covers its whole table. The SQL texts are common table expressions with the
same columns, to be put in front of an oracle query.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2024, 1, 20)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


def contract_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` under the customer-event contract, with typed business time.

    The number in ``props`` splits two of the types and sets status and severity.
    """
    k, kind, value = F.col("k"), F.col("event_type"), F.col("value")
    typed = (
        F.when(kind == "click", "usage")
        .when(kind == "view", "support_call")
        .when(kind == "purchase", "payment")
        .when(kind == "signup", F.when(k < 50, "plan_change").otherwise("billing"))
        .otherwise(F.when(k < 50, "complaint").otherwise("cancellation"))
    )
    # Stepwise, so that the JSON field and the type are worked out once per row.
    e = (
        load(spark, sf_dir, "events")
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        .withColumn("event_type", typed)
    )
    return e.select(
        F.lit(1).alias("schema_version"),
        "event_id",
        "event_type",
        F.col("ts").alias("event_ts"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("customer_id"),
        F.when(kind.isin("payment", "billing"), value).alias("amount"),
        F.when(kind == "usage", value).alias("usage_gb"),
        F.when(kind == "payment", F.when(k % 4 == 0, "failed").otherwise("succeeded")).alias("payment_status"),
        F.when(kind == "complaint", F.when(k % 2 == 0, "high").otherwise("medium")).alias("complaint_severity"),
        "k",
    )


CONTRACT_EVENTS = """
ev AS (
  SELECT 1 AS schema_version, event_id, event_type, ts AS event_ts, 'C' || user_id AS customer_id,
         CASE WHEN event_type IN ('payment','billing') THEN value END AS amount,
         CASE WHEN event_type = 'usage' THEN value END AS usage_gb,
         CASE WHEN event_type = 'payment' THEN CASE WHEN k % 4 = 0 THEN 'failed' ELSE 'succeeded' END END AS payment_status,
         CASE WHEN event_type = 'complaint' THEN CASE WHEN k % 2 = 0 THEN 'high' ELSE 'medium' END END AS complaint_severity,
         k
  FROM (
    SELECT event_id, ts, user_id, value, k,
           CASE event_type WHEN 'click' THEN 'usage' WHEN 'view' THEN 'support_call' WHEN 'purchase' THEN 'payment'
             WHEN 'signup' THEN CASE WHEN k < 50 THEN 'plan_change' ELSE 'billing' END
             ELSE CASE WHEN k < 50 THEN 'complaint' ELSE 'cancellation' END END AS event_type
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
  )
)"""


def customer_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attribute row per customer and order day, from ``orders`` joined with ``customer``.

    The day is moved to the years 2018-2024 so that it lies around the event dates.
    """
    o, c = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    day = F.date_add(F.to_date("o_orderdate"), 8401)
    per_day = o.groupBy("o_custkey", day.alias("snapshot_date")).agg(
        F.count("*").cast("int").alias("tenure"),
        F.floor(F.max("o_totalprice") / 1000).cast("double").alias("monthly_charges"),
        F.max("o_totalprice").alias("total_charges"),
        F.max("o_orderpriority").alias("payment_method"),
        F.max("o_orderstatus").alias("contract"),
        F.max(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("churn_label"),
    )
    return per_day.join(c, per_day.o_custkey == c.c_custkey).select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        "snapshot_date",
        "tenure",
        "monthly_charges",
        "total_charges",
        "contract",
        F.col("c_mktsegment").alias("internet_service"),
        "payment_method",
        F.when(F.col("c_acctbal") > 4000, "Yes").otherwise("No").alias("tech_support"),
        (F.col("c_nationkey") % 2).cast("int").alias("senior_citizen"),
        "churn_label",
    )


CUSTOMER_SNAPSHOTS = """
snap AS (
  SELECT 'C' || o_custkey AS customer_id, snapshot_date, tenure, monthly_charges, total_charges, contract,
         c_mktsegment AS internet_service, payment_method,
         CASE WHEN c_acctbal > 4000 THEN 'Yes' ELSE 'No' END AS tech_support,
         CAST(c_nationkey % 2 AS INTEGER) AS senior_citizen, churn_label
  FROM (
    SELECT o_custkey, CAST(o_orderdate AS DATE) + 8401 AS snapshot_date, CAST(count(*) AS INTEGER) AS tenure,
           floor(max(o_totalprice) / 1000) AS monthly_charges, max(o_totalprice) AS total_charges,
           max(o_orderpriority) AS payment_method, max(o_orderstatus) AS contract,
           max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS churn_label
    FROM orders GROUP BY ALL
  ) JOIN customer ON o_custkey = c_custkey
)"""


def seed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as the 21 text columns of the seed file, with blanks and bad values."""
    c = load(spark, sf_dir, "customer")
    text = {
        "customerID": F.concat(F.lit(" C"), F.col("c_custkey").cast("string"), F.lit(" ")),
        "gender": F.lit("Female "),
        "SeniorCitizen": F.when(F.col("c_nationkey") == 3, "n/a").otherwise((F.col("c_nationkey") % 2).cast("string")),
        "Partner": F.lit("Yes"),
        "Dependents": F.lit(" No"),
        "tenure": (F.col("c_nationkey") - 1).cast("string"),
        "PhoneService": F.lit("Yes"),
        "MultipleLines": F.lit("No"),
        "InternetService": F.concat(F.col("c_mktsegment"), F.lit("  ")),
        "OnlineSecurity": F.lit("No"),
        "OnlineBackup": F.lit("No"),
        "DeviceProtection": F.lit("No"),
        "TechSupport": F.lit("Yes"),
        "StreamingTV": F.lit("No"),
        "StreamingMovies": F.lit("No"),
        "Contract": F.col("c_mktsegment"),
        "PaperlessBilling": F.lit("Yes"),
        "PaymentMethod": F.col("c_name"),
        "MonthlyCharges": F.when(F.col("c_nationkey") == 7, "").otherwise(F.col("c_acctbal").cast("string")),
        "TotalCharges": F.when(F.col("c_acctbal") < 0, " ").otherwise(F.col("c_acctbal").cast("string")),
        "Churn": F.when(F.col("c_nationkey") % 5 == 0, " YES")
        .when(F.col("c_nationkey") == 11, "maybe")
        .otherwise("no"),
    }
    return c.select(*[v.alias(k) for k, v in text.items()])


SEED_ROWS = """
seed AS (
  SELECT ' C' || c_custkey || ' ' AS customer_id,
         CASE WHEN c_nationkey = 3 THEN 'n/a' ELSE CAST(c_nationkey % 2 AS VARCHAR) END AS senior_citizen,
         CAST(c_nationkey - 1 AS VARCHAR) AS tenure, c_mktsegment || '  ' AS internet_service,
         c_mktsegment AS contract, c_name AS payment_method,
         CASE WHEN c_nationkey = 7 THEN '' ELSE CAST(c_acctbal AS VARCHAR) END AS monthly_charges,
         CASE WHEN c_acctbal < 0 THEN ' ' ELSE CAST(c_acctbal AS VARCHAR) END AS total_charges,
         CASE WHEN c_nationkey % 5 = 0 THEN ' YES' WHEN c_nationkey = 11 THEN 'maybe' ELSE 'no' END AS churn
  FROM customer
),
conformed AS (
  SELECT trim(customer_id) AS customer_id, DATE '2024-01-20' AS snapshot_date,
         TRY_CAST(nullif(trim(senior_citizen), '') AS INTEGER) AS senior_citizen,
         TRY_CAST(nullif(trim(tenure), '') AS INTEGER) AS tenure,
         trim(internet_service) AS internet_service, trim(contract) AS contract,
         trim(payment_method) AS payment_method,
         TRY_CAST(nullif(trim(monthly_charges), '') AS DOUBLE) AS monthly_charges,
         TRY_CAST(nullif(trim(total_charges), '') AS DOUBLE) AS total_charges,
         upper(substr(trim(churn), 1, 1)) || lower(substr(trim(churn), 2)) AS churn,
         CASE lower(trim(churn)) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS churn_label
  FROM seed
)"""


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 0/1 label and a score per order: nearly all scores distinct, one model per priority."""
    o = load(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.col("o_orderpriority").alias("model_version"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        (F.floor(F.col("o_totalprice") / 60) / 10000).alias("score"),
    )


SCORED_ORDERS = """
so AS (
  SELECT o_orderkey, o_orderpriority AS model_version, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
         floor(o_totalprice / 60) / 10000 AS score FROM orders
)"""

# Coefficients of the linear model that the scoring queries use.
COEFFICIENTS = {"total_charges": -0.00001, "tenure": 0.25, "senior_citizen": 0.4}
INTERCEPT = 1.5
THRESHOLD = 0.5867

LINEAR_SQL = "(1.5 + -0.00001 * total_charges + 0.25 * tenure + 0.4 * senior_citizen)"
