import hashlib

import pytest
from pyspark.sql import functions as F

from tidewell.functions import bands, clean, keys


def one(spark, df_expr, rows, ddl):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(df_expr).collect()]


def test_record_hash_keeps_positions_of_nulls(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a", "b", "")]
    got = one(spark, keys.record_hash(["x", "y", "z"]), rows, "x string, y string, z string")
    want = [hashlib.sha256(t.encode()).hexdigest() for t in ("a||b", "a|b|", "a|b|")]
    assert got == want


def test_hash_uniform_equals_python(spark):
    ids = [f"c{i}" for i in range(500)]
    got = one(spark, keys.hash_uniform(["id"], 7), [(i,) for i in ids], "id string")
    want = [int.from_bytes(hashlib.sha256(f"7|{i}".encode()).digest()[:8], "big") / 2.0**64 for i in ids]
    assert got == want
    assert 0.4 < sum(got) / len(got) < 0.6


def test_cleaning_never_fails(spark):
    rows = [(" 12 ",), ("",), ("  ",), ("junk",), (None,), ("3.5",)]
    assert one(spark, clean.to_number(F.col("v")), rows, "v string") == [12.0, None, None, None, None, 3.5]
    assert one(spark, clean.to_number(F.col("v"), "int"), rows[:4], "v string") == [12, None, None, None]
    flags = [(" YES",), ("no ",), ("maybe",), (None,)]
    assert one(spark, clean.yes_no_flag(F.col("v")), flags, "v string") == [1, 0, None, None]
    assert one(spark, clean.title_case(F.col("v")), [(" yES ",)], "v string") == ["Yes"]
    assert one(spark, clean.known_or(F.col("v")), [(" ",), ("x ",), (None,)], "v string") == ["Unknown", "x", "Unknown"]


def test_recency_key_orders_by_time_then_id(spark):
    rows = [("2024-01-01 00:00:00", 5), ("2024-01-01 00:00:00", 9), ("2024-01-01 00:00:00.000001", 1)]
    df = spark.createDataFrame(rows, "t string, id bigint").withColumn("t", F.col("t").cast("timestamp"))
    ordered = [r.id for r in df.orderBy(keys.recency_key(F.col("t"), F.col("id"))).collect()]
    assert ordered == [5, 9, 1]


@pytest.mark.parametrize("limit", [0.125, 0.75, 1.0])
def test_risk_bands_start_at_the_limit_and_its_share(spark, limit):
    medium = limit * bands.MEDIUM_SHARE
    step = 2.0**-40
    rows = [(medium - step,), (medium,), (limit - step,), (limit,)]
    assert one(spark, bands.risk_segment(F.col("p"), limit), rows, "p double") == ["Low", "Medium", "Medium", "High"]


def test_null_is_low_unless_strict(spark):
    assert one(spark, bands.risk_segment(F.col("p"), 0.75, strict=False), [(None,)], "p double") == ["Low"]


def test_thresholds_lie_above_zero_and_up_to_one():
    assert bands.check_threshold(1) == 1.0
    for bad in (0, -3, 1 + 1e-9, float("-inf"), float("nan")):
        with pytest.raises(ValueError, match="threshold"):
            bands.check_threshold(bad)


@pytest.mark.parametrize("p", [None, float("nan"), float("-inf"), -1e-12, 2.0])
def test_an_unusable_probability_fails_the_job(spark, p):
    df = spark.createDataFrame([(0.2,), (p,)], "p double").select(bands.risk_segment(F.col("p"), 0.75))
    with pytest.raises(Exception, match="probability must be finite"):
        df.collect()


def test_edge_bin_closes_the_last_bin(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.5, 1.0, 1.9, 2.0, 2.1)], "v double")
    got = [r[0] for r in df.select(bands.edge_bin(F.col("v"), F.array(*map(F.lit, (0.0, 1.0, 2.0))))).collect()]
    assert got == [None, 1, 1, 2, 2, 2, None]
