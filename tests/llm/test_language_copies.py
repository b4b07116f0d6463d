"""What language identification learns from copied texts."""

from pyspark.sql import functions as F

from tidewell.llm import language


def test_copies_do_not_displace_texts(spark):
    few = spark.range(30_000).select(F.lit("aa").alias("lang"), F.concat(F.lit("text "), (F.col("id") % 30).cast("string")).alias("text"))
    many = spark.range(2_000).select(F.lit("bb").alias("lang"), F.concat(F.lit("words "), F.col("id").cast("string")).alias("text"))
    rows = few.unionByName(many)
    learned = dict(language.learn(rows))
    assert sorted(learned["aa"]) == sorted(f"text {k}" for k in range(30))
    smallest = many.orderBy(F.pmod(F.xxhash64("text"), F.lit(1 << 30))).limit(language.SAMPLE_DOCS)
    assert list(learned["bb"]) == [r.text for r in smallest.collect()]
    assert learned == dict(language.learn(rows.distinct()))
