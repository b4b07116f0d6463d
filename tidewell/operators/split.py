"""Stratified train / validation / test split by hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import keys
from tidewell.operators.ordering import hash_cuts

# Cumulative percentages of each class, and the seed.
TRAIN_UPTO = 64
VALIDATION_UPTO = 80
SEED = 996


def split_digest(key: str, seed: int | str = SEED) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}|"), keys.joined_text([key])), 256)
    # Never null; saying so spares a null check that would hash every key again.
    return F.coalesce(digest, F.lit(""))


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    seed: int | str = SEED,
    train_upto: int = TRAIN_UPTO,
    validation_upto: int = VALIDATION_UPTO,
) -> DataFrame:
    """Add ``fold`` = train, validation or test, with exact shares within each class.

    Rows are ordered by a hash of their key and cut at fixed ranks, so the result
    does not depend on partitioning. The wide rows are never shuffled: only bucket
    counts and the few buckets at a cut are. Rows without a label get a null fold.
    """
    digest = split_digest(key, seed)
    cuts = hash_cuts(df, label, key, digest, [train_upto, validation_upto])
    # One row per class.
    marked = df.withColumn("_at", F.struct(digest.alias("_digest"), F.col(key).alias("_key"))).join(
        F.broadcast(cuts), label, "left"
    )
    first, second = F.col(f"cut_{train_upto}"), F.col(f"cut_{validation_upto}")
    fold = (
        F.when(F.col(label).isNull(), F.lit(None).cast("string"))
        .when(F.col("_at") <= first, "train")
        .when(F.col("_at") <= second, "validation")
        .otherwise("test")
    )
    return marked.select(*df.columns, fold.alias("fold"))
