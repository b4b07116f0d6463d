"""Upserts, insert-only merges, keyed dedup and content comparison on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """A source that must be unique on its key is not."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def duplicate_report(df: DataFrame, keys: Sequence[str], sample: int = 3) -> DataFrame:
    """The ``sample`` smallest duplicated keys with their count, for an error message."""
    return duplicate_keys(df, keys).orderBy(*keys).limit(sample)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    found = duplicate_report(df, keys).collect()
    if found:
        raise DuplicateKeys(f"duplicate keys on {list(keys)}: {[tuple(r) for r in found]}")
    return df


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], partition: str | None = None) -> DataFrame:
    """The rows of the touched part of ``target`` after a MERGE with ``source``.

    With ``partition`` only target partitions that occur in the source are read
    (the semi join prunes the scan at run time) and returned; without it, all rows.
    """
    touched = target
    if partition:
        # One row per partition value of the source, so the broadcast is bounded
        # by the number of partitions.
        dates = source.select(partition).distinct()
        touched = target.join(F.broadcast(dates), partition, "left_semi")
    kept = touched.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def rows_to_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is absent from ``target`` (matched rows are left as they are)."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(rows_to_insert(target, source, keys))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key: highest ``order`` columns, compared in turn.

    Spark ranks within each input partition first (window group limit), so at most
    one row per key and task is shuffled, even for a key with a third of all rows.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")


def deduplicate(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order``, so the survivor does not depend on the layout."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") == 1).drop("_rank")


def content_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``surplus`` = copies left minus right."""
    columns = left.columns
    signed = left.withColumn("_sign", F.lit(1)).unionByName(right.withColumn("_sign", F.lit(-1)))
    return (
        signed.groupBy(*columns)
        .agg(F.sum("_sign").alias("surplus"))
        .where(F.col("surplus") != 0)
    )
