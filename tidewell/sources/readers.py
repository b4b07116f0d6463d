"""Batch scans with schema checks, lineage columns and guards."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import keys
from tidewell.sources.contract import SEED_COLUMNS, Contract, parse_with_rescue


class SourceError(ValueError):
    """The source does not have the shape the caller asked for."""


def require_columns(df: DataFrame, required: Iterable[str], what: str = "source") -> DataFrame:
    """Fail with the list of missing names; looks at metadata only."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise SourceError(f"{what} is missing required columns: {missing}")
    return df


def require_rows(df: DataFrame, what: str = "source") -> DataFrame:
    """Fail when there is no row; stops at the first one found."""
    if df.isEmpty():
        raise SourceError(f"{what} is empty")
    return df


def check_header(spark: SparkSession, path: str, expected: Sequence[str]) -> None:
    """Compare the header line with the expected names, order included."""
    actual = spark.read.option("header", True).csv(path).columns
    if actual != list(expected):
        raise SourceError(f"unexpected CSV columns: expected {list(expected)}, received {actual}")


def read_seed_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = SEED_COLUMNS,
    source_type: str = "csv_seed",
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Strict all-string CSV scan with record hash and lineage columns."""
    check_header(spark, path, columns)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    stamp = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    tagged = rows.withColumns(
        {
            "_record_hash": keys.record_hash(columns),
            "_ingested_at": stamp,
            "_source_file": F.col("_metadata.file_path"),
            "_source_type": F.lit(source_type),
        }
    )
    return require_rows(tagged, f"CSV {path}")


def read_json_lines(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Batch scan of JSON lines by contract, unknown fields rescued, with the file path."""
    raw = (
        spark.read.schema("value string")
        .option("recursiveFileLookup", "true")
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("_source_file"))
    )
    return parse_with_rescue(raw, contract)
