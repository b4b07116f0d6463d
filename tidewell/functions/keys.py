"""Hash keys and hash-based uniforms, all as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_64 = 18446744073709551616.0


def joined_text(columns: Sequence[str | Column], separator: str = "|") -> Column:
    """Columns joined as text with nulls as empty strings, so positions never shift."""
    parts = [F.coalesce(_as_column(c).cast("string"), F.lit("")) for c in columns]
    return F.concat_ws(separator, *parts)


def record_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-256 over all given columns of a row."""
    return F.sha2(joined_text(columns), 256)


def event_identity(columns: Sequence[str | Column], version: int = 1) -> Column:
    """Deterministic event id: SHA-256 of the version tag and the identity columns."""
    return F.sha2(F.concat(F.lit(f"v{version}|"), joined_text(columns)), 256)


def hash_uniform(columns: Sequence[str | Column], seed: int | str) -> Column:
    """A uniform in [0, 1) that depends only on the seed and the column values.

    The first eight bytes of the digest, read as an unsigned integer, over 2^64.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}|"), joined_text(columns)), 256)
    unsigned = F.conv(F.substring(digest, 1, 16), 16, 10)
    return unsigned.cast("decimal(20,0)").cast("double") / F.lit(TWO_POW_64)


def recency_key(ts: Column, tie_breaker: Column) -> Column:
    """Order by time, then by tie-breaker, packed into one decimal(38,0).

    A decimal keeps ``max_by`` inside hash aggregation; ordering by a struct
    would turn the whole aggregate into a sort-based one. Tie-breakers are
    non-negative integers.
    """
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(19,0)")
    scaled = micros * F.lit("18446744073709551616").cast("decimal(20,0)")
    return (scaled + tie_breaker.cast("decimal(20,0)")).cast("decimal(38,0)")


def _as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
