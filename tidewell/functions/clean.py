"""Text and number normalisation that never aborts a job on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(c: Column) -> Column:
    return F.trim(c)


def blank_to_null(c: Column) -> Column:
    """Trimmed text, with blank text as null."""
    return F.nullif(F.trim(c), F.lit(""))


def to_number(c: Column, type_name: str = "double") -> Column:
    """Parse trimmed text; blank or unparsable text becomes null, also under ANSI."""
    return blank_to_null(c).try_cast(type_name)


def yes_no_flag(c: Column) -> Column:
    """yes -> 1, no -> 0, anything else -> null; case and outer blanks are ignored."""
    word = F.lower(F.trim(c))
    return F.when(word == "yes", F.lit(1)).when(word == "no", F.lit(0))


def title_case(c: Column) -> Column:
    return F.initcap(F.trim(c))


def known_or(c: Column, default: str = "Unknown") -> Column:
    """Trimmed text with blanks and nulls replaced by a default label."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def has_text(c: Column) -> Column:
    """True for non-null, non-empty text, false otherwise."""
    return c.isNotNull() & (F.length(c) > 0)
