"""Null and date normalization used when projecting JSON records into tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(c: Column | str) -> Column:
    """'' becomes NULL; other values, NULL included, pass through."""
    return F.nullif(col(c), F.lit(""))


def keep_empty(c: Column | str) -> Column:
    """An absent value becomes ''; used for columns declared non-null whose empty value is kept."""
    return F.coalesce(col(c), F.lit(""))


def zero_to_null(c: Column | str, dtype: str = "int") -> Column:
    """A year of 0 means unknown."""
    return F.nullif(col(c), F.lit(0)).cast(dtype)


def strict_date(c: Column | str) -> Column:
    """ISO ``yyyy-MM-dd`` text to a date; '' and NULL give NULL, anything else malformed raises."""
    text = empty_to_null(c)
    parsed = F.try_to_date(text, "yyyy-MM-dd")
    return F.when(text.isNull(), F.lit(None).cast("date")).when(
        parsed.isNull() | ~text.rlike(r"^\d{4}-\d{2}-\d{2}$"),
        F.raise_error(F.concat(F.lit("invalid published_date: "), text)).cast("date"),
    ).otherwise(parsed)


def lenient_date(c: Column | str) -> Column:
    """Same parse as :func:`strict_date` but malformed text gives NULL (quarantine form)."""
    text = empty_to_null(c)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def is_valid_date_text(c: Column | str) -> Column:
    text = empty_to_null(c)
    return text.isNull() | (text.rlike(r"^\d{4}-\d{2}-\d{2}$")
                            & F.try_to_date(text, "yyyy-MM-dd").isNotNull())
