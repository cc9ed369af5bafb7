"""Scalar column expressions: label, release year, title, type split, formatting."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
POSITIVE_RATING = 3.5      # a rating at or above this is a positive (label 1)
DEFAULT_RELEASE_YEAR = 1990  # year used when a title carries none
NUMBER_PRECISION = 2       # decimals of the formatted statistics
TYPE_SEPARATOR = "|"       # separator inside the `types` field


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label(rating: Column | str, threshold: float = POSITIVE_RATING) -> Column:
    """1 when rating >= threshold, else 0 (a null rating gives 0)."""
    return F.when(_c(rating) >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def _strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(_c(c), r"^[\s\u0085\p{Z}]+|[\s\u0085\p{Z}]+$", "")


def release_year(title: Column | str, default: int = DEFAULT_RELEASE_YEAR) -> Column:
    """Four characters before the last one of the trimmed title, as int.

    Null, empty, or shorter than six characters after trimming gives the
    default; so does a non-numeric year (the reference would raise).
    """
    t = _strip(title)
    year = F.substring(t, -5, 4).try_cast("int")
    return F.when(t.isNull() | (F.length(t) < 6), F.lit(default)).otherwise(F.coalesce(year, F.lit(default)))


def clean_title(title: Column | str) -> Column:
    """Trim, drop the trailing ``(YYYY)`` (last six characters), trim again."""
    t = _strip(title)
    return _strip(F.substr(t, F.lit(1), F.greatest(F.length(t) - 6, F.lit(0))))


def split_part(types: Column | str, index: int, sep: str = TYPE_SEPARATOR) -> Column:
    """Element ``index`` (0-based) of the separated list; null past the end."""
    return F.get(F.split(_c(types), re.escape(sep)), index)


def fmt2(c: Column | str, decimals: int = NUMBER_PRECISION) -> Column:
    """Fixed decimals with thousands separators, as text (``1,234.50``)."""
    return F.format_number(_c(c), decimals)
