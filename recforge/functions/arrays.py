"""Array expressions built from Spark's higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_n(arr: Column, n: int, prefix: str) -> list[Column]:
    """``prefix1 .. prefixN`` from the first n elements; null past the end."""
    return [F.get(arr, i).alias(f"{prefix}{i + 1}") for i in range(n)]


def rank_by_frequency(words: Column) -> Column:
    """Distinct words ordered by count descending, ties by first appearance.

    ``words`` must be a plain column reference (computed once per row).  A
    word's count is ``size(words) - size(array_remove(words, word))``: one
    native scan per distinct word, no lambda per element.
    """
    distinct = F.array_distinct(words)  # keeps first-appearance order
    n = F.size(words)
    keyed = F.transform(
        distinct,
        lambda w, i: F.struct(
            (F.size(F.array_remove(words, w)) - n).alias("n"),
            i.alias("pos"),
            w.alias("w"),
        ),
    )
    return F.transform(F.sort_array(keyed), lambda s: s["w"])  # no lambda per comparison; positions differ


def sort_by_keys(structs: Column, value_field: str) -> Column:
    """Sort an array of structs by their fields in order, keep one field."""
    return F.transform(F.array_sort(structs), lambda s: s[value_field])
