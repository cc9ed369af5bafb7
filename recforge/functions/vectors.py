"""Vector arithmetic on array<float|double> columns (no VectorUDT needed)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def sq_euclidean(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Null if one of the vectors is zero, for it has no direction."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def fm_pairwise(fields: list[Column]) -> Column:
    """Per dimension ``(sum of x)^2 - sum of x^2`` over equally long field
    vectors: the factorization-machine interaction term (without the 1/2)."""
    sums = fields[0]
    squares = F.transform(fields[0], lambda x: x.cast("double") * x.cast("double"))
    for f in fields[1:]:
        sums = F.zip_with(sums, f, lambda x, y: x.cast("double") + y.cast("double"))
        squares = F.zip_with(squares, f, lambda s, y: s + y.cast("double") * y.cast("double"))
    return F.zip_with(sums, squares, lambda s, q: s.cast("double") * s.cast("double") - q)

