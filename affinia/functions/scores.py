"""Arithmetic of scores, weights and losses, and vector functions on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def inverse_distance(i: Column, j: Column) -> Column:
    return F.lit(1.0) / F.abs(i - j)


def dice(joint: Column, left: Column, right: Column, factor: float = 2.0) -> Column:
    return F.lit(factor) * joint / (left + right)


def idf(total: Column, doc_frequency: Column) -> Column:
    return F.greatest(F.lit(0.0), F.log1p(total) - F.log1p(doc_frequency) + 1)


def sqrt_target(score: Column) -> Column:
    return F.sqrt(score)


def log_count(count: Column) -> Column:
    return F.log10(count + 1)


def glove_weight(count: Column) -> Column:
    return F.pow(F.least(F.lit(1.0), count / 100.0), F.lit(0.75))


def hinge(x: Column) -> Column:
    return F.greatest(F.lit(0.0), x)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    norms = l2(a) * l2(b)
    return F.when(norms > 0, dot(a, b) / norms)


def correlation_distance(p: Column) -> Column:
    """1 - P; all of a metric but the triangle inequality."""
    return F.lit(1.0) - p


def angular(p: Column) -> Column:
    """sqrt(1 - P^2), the metric form."""
    return F.sqrt(F.greatest(F.lit(0.0), 1 - p * p))


def similarity_from_distance(d: Column) -> Column:
    return F.lit(1.0) - d
