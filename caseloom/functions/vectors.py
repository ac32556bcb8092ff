"""Vector math as Column expressions (VEC-1, column form)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dot(left: Column | str, right: Column | str) -> Column:
    """Dot product; on unequal lengths it stops at the shorter vector (SEM-15)."""
    products = F.zip_with(_c(left), _c(right), lambda x, y: F.coalesce(x * y, F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def norm(vec: Column | str) -> Column:
    """Euclidean norm over the full vector."""
    return F.sqrt(F.aggregate(_c(vec), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(left: Column | str, right: Column | str) -> Column:
    """VEC-1: dot / (|l|·|r|); 0.0 when either norm is zero (SEM-2)."""
    denom = norm(left) * norm(right)
    return F.when(denom == 0, F.lit(0.0)).otherwise(dot(left, right) / denom)
