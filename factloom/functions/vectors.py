"""Vectors as ``array<float>`` columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; NULL for a zero or NULL vector."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def cosine_to(a: Column, b: Sequence[float]) -> Column:
    """``cosine`` to one given vector, whose norm is computed only once."""
    values = [float(x) for x in b]
    norm = math.sqrt(sum(x * x for x in values))
    return F.try_divide(dot(a, F.lit(values)), F.sqrt(dot(a, a)) * F.lit(norm))


def check_dim(vector: Column, dim: int) -> Column:
    """The vector as ``array<float>``; fails the job if it has another length."""
    complaint = F.concat(
        F.lit(f"vector must have {dim} elements, has "), F.size(vector).cast("string")
    )
    right = vector.isNull() | (F.size(vector) == dim)
    return F.when(right, vector.cast("array<float>")).otherwise(F.raise_error(complaint))


def to_vector(text: Column, dim: int | None = None) -> Column:
    """Parse JSON text such as ``[0.5, 1]``."""
    vector = F.from_json(text, "array<float>")
    return vector if dim is None else check_dim(vector, dim)


def to_json_text(vector: Column) -> Column:
    return F.to_json(vector)
