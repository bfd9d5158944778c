"""Vector arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signpost.functions.text import _c


def squared_norm(vector) -> Column:
    return F.aggregate(
        _c(vector), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )


def normalize_vector(vector) -> Column:
    """Unit vector in single precision; null for a zero or empty vector."""
    vector = _c(vector)
    norm = F.sqrt(squared_norm(vector))
    # The factor goes in as an array: inside the lambda it would be worked out
    # again for every element.
    factor = F.array_repeat((F.lit(1.0) / F.nullif(norm, F.lit(0.0))).cast("float"), F.size(vector))
    return F.when(norm > 0, F.zip_with(vector, factor, lambda x, f: x * f))


def dot_product(left, right) -> Column:
    """Dot product in double precision; 0 for different lengths."""
    left, right = _c(left), _c(right)
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.when(
        F.size(left) == F.size(right),
        F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x),
    ).otherwise(F.lit(0.0))


def clamp_score(cosine) -> Column:
    """A cosine as a score between 0 and 1; null stays null."""
    value = _c(cosine)
    # greatest and least alone would skip a null.
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def distance_to_score(distance) -> Column:
    return clamp_score(F.lit(1.0) - _c(distance))
