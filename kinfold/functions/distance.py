"""Distances between two vector columns, in double precision. Lower is more similar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = ("l2", "cosine", "ip")


def vector_literal(values: Sequence[float]) -> Column:
    return F.lit([float(v) for v in values]).cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def squared_l2(a: Column, b: Column) -> Column:
    def square(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.aggregate(F.zip_with(a, b, square), F.lit(0.0), lambda acc, x: acc + x)


def inner_product(a: Column, b: Column) -> Column:
    """1 - dot product."""
    return F.lit(1.0) - dot(a, b)


def cosine(a: Column, b: Column) -> Column:
    """1 - cosine similarity; 1.0 if either vector is zero."""
    norms = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norms == 0.0, F.lit(1.0)).otherwise(F.lit(1.0) - dot(a, b) / norms)


def distance(a: Column, b: Column, space: str = "l2") -> Column:
    by_space = {"l2": squared_l2, "cosine": cosine, "ip": inner_product}
    if space not in by_space:
        raise ValueError(f"space must be one of {SPACES}, not {space!r}")
    return by_space[space](a, b)


def l2_normalise(v: Column) -> Column:
    """The vector scaled to unit length; a zero vector stays as it is."""
    # The one-element transform names the length, so that it is computed once per row.
    length = F.sqrt(dot(v, v))
    scaled = F.transform(
        F.array(length),
        lambda n: F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double"))),
    )
    return F.get(scaled, F.lit(0))
