"""Dense vector arithmetic on ``array<double>`` columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, not once per array element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def doubles(x: Column) -> Column:
    return x.cast("array<double>")


def sq_distance(x: Column, m: Column) -> Column:
    """Squared Euclidean distance."""
    parts = F.zip_with(x, m, lambda u, v: (u - v) * (u - v))
    return F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)


def distance(x: Column, m: Column) -> Column:
    return F.sqrt(sq_distance(x, m))


def l2_norm(x: Column) -> Column:
    return F.sqrt(F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v))


def l2_normalize(x: Column) -> Column:
    """x / |x|; a zero vector has no direction and gives nulls."""
    norm = F.nullif(l2_norm(x), F.lit(0.0))
    return bound(norm, lambda n: F.transform(x, lambda v: v / n))


def vector_table_literal(centres: np.ndarray) -> Column:
    """A small k x d table as one folded ``array<array<double>>`` literal."""
    rows = ("array(" + ",".join(f"double('{v!r}')" for v in row) + ")" for row in centres.tolist())
    return F.expr("array(" + ",".join(rows) + ")")


def nearest_center(x: Column, centres: Column) -> Column:
    """``struct<d2,cid>`` of the nearest centre; the lowest index wins a tie."""
    scored = F.transform(
        centres, lambda m, i: F.struct(sq_distance(x, m).alias("d2"), i.cast("int").alias("cid"))
    )
    return F.array_min(scored)


def exponentials(x: Column) -> Column:
    """Log-probabilities to probabilities."""
    return F.transform(x, F.exp)


def softmax(x: Column) -> Column:
    powers = bound(F.array_max(x), lambda top: exponentials(F.transform(x, lambda v: v - top)))
    return bound(powers, _shares)


def _shares(x: Column) -> Column:
    total = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)
    return bound(total, lambda t: F.transform(x, lambda v: v / t))


def top_class(scores: Column) -> Column:
    """``struct<score,cls>`` of the best class, 0-based; the lowest class wins a tie."""
    best = F.array_max(F.transform(scores, lambda p, i: F.struct(p.alias("score"), (-i).alias("back"))))
    return F.struct(best["score"].alias("score"), (-best["back"]).cast("int").alias("cls"))


def class_ranking(scores: Column) -> Column:
    """All classes of one item, best first, as ``array<struct<score,cls>>``."""
    keyed = F.transform(scores, lambda p, i: F.struct((-p).alias("back"), i.cast("int").alias("cls")))
    return F.transform(
        F.array_sort(keyed), lambda s: F.struct((-s["back"]).alias("score"), s["cls"].alias("cls"))
    )
