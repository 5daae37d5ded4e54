"""Sparse count vectors as text (``w1:c1;w2:c2``) and as maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_entries(entries: Column) -> Column:
    """``array<struct<feature,cnt>>`` -> text, sorted by feature."""
    return F.concat_ws(
        ";",
        F.transform(
            F.array_sort(entries),
            lambda e: F.concat_ws(":", e["feature"], e["cnt"].cast("string")),
        ),
    )


def decode_vector(text: Column) -> Column:
    """Text -> ``map<string,bigint>``; a closing ';' is allowed. The last ':' of an entry ends its feature."""
    items = F.filter(F.split(text, ";", -1), lambda s: s != "")
    return F.map_from_entries(
        F.transform(
            items,
            lambda s: F.struct(
                F.regexp_replace(s, ":[^:]*$", ""),
                F.substring_index(s, ":", -1).cast("bigint"),
            ),
        )
    )


def map_dot(left: Column, right: Column) -> Column:
    """Sum of products over the keys both maps have."""
    shared = F.array_intersect(F.map_keys(left), F.map_keys(right))
    return F.aggregate(
        shared,
        F.lit(0).cast("bigint"),
        lambda acc, k: acc + F.element_at(left, k) * F.element_at(right, k),
    )
