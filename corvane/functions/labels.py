"""Labels and class names derived from file names and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Label of a two-letter file name prefix.
PREFIX_LABELS = {"al": 1, "as": 2, "ch": 3, "he": 4, "ra": 5}

# Class names by 1-based class id.
BUILDING_CLASSES = ["all_souls", "ashmolean", "christ_church", "hertford", "radcliffe_camera", "distractor"]
OBJECT_CLASSES = [
    "airplane", "automobile", "bird", "cat", "deer", "dog", "frog", "horse", "ship", "truck",
]


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def label_from_prefix(path: Column, labels: dict[str, int] | None = None) -> Column:
    """Label of the first two letters of the base name, null when unknown."""
    head = F.substring(base_name(path), 1, 2)
    out = F.lit(None).cast("int")
    for prefix, label in (labels or PREFIX_LABELS).items():
        out = F.when(head == prefix, F.lit(label)).otherwise(out)
    return out


def label_from_suffix(name: Column) -> Column:
    """The digit after '|' in ``name|d.jpg``."""
    return F.substring(F.split(name, r"\|").getItem(1), 1, 1).cast("int")


def is_hidden(name: Column) -> Column:
    return F.startswith(name, F.lit("."))


def class_table(spark: SparkSession, names: list[str]) -> DataFrame:
    """``(label, name)`` with 1-based labels."""
    return spark.createDataFrame(list(enumerate(names, 1)), "label int, name string")


def class_name(label: Column, names: list[str]) -> Column:
    """Name of a 1-based class id, null outside the list."""
    return F.try_element_at(F.array(*map(F.lit, names)), label)
