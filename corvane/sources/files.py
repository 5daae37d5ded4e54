"""File inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, folder: str, pattern: str = ".*", recursive: bool = False) -> DataFrame:
    """``(path, name, length)`` of the files whose full path matches ``pattern`` whole."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    # The content column is never selected, so no file is read.
    files = listed.load(folder).select("path", "length")
    inside = F.regexp_replace("path", r"^[a-z0-9]+:/*(?=/)", "")
    return files.filter(inside.rlike(f"^(?:{pattern})$")).select(
        inside.alias("path"), F.substring_index("path", "/", -1).alias("name"), "length"
    )


def total_size(inventory: DataFrame) -> DataFrame:
    """``(files, bytes)``: the sum of the file lengths."""
    return inventory.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def child_folders(inventory: DataFrame, folder: str) -> DataFrame:
    """``(folder)``: direct subfolders that hold a file, from a recursive inventory."""
    inner = F.substring_index("path", f"{folder.rstrip('/')}/", -1)
    below = inventory.filter(F.contains("path", F.lit(f"{folder.rstrip('/')}/")) & F.contains(inner, F.lit("/")))
    return below.select(F.substring_index(inner, "/", 1).alias("folder")).distinct()
