"""Text scans, vector parsers and text sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT_SEPARATORS = r"[ ,\t\n]+"


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``(line)`` of one or several files or folders, local or remote."""
    return spark.read.text(list(paths)).withColumnRenamed("value", "line")


def csv_vector(line: Column) -> Column:
    """``1.0,2.5`` -> array<double>."""
    return F.split(line, ",", -1).cast("array<double>")


def tsv_field(line: Column, at: int) -> Column:
    return F.split(line, "\t", -1).getItem(at)


def bracketed_vector(field: Column) -> Column:
    """``[1.0, 2.5]`` -> array<double>: first and last character go."""
    inner = F.substring(field, F.lit(2), F.length(field) - 2)
    return F.transform(F.split(inner, ",", -1), lambda v: F.trim(v)).cast("array<double>")


def point_tokens(line: Column) -> Column:
    return F.filter(F.split(line, POINT_SEPARATORS, -1), lambda t: t != "")


def parse_points(lines: DataFrame, line: str = "line") -> DataFrame:
    """``(id, x)`` from ``id c0 c1 ...`` lines split at blanks, commas or tabs; blank lines go."""
    tokens = lines.select(point_tokens(F.col(line)).alias("t")).filter(F.size("t") > 0)
    coords = F.slice("t", F.lit(2), F.greatest(F.size("t") - 1, F.lit(0)))
    return tokens.select(F.col("t").getItem(0).alias("id"), coords.cast("array<double>").alias("x"))


def read_points(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_points(read_lines(spark, *paths))


def centre_text(cid: Column, m: Column) -> Column:
    """``cid c0 c1 ...`` with six decimals."""
    return F.concat_ws(
        " ", cid.cast("string"), F.transform(m, lambda v: F.format_string("%.6f", v))
    )


def membership_text(id_: Column, cid: Column) -> Column:
    return F.concat_ws(" ", id_.cast("string"), cid.cast("string"))


def write_centres(centres: DataFrame, path: str) -> None:
    """One text line per centre, in order of ``cid``."""
    ordered = centres.orderBy("cid").select(centre_text(F.col("cid"), F.col("m")).alias("value"))
    ordered.write.mode("overwrite").text(path)


def write_membership(membership: DataFrame, path: str) -> None:
    """One ``id cid`` line per point."""
    membership.select("id", "cid").write.mode("overwrite").option("sep", " ").csv(path)


def write_pairs(df: DataFrame, path: str) -> None:
    """Plain ``key<TAB>value`` lines of all columns, unquoted; replaces what is there."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws("\t", *shown).alias("value")).write.mode("overwrite").text(path)


def read_pairs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated lines as the columns of a DDL ``schema``."""
    fields = T.StructType.fromDDL(schema).fields
    parts = spark.read.text(path).select(F.split("value", "\t", -1).alias("p"))
    return parts.select(*[F.col("p")[at].cast(f.dataType).alias(f.name) for at, f in enumerate(fields)])


def prefixed(prefix: str, name: Column) -> Column:
    return F.concat(F.lit(prefix), name)
