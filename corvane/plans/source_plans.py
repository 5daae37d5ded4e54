"""Scan, parser and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import labels
from corvane.operators import custom
from corvane.plans.registry import load, plan
from corvane.plans.text_plans import LINES_SQL, POSTS_SQL, doc_lines, post_counts
from corvane.plans.vector_plans import double_points, points, round6, rounded
from corvane.session import scratch_path
from corvane.sources import binary_points, text_io

FLAT_SQL = (
    f"SELECT vec_id AS id, pos, {rounded('v')} AS v FROM (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS v, "
    "CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos FROM embeddings)"
)
BUCKET = "https://bucket.example.com/images/"


def _flat(table):
    rows = table.select("id", F.posexplode("x").alias("pos", "v"))
    return rows.select("id", "pos", round6(F.col("v")).alias("v"))


@plan(
    "union_inputs",
    f"WITH {LINES_SQL} SELECT 'documents' AS origin, doc_id AS id, line_no, line FROM doc_lines UNION ALL "
    "SELECT 'conversations', conv_id, turn, text FROM conversations UNION ALL "
    "SELECT 'benchmark', item_id, CAST(1 AS BIGINT), text FROM benchmark",
)
def union_inputs(spark, folder):
    docs = doc_lines(spark, folder).select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "line_no", "line")
    turns = load(spark, folder, "conversations").select(
        F.lit("conversations").alias("origin"), F.col("conv_id").alias("id"),
        F.col("turn").alias("line_no"), F.col("text").alias("line"),
    )
    items = load(spark, folder, "benchmark").select(
        F.lit("benchmark").alias("origin"), F.col("item_id").alias("id"),
        F.lit(1).cast("bigint").alias("line_no"), F.col("text").alias("line"),
    )
    return docs.unionByName(turns).unionByName(items)


@plan("parse_csv_vectors", FLAT_SQL)
def parse_csv_vectors(spark, folder):
    """Vectors written as comma-separated text and parsed again."""
    lines = double_points(spark, folder).select("id", F.concat_ws(",", F.col("x").cast("array<string>")).alias("line"))
    return _flat(lines.select("id", text_io.csv_vector(F.col("line")).alias("x")))


@plan("parse_tsv_vectors", FLAT_SQL)
def parse_tsv_vectors(spark, folder):
    shown = F.concat(F.lit("["), F.concat_ws(", ", F.col("x").cast("array<string>")), F.lit("]"))
    lines = double_points(spark, folder).select(
        F.concat_ws("\t", F.col("id").cast("string"), F.lit("url"), shown).alias("line")
    )
    parsed = lines.select(
        text_io.tsv_field(F.col("line"), 0).cast("bigint").alias("id"),
        text_io.bracketed_vector(text_io.tsv_field(F.col("line"), 2)).alias("x"),
    )
    return _flat(parsed)


@plan("parse_ascii_points", FLAT_SQL)
def parse_ascii_points(spark, folder):
    """Points as a text file with mixed separators and blank lines, scanned again."""
    path = scratch_path(spark, "points")
    coords = F.col("x").cast("array<string>")
    line = F.concat(F.col("id").cast("string"), F.lit("\t"), F.concat_ws(", ", coords), F.lit("\n"))
    double_points(spark, folder).select(line.alias("value")).write.text(path)
    parsed = text_io.read_points(spark, path)
    return _flat(parsed.withColumn("id", F.col("id").cast("bigint")))


@plan("binary_points_roundtrip", FLAT_SQL)
def binary_points_roundtrip(spark, folder):
    """Vectors through raw binary files; row numbers follow the ids."""
    path = scratch_path(spark, "points")
    binary_points.write_binary_points(points(spark, folder), path)
    back = binary_points.read_binary_points(spark, path)
    return _flat(back.select("id", F.col("x").cast("array<double>").alias("x")))


@plan("sink_roundtrip", f"WITH {POSTS_SQL} SELECT word, tag, cnt FROM counts")
def sink_roundtrip(spark, folder):
    """Counts through tab-separated text, written twice: the second run replaces the first."""
    path = scratch_path(spark, "pairs")
    table = post_counts(spark, folder).select("word", "tag", "cnt")
    text_io.write_pairs(table, path)
    text_io.write_pairs(text_io.read_pairs(spark, path, "word string, tag string, cnt bigint"), path + "-copy")
    return text_io.read_pairs(spark, path + "-copy", "word string, tag string, cnt bigint")


@plan(
    "hidden_filter",
    "SELECT name FROM (SELECT CASE WHEN quality = 0 THEN '.' ELSE '' END || 'doc-' || doc_id AS name FROM labels) "
    "WHERE NOT starts_with(name, '.')",
)
def hidden_filter(spark, folder):
    dot = F.when(F.col("quality") == 0, F.lit(".")).otherwise(F.lit(""))
    names = load(spark, folder, "labels").select(F.concat(dot, F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"))
    return names.filter(~labels.is_hidden(F.col("name")))


@plan(
    "prefix_paths",
    f"SELECT page_id, '{BUCKET}' || 'page-' || page_id || '.jpg' AS url FROM pages",
)
def prefix_paths(spark, folder):
    name = F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".jpg"))
    return load(spark, folder, "pages").select("page_id", text_io.prefixed(BUCKET, name).alias("url"))


@plan(
    "custom_map",
    "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes, CAST(crc32 AS BIGINT) AS sum FROM (SELECT doc_id, text, "
    "list_reduce(list_prepend(CAST(1 AS BIGINT), list_transform(range(1, length(text) + 1), "
    "lambda i: CAST(unicode(text[i]) AS BIGINT))), lambda a, c: (a * 31 + c) % 65521) AS crc32 FROM documents)",
)
def custom_map(spark, folder):
    """A user's mapper: the byte length and a rolling checksum of each text, which no built-in function gives."""

    def rolled(text: str) -> int:
        value = 1
        for c in text:
            value = (value * 31 + ord(c)) % 65521
        return value

    def sums(batch):
        return batch[["doc_id"]].assign(bytes=batch["text"].map(lambda t: len(t.encode())), sum=batch["text"].map(rolled))

    docs = load(spark, folder, "documents").select("doc_id", "text")
    return custom.map_rows(docs, sums, "doc_id bigint, bytes bigint, sum bigint")
