"""Text, n-gram and tag queries over ``documents`` (and ``pages.url`` for URLs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import encoding, text
from corvane.operators import chunks, ngrams, postings, ranking, tags, top_tags
from corvane.plans.registry import load, plan
from corvane.session import frozen, spread

ONE_TAG = "#en"

# ---------------------------------------------------------------- shared SQL

LINES_SQL = r"""doc_lines AS (
  SELECT doc_id, lang, source, unnest(parts) AS line,
         CAST(generate_subscripts(parts, 1) AS BIGINT) AS line_no
  FROM (SELECT doc_id, lang, source,
               CASE WHEN text = '' THEN []
                    ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|[\r\n])\z', ''), '\r\n|[\r\n]')
               END AS parts
        FROM documents))"""

URL_SQL = (
    r"regexp_replace({x}, '\b(https?|ftp|file)://[-a-zA-Z0-9+&@#/%?=~_|!:,.;]*"
    r"[-a-zA-Z0-9+&@#/%=~_|]\b', '', 'g')"
)
STEP_SQL = {
    "lower": "lower({x})",
    "urls": URL_SQL,
    "colons": "regexp_replace({x}, '[:;]', ' ', 'g')",
    "trail_punct": r"regexp_replace({x}, '[[:punct:]](\s+|$)', ' ', 'g')",
    "alone_punct": r"regexp_replace({x}, '(^|\s+)[[:punct:]]+(\s+|$)', ' ', 'g')",
    "lead_punct": r"regexp_replace({x}, '(^|\s+)[<>,./?!$%^&*()_+-=]', ' ', 'g')",
    "ascii": r"regexp_replace({x}, '[^\x00-\x80]+', '', 'g')",
    "digits": r"regexp_replace({x}, '(^|\s+)\d+(\s+|$)', ' ', 'g')",
    "ws": r"regexp_replace(regexp_replace({x}, '\s+', ' ', 'g'), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')",
}


def normalize_sql(x: str) -> str:
    for step in STEP_SQL.values():
        x = step.replace("{x}", x)
    return x


TOKENS_SQL = (
    LINES_SQL
    + """,
tokens AS (
  SELECT doc_id, line_no, regexp_split_to_array("""
    + normalize_sql("line")
    + r""", '\s+') AS w
  FROM doc_lines)"""
)

POSTS_SQL = (
    LINES_SQL
    + """,
posts AS (
  SELECT doc_id, line_no, regexp_split_to_array("""
    + normalize_sql("concat_ws(' ', line, '#' || lang, '#' || source)")
    + r""", '\s+') AS w
  FROM doc_lines),
occurrences AS (
  SELECT unnest(list_filter(w, lambda t: starts_with(t, '#'))) AS tag,
         list_filter(w, lambda t: NOT starts_with(t, '#')) AS words
  FROM posts),
counts AS MATERIALIZED (
  SELECT tag, word, CAST(count(*) AS BIGINT) AS cnt
  FROM (SELECT tag, unnest(words) AS word FROM occurrences)
  GROUP BY tag, word)"""
)

SIMILAR_SQL = (
    POSTS_SQL
    + """,
pair_sums AS (
  SELECT x.tag AS a, y.tag AS b, CAST(sum(x.cnt * y.cnt) AS BIGINT) AS similarity
  FROM counts x JOIN counts y ON x.word = y.word AND x.tag < y.tag
  GROUP BY x.tag, y.tag)"""
)


# ------------------------------------------------------------ shared sources

def doc_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return ngrams.line_table(spread(docs, "doc_id"), ["doc_id", "lang", "source"])


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their language and source appended as tags."""
    tagged = F.concat_ws(" ", "line", F.concat(F.lit("#"), "lang"), F.concat(F.lit("#"), "source"))
    return doc_lines(spark, folder).select("doc_id", "line_no", tagged.alias("line"))


def post_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tags.tag_word_count(posts(spark, folder))


# -------------------------------------------------------------------- lines

@plan("text_lines", f"WITH {LINES_SQL} SELECT doc_id, line_no, line FROM doc_lines")
def text_lines(spark, folder):
    return doc_lines(spark, folder).select("doc_id", "line_no", "line")


@plan(
    "single_field_lines",
    f"WITH {LINES_SQL} SELECT doc_id, line_no, line FROM doc_lines WHERE len(string_split(line, ' ')) = 1",
)
def single_field_lines(spark, folder):
    lines = doc_lines(spark, folder).select("doc_id", "line_no", "line")
    return lines.filter(F.size(F.split("line", " ", -1)) == 1)


# --------------------------------------------------------------- normaliser

STEPS = {
    "lower": text.lower,
    "colons": text.split_colons,
    "trail_punct": text.strip_trailing_punct,
    "alone_punct": text.drop_alone_punct,
    "lead_punct": text.strip_leading_punct,
    "ascii": text.drop_non_ascii,
    "digits": text.drop_digit_tokens,
    "ws": text.squeeze,
}


def _register_step(step: str) -> None:
    sql = STEP_SQL[step].replace("{x}", "line")

    @plan(f"norm_{step}", f"WITH {LINES_SQL} SELECT doc_id, line_no, {sql} AS out FROM doc_lines")
    def build(spark, folder):
        lines = doc_lines(spark, folder)
        return lines.select("doc_id", "line_no", STEPS[step](F.col("line")).alias("out"))


for _step in STEPS:
    _register_step(_step)


@plan(
    "norm_urls",
    "SELECT page_id, "
    + URL_SQL.replace("{x}", "concat('see ', url, ' (or ', url, '). end')")
    + " AS out FROM pages",
)
def norm_urls(spark, folder):
    said = F.concat(F.lit("see "), "url", F.lit(" (or "), "url", F.lit("). end"))
    return load(spark, folder, "pages").select("page_id", text.drop_urls(said).alias("out"))


@plan(
    "normalize_text",
    f"WITH {LINES_SQL} SELECT doc_id, line_no, {normalize_sql('line')} AS out FROM doc_lines",
)
def normalize_text(spark, folder):
    lines = doc_lines(spark, folder)
    return lines.select("doc_id", "line_no", text.normalize(F.col("line")).alias("out"))


@plan(
    "tokenize",
    f"WITH {TOKENS_SQL} SELECT doc_id, line_no, unnest(w) AS token, "
    "CAST(generate_subscripts(w, 1) AS INTEGER) AS token_no FROM tokens",
)
def tokenize(spark, folder):
    tokens = ngrams.token_table(doc_lines(spark, folder))
    return ngrams.token_rows(tokens, ["doc_id", "line_no"])


@plan(
    "extract_hashtags",
    f"WITH {POSTS_SQL} SELECT doc_id, line_no, "
    "unnest(list_filter(w, lambda t: starts_with(t, '#'))) AS tag FROM posts",
)
def extract_hashtags(spark, folder):
    tokens = ngrams.token_table(posts(spark, folder))
    return tokens.select("doc_id", "line_no", F.explode(text.tags_of(F.col("tokens"))).alias("tag"))


@plan(
    "extract_words",
    f"WITH {POSTS_SQL} SELECT doc_id, line_no, "
    "unnest(list_filter(w, lambda t: NOT starts_with(t, '#'))) AS word FROM posts",
)
def extract_words(spark, folder):
    tokens = ngrams.token_table(posts(spark, folder))
    return tokens.select("doc_id", "line_no", F.explode(text.words_of(F.col("tokens"))).alias("word"))


# ------------------------------------------------------------------ n-grams

@plan(
    "ngrams",
    f"WITH {TOKENS_SQL} SELECT doc_id, line_no, CAST(i AS INTEGER) AS start_no, "
    "w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram "
    "FROM (SELECT doc_id, line_no, w, unnest(range(1, len(w) - 1)) AS i FROM tokens)",
)
def ngram_rows(spark, folder):
    tokens = ngrams.token_table(doc_lines(spark, folder))
    grams = F.posexplode(text.ngrams(F.col("tokens"), 3)).alias("at", "gram")
    return tokens.select("doc_id", "line_no", grams).select(
        "doc_id", "line_no", (F.col("at") + 1).alias("start_no"), "gram"
    )


def _register_ngram_count(n: int) -> None:
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(n))
    sql = (
        f"WITH {TOKENS_SQL} SELECT gram, CAST(count(*) AS BIGINT) AS cnt FROM "
        f"(SELECT {gram} AS gram FROM (SELECT w, unnest(range(1, len(w) - {n - 2})) AS i FROM tokens)) "
        "GROUP BY gram"
    )

    @plan(f"ngram_count_{n}", sql)
    def build(spark, folder):
        return ngrams.ngram_count(doc_lines(spark, folder), n)


for _n in (1, 2, 3):
    _register_ngram_count(_n)


# --------------------------------------------------------------------- tags

@plan("tag_word_count", f"WITH {POSTS_SQL} SELECT tag, word, cnt FROM counts")
def tag_word_count(spark, folder):
    return post_counts(spark, folder)


def _segments_sql(key: str, feature: str) -> str:
    return f""",
vectors AS (
  SELECT {key}, CAST(('0x' || substr(md5({feature}), 1, 8)) AS BIGINT) % {tags.SEGMENTS} AS segment,
         string_agg({feature} || ':' || cnt, ';' ORDER BY {feature}) AS vector
  FROM counts
  GROUP BY 1, 2)"""


@plan(
    "word_tag_vectors",
    f"WITH {POSTS_SQL}{_segments_sql('word', 'tag')} SELECT word, segment, vector FROM vectors",
)
def word_tag_vectors(spark, folder):
    return tags.encode_vectors(post_counts(spark, folder), "word", "tag")


TAG_VECTORS_SQL = f"WITH {POSTS_SQL}{_segments_sql('tag', 'word')} SELECT tag, segment, vector FROM vectors"


@plan("tag_word_vectors", TAG_VECTORS_SQL)
def tag_word_vectors(spark, folder):
    return tags.encode_vectors(post_counts(spark, folder), "tag", "word")


@plan(
    "encode_vector",
    f"WITH {TOKENS_SQL}, per_line AS (SELECT doc_id, line_no, word, count(*) AS cnt FROM "
    "(SELECT doc_id, line_no, unnest(w) AS word FROM tokens) GROUP BY doc_id, line_no, word) "
    "SELECT doc_id, line_no, string_agg(word || ':' || cnt, ';' ORDER BY word) AS vector "
    "FROM per_line GROUP BY doc_id, line_no",
)
def encode_vector(spark, folder):
    """The word counts of each line as vector text."""
    tokens = ngrams.token_table(doc_lines(spark, folder))
    words = ngrams.token_rows(tokens, ["doc_id", "line_no"])
    counted = words.groupBy("doc_id", "line_no", F.col("token").alias("feature")).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    # One line bounds what is gathered here.
    entries = F.collect_list(F.struct("feature", "cnt"))
    return counted.groupBy("doc_id", "line_no").agg(encoding.encode_entries(entries).alias("vector"))


@plan("decode_vector", f"WITH {POSTS_SQL} SELECT word, tag, cnt FROM counts")
def decode_vector(spark, folder):
    encoded = tags.encode_vectors(post_counts(spark, folder), "word", "tag")
    return tags.decode_vectors(encoded, "word", "tag")


@plan(
    "sparse_dot",
    f"WITH {TOKENS_SQL}, doc_words AS (SELECT doc_id, word, count(*) AS cnt FROM "
    "(SELECT doc_id, unnest(w) AS word FROM tokens) GROUP BY doc_id, word), "
    "bench_words AS (SELECT word, count(*) AS cnt FROM (SELECT unnest(regexp_split_to_array("
    + normalize_sql("text")
    + r", '\s+')) AS word FROM benchmark) GROUP BY word) "
    "SELECT doc_id, CAST(sum(d.cnt * b.cnt) AS BIGINT) AS dot "
    "FROM doc_words d JOIN bench_words b USING (word) GROUP BY doc_id",
)
def sparse_dot(spark, folder):
    """Dot product of each document's word counts with those of ``benchmark``."""
    tokens = ngrams.token_table(doc_lines(spark, folder))
    doc_words = ngrams.token_rows(tokens, ["doc_id"]).withColumnRenamed("token", "word")
    doc_words = doc_words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("cnt"))
    items = load(spark, folder, "benchmark").select(F.col("text").alias("line"))
    other = ngrams.ngram_count(items, 1).select(F.col("gram").alias("word"), F.col("cnt").alias("other"))
    met = chunks.salted_lookup(doc_words, other, "word", "doc_id", "inner")
    return met.groupBy("doc_id").agg(F.sum(F.col("cnt") * F.col("other")).alias("dot"))


@plan("one_tag_vector", f"WITH {POSTS_SQL} SELECT word, cnt FROM counts WHERE tag = '{ONE_TAG}'")
def one_tag_vector(spark, folder):
    return tags.tag_word_count(posts(spark, folder), ONE_TAG).select("word", "cnt")


@plan(
    "tag_similarity_to",
    f"WITH {POSTS_SQL} SELECT x.tag, CAST(sum(x.cnt * y.cnt) AS BIGINT) AS similarity "
    f"FROM counts x JOIN counts y ON x.word = y.word AND y.tag = '{ONE_TAG}' GROUP BY x.tag",
)
def tag_similarity_to(spark, folder):
    return tags.tag_similarity_to(post_counts(spark, folder), ONE_TAG)


@plan(
    "tag_pair_products",
    f"WITH {POSTS_SQL} SELECT x.word, x.tag AS a, y.tag AS b, x.cnt * y.cnt AS product "
    "FROM counts x JOIN counts y ON x.word = y.word AND x.tag < y.tag",
)
def tag_pair_products(spark, folder):
    return tags.tag_pair_products(post_counts(spark, folder))


@plan("tag_similarity", f"WITH {SIMILAR_SQL} SELECT a, b, similarity FROM pair_sums")
def tag_similarity(spark, folder):
    return tags.tag_similarity(post_counts(spark, folder))


@plan(
    "similarity_ranked",
    f"WITH {SIMILAR_SQL} SELECT a, b, similarity, "
    "row_number() OVER (ORDER BY similarity, a, b) AS rank FROM pair_sums",
)
def similarity_ranked(spark, folder):
    similar = tags.tag_similarity(post_counts(spark, folder))
    return ranking.global_rank(similar, [F.col("similarity"), F.col("a"), F.col("b")])


#: Partners reported for each tag.
NEAREST_TAGS = 3


@plan(
    "similar_tags_top",
    f"WITH {SIMILAR_SQL}, both_ways AS (SELECT a AS tag, b AS other, similarity FROM pair_sums UNION ALL "
    "SELECT b, a, similarity FROM pair_sums) "
    "SELECT tag, CAST(rank AS INTEGER) AS rank, other, similarity FROM (SELECT *, "
    "row_number() OVER (PARTITION BY tag ORDER BY similarity DESC, other) AS rank FROM both_ways) "
    f"WHERE rank <= {NEAREST_TAGS}",
)
def similar_tags_top(spark, folder):
    return top_tags.most_similar(post_counts(spark, folder), NEAREST_TAGS)


@plan("postings_roundtrip", f"WITH {POSTS_SQL} SELECT tag, word, cnt FROM counts")
def postings_roundtrip(spark, folder):
    """Tag vectors as compressed postings and back."""
    counts = frozen(post_counts(spark, folder))
    numbered = frozen(postings.numbers(counts, "word"))
    return postings.decode(postings.encode(counts, numbered, "tag", "word"), numbered, "tag", "word")
