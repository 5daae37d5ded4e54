"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import (
    collocations,
    fill_in_middle,
    language_id,
    minhash,
    mixing,
    oracles,
    packing,
    quality_ranking,
    quality_rules,
    simhash,
    token_files,
    token_rollup,
    two_fit,
    url_filter,
)
from corvane.llm.common import load, stored, word_count
from corvane.llm.encoder import tokenizer_path
from corvane.session import scratch_path

Builder = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; two thirds of the ids may be learned from."""
    docs = load(spark, folder, "documents").withColumn("held_out", fold(3) == 1)
    model = language_id.fit(docs.filter(~F.col("held_out")))
    return language_id.predicted(docs, model).select("doc_id", "held_out", "lang_pred", "score")


def fold(n: int) -> Column:
    """CRC-32 of the id as text, modulo ``n``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(load(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op3_quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document; four fifths of the ids may be learned from."""
    docs = load(spark, folder, "documents").withColumn("held_out", fold(5) == 0)
    ranker = quality_ranking.fit(docs.filter(~F.col("held_out")), load(spark, folder, "labels").filter(fold(5) != 0))
    return quality_ranking.scored(docs, ranker).select("doc_id", "held_out", "score", "predicted")


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents encoded, written with Elias-Fano boundaries and read back."""
    path = scratch_path(spark, "token-files")
    token_files.write(load(spark, folder, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return token_files.digests(spark, path)


def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and its edited text, with their likenesses."""
    found = minhash.compared(load(spark, folder, "documents"))
    prints = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(prints)


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page URL, by rule or by the host and path classifier."""
    return url_filter.judged(load(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures and the verdict of the line rule for every document."""
    found = quality_rules.judged(quality_rules.measured(load(spark, folder, "documents")))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words",
        "base_failed", "kept",
    )


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 ids."""
    pieces = packing.pack(load(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)
    return pieces.select(
        "doc_id", "start", "length", packing.crc32(F.col("ids"), F.col("width")).alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of 150% of all words takes from every document."""
    mixed = mixing.mix(load(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", mixing.taken().alias("taken"))


#: Words and single marks, and words with a letter or digit: the counts that op10 revises.
WORDS_AND_MARKS = r"[^\x20\x09-\x0D.,!?;:]+|[.,!?;:]"
SPOKEN_WORDS = r"[^\x20\x09-\x0D]*[A-Za-z0-9][^\x20\x09-\x0D]*"


def op10_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after a load, deletes of toxic documents, a new tokenizer for all but English, and revised English counts."""
    count = lambda pattern: F.coalesce(F.regexp_count("text", F.lit(pattern)), F.lit(0)).cast("bigint")
    counts = stored(load(spark, folder, "documents").select(
        "doc_id", "source", "lang", word_count(F.col("text")).alias("words"), count(WORDS_AND_MARKS).alias("marked"),
        count(SPOKEN_WORDS).alias("spoken"),
    ), "rollup-counts")
    toxic = load(spark, folder, "labels").filter("toxic = 1").select("doc_id")
    under = lambda df, tokenizer, n: df.withColumns({"tokenizer": F.lit(tokenizer), "n_tokens": F.col(n)})
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    left = counts.join(toxic, "doc_id", "left_anti")
    revised = under(left.filter(english), "words-1", "spoken").withColumn("old_tokens", F.col("words"))
    moved = left.filter(~english)
    batches = [
        ("load", token_rollup.inserts(under(counts, "words-1", "words"))),
        ("toxic", token_rollup.deletes(under(counts.join(toxic, "doc_id", "left_semi"), "words-1", "words"))),
        ("recount", token_rollup.changes(under(moved, "words-1", "words"), under(moved, "words-2", "marked"))),
        ("revise", token_rollup.revisions(revised)),
    ]
    store = scratch_path(spark, "rollup")
    # A batch that is sent again changes nothing.
    for batch, signed in [*batches, batches[1]]:
        token_rollup.commit(store, batch, signed)
    return token_rollup.totals(spark, store)


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best phrases of every language."""
    return collocations.collocations(load(spark, folder, "documents"))


def op12_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids; only longer documents are cut."""
    pieces = two_fit.pack(load(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=0)
    return pieces.select(
        "doc_id", "piece", "start", "length", packing.crc32(F.col("ids"), F.col("width")).alias("ids_crc32"),
        "sequence_id", "offset",
    )


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Form, cuts and digests of every document rearranged for filling in the middle."""
    return fill_in_middle.digests(load(spark, folder, "documents"))


def queries() -> dict[str, Builder]:
    return {
        "op1_language_id": op1_language_id,
        "op2_simhash": op2_simhash,
        "op3_quality_ranking": op3_quality_ranking,
        "op4_token_files": op4_token_files,
        "op5_minhash": op5_minhash,
        "op6_url_filter": op6_url_filter,
        "op7_quality_rules": op7_quality_rules,
        "op8_packing": op8_packing,
        "op9_mixing": op9_mixing,
        "op10_token_rollup": op10_token_rollup,
        "op11_collocations": op11_collocations,
        "op12_two_fit": op12_two_fit,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_quality_rules": oracles.QUALITY_RULES,
        "op9_mixing": oracles.MIXING,
        "op10_token_rollup": oracles.token_rollup(WORDS_AND_MARKS, SPOKEN_WORDS),
        "op11_collocations": oracles.COLLOCATIONS,
        "op13_fill_in_middle": oracles.FILL_IN_MIDDLE,
    }
