"""Token counts by source, language and tokenizer version, maintained by signed deltas.

A store is a folder with ``deltas/batch=<id>`` (additive sums of one batch) and
``log`` (ids of committed batches). A batch is any set of signed rows: inserts
are +1 document and +n tokens, deletes -1 and -n, a revised count is the
difference. Sums are additive, so totals are one aggregate over the deltas of
logged batches.

Commit: write the batch's deltas to its own folder (overwriting what an earlier
attempt left), then append its id to the log. A batch that is in the log is
skipped, so a commit may be repeated at any point of failure. Null sources and
languages are groups of their own; a null count is 0 tokens. Groups whose
documents and tokens have both come back to 0 leave the totals.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
_DELTA = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
_LOG = "batch string"


def inserts(counts: DataFrame) -> DataFrame:
    """Signed rows that add ``source, lang, tokenizer, n_tokens`` documents."""
    return _signed(counts, 1)


def deletes(counts: DataFrame) -> DataFrame:
    """Signed rows that take documents away again."""
    return _signed(counts, -1)


def revisions(counts: DataFrame) -> DataFrame:
    """Signed rows for ``old_tokens`` becoming ``n_tokens`` in the same group."""
    return counts.select(
        *KEYS, F.lit(0).cast("bigint").alias("docs"),
        (F.coalesce("n_tokens", F.lit(0)) - F.coalesce("old_tokens", F.lit(0))).cast("bigint").alias("tokens"),
    )


def _signed(counts: DataFrame, sign: int) -> DataFrame:
    return counts.select(
        *KEYS, F.lit(sign).cast("bigint").alias("docs"), (sign * F.coalesce("n_tokens", F.lit(0))).cast("bigint").alias("tokens")
    )


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed rows between two states of ``doc_id, source, lang, tokenizer, n_tokens``.

    Deletes all of ``before`` and inserts all of ``after``; what stayed the
    same cancels in the sums of the batch, without a join on documents.
    """
    return inserts(after).union(deletes(before))


def commit(store: str, batch: str, signed: DataFrame) -> bool:
    """Adds a batch; False if it was there already."""
    spark = signed.sparkSession
    if not committed(spark, store).filter(F.col("batch") == batch).isEmpty():
        return False
    sums = signed.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    sums.filter("docs <> 0 or tokens <> 0").write.mode("overwrite").parquet(f"{store}/deltas/batch={batch}")
    spark.createDataFrame([(batch,)], _LOG).coalesce(1).write.mode("append").parquet(f"{store}/log")
    return True


def committed(spark: SparkSession, store: str) -> DataFrame:
    """``batch``: ids in the log, each once."""
    try:
        return spark.read.schema(_LOG).parquet(f"{store}/log").distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG)


def totals(spark: SparkSession, store: str) -> DataFrame:
    """``source, lang, tokenizer, docs, tokens`` over all committed batches."""
    log = committed(spark, store)
    if log.isEmpty():
        return spark.createDataFrame([], _DELTA)
    deltas = spark.read.schema(f"{_DELTA}, batch string").parquet(f"{store}/deltas")
    # A batch left by a failed commit has deltas but no log row.
    live = deltas.join(log, "batch", "left_semi")
    return live.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter(
        "docs <> 0 or tokens <> 0"
    )


def compacted(spark: SparkSession, store: str, into: str, batch: str) -> None:
    """A new store whose single batch holds the totals; its log names the old batches too, so none is added twice."""
    old = committed(spark, store)
    totals(spark, store).write.mode("overwrite").parquet(f"{into}/deltas/batch={batch}")
    old.union(spark.createDataFrame([(batch,)], _LOG)).coalesce(1).write.mode("overwrite").parquet(f"{into}/log")
