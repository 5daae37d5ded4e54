"""URL filter: rules by host and path first, then naive Bayes over segmented names.

Host names run words together. A unigram Viterbi pass splits every run of
letters into the most probable words; word probabilities come from counts over
the words of all pages. Multinomial naive Bayes then scores the tokens of host
and path, each marked with where it stands. It is trained on the URLs that a
rule has judged, with counts over all of them.

Words, tokens and their counts are tables of any size and stay on Spark. A run
of letters meets the words that occur in it by a join on its substrings of up to
``PART`` letters; longer words are found by their first ``PART`` letters and then
compared in full. What comes to the driver are a few totals.

Null URLs and URLs without ``://`` have an empty host and path; no rule fits
an empty host. Digits become one token, so that ids do not fill the vocabulary.
Where the training data has one verdict only, or none, that verdict (or
``allow``) is given to all. Equal URLs get equal verdicts; page ids are not
read. A run of n letters makes about ``PART`` x n rows, so a very long path
costs in proportion to its length; a long page is held once in a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import stored
from corvane.operators.chunks import SALTS, salted_lookup

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
#: (rule, verdict): the part before the first slash is the host, the rest the start of the path.
RULES = [
    ("org/", ALLOW), ("example.org/es/", BLOCK), ("example.org/en/1", BLOCK), ("com/fr/", ALLOW), ("com/de/", BLOCK),
]
#: Letters up to which words are looked up as substrings.
PART = 20
#: Costs of letters that are no word, in nats each.
LETTER = 2.303
#: Log odds are added up in units of this, so that no order of addition changes a sum.
UNIT = 1 << 32
RUNS = r"[a-z]+|[0-9]+|[^a-z0-9./_-]"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path as they stand; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.substr(url, at + 3)
    has = at > 0
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.coalesce(F.when(has, host), empty), F.coalesce(F.when(has, path), empty)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits; nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Later cases override earlier ones, so longer rules come last.
    for text, decided in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(decided)).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """``word, n``: all words (letters a-z) in the visible text of all pages."""
    text = F.translate(F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]*>", " "), UPPER, LOWER)
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def split(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The words of highest total log probability; ``counts`` has the known words that occur in ``name``.

    Letters that are no known word cost as much as a word seen once, and a
    factor of ten for every letter. Of equal splits the one with the shortest
    last word counts.
    """
    cost = {w: -math.log(n / total) for w, n in counts.items()}
    lengths = sorted({len(w) for w in cost})
    unknown = math.log(total)
    best, back = [0.0], [0]
    # Where letters that are no word begin at least cost; known words are always cheaper than the same letters unknown.
    open_, start = 0.0, 0
    for end in range(1, len(name) + 1):
        found = [(open_ + unknown + LETTER * end, -start)]
        found += [(best[end - n] + cost[name[end - n : end]], n - end) for n in lengths if n <= end and name[end - n : end] in cost]
        least, at = min(found)
        best.append(least)
        back.append(-at)
        if least - LETTER * end <= open_:
            open_, start = least - LETTER * end, end
    words, end = [], len(name)
    while end:
        words.append(name[back[end] : end])
        end = back[end]
    return words[::-1]


def known_words(runs: DataFrame, words: DataFrame) -> DataFrame:
    """``run, word, n``: the words that occur in each ``run`` of letters."""
    at = runs.select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("at"))
    parts = at.select("run", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(PART), F.length("run") - F.col("at") + 1))).alias("n"))
    found = parts.select("run", F.expr("substring(run, at, n)").alias("word")).distinct()
    # Words that no run contains go first, so that what is repeated for hot substrings is short.
    hits = words.join(found.select("word").distinct(), "word", "left_semi")
    short = salted_lookup(found, hits, "word", "run", "inner").select("run", "word", "n")
    heads = words.filter(F.length("word") > PART).withColumn("head", F.substring("word", 1, PART))
    windows = found.filter(F.length("word") == PART).withColumnRenamed("word", "head")
    long = windows.join(heads, "head").filter(F.col("run").contains(F.col("word"))).select("run", "word", "n")
    return short.unionByName(long)


def segmented(runs: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """``run, words``: every distinct ``run`` of letters split by :func:`split`."""

    def viterbi(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                split(run, {k["word"]: k["n"] for k in known}, total)
                for run, known in zip(batch["run"], batch["known"], strict=True)
            ]
            yield pd.DataFrame({"run": batch["run"], "words": pd.Series(found, index=batch.index, dtype=object)})

    # No more than PART words end at a letter of the run, long words aside.
    known = known_words(runs, words).groupBy("run").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    every = runs.join(known, "run", "left").select("run", F.coalesce("known", F.array().cast("array<struct<word:string,n:bigint>>")).alias("known"))
    return every.mapInPandas(viterbi, "run string, words array<string>")


def url_runs(urls: DataFrame) -> DataFrame:
    """``urls`` with a row for each run of letters, of digits, or other sign: ``key``, its ``mark`` and the ``run``; null if there is none."""
    marked = lambda mark, text: F.transform(
        F.regexp_extract_all(text, F.lit(RUNS), F.lit(0)), lambda run: F.concat(F.lit(mark), run)
    )
    both = F.concat(marked("h:", F.col("host")), marked("p:", F.translate("path", UPPER, LOWER)))
    keyed = urls.select("*", F.explode_outer(both).alias("key"))
    return keyed.withColumns({"mark": F.substring("key", 1, 2), "run": F.expr("substring(key, 3)")})


def run_tokens(keys: DataFrame, pages: DataFrame) -> DataFrame:
    """``key, token`` of every distinct key of ``keys``: tokens bear the mark of their run."""
    letters = keys.filter(F.col("run").rlike("^[a-z]"))
    words = stored(word_counts(pages), "url-words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + 1
    split_ = segmented(letters.select("run").distinct(), words, total)
    of_letters = letters.join(split_, "run").select("key", "mark", F.explode("words").alias("word"))
    sign = F.when(F.col("run").rlike("^[0-9]"), F.lit("0")).otherwise(F.col("run"))
    rest = keys.filter(~F.col("run").rlike("^[a-z]")).select("key", "mark", sign.alias("word"))
    return of_letters.unionByName(rest).select("key", F.concat("mark", "word").alias("token"))


def token_odds(counts: DataFrame, classes: dict[str, int]) -> tuple[DataFrame, int]:
    """``token, odds`` of multinomial naive Bayes with add-one smoothing, in ``UNIT``, and the odds of tokens never seen.

    ``counts`` is ``token, block, all``. Positive odds mean block.
    """
    sums = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("block"), F.lit(0)), F.coalesce(F.sum("all"), F.lit(0))).first()
    size = sums[0] + 1
    nb, na = sums[1] + size, sums[2] - sums[1] + size
    odds = F.log((F.col("block") + 1) / F.lit(nb)) - F.log((F.col("all") - F.col("block") + 1) / F.lit(na))
    unseen = math.log(1 / nb) - math.log(1 / na)
    return counts.select("token", F.round(odds * UNIT).cast("bigint").alias("odds")), round(unseen * UNIT)


def method_verdicts(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """``host, path, method`` of the distinct ``urls`` that no rule has decided.

    ``urls`` is ``host, path, decided, n``: distinct URLs, the verdict of their rule and how many pages have them.
    """
    classes = {r["decided"]: r["n"] for r in urls.filter("decided IS NOT NULL").groupBy("decided").agg(F.sum("n").alias("n")).collect()}
    open_ = urls.filter("decided IS NULL").select("host", "path")
    if len(classes) < 2:
        return open_.withColumn("method", F.lit(next(iter(classes), ALLOW)))
    block = F.when(F.col("decided") == BLOCK, F.col("n")).otherwise(0)
    judged_ = F.when(F.col("decided").isNotNull(), F.col("n")).otherwise(0)
    keys = stored(
        url_runs(urls).filter(F.col("key").isNotNull()).groupBy("key", "mark", "run").agg(
            F.sum(block).alias("block"), F.sum(judged_).alias("all")
        ), "url-keys",
    )
    tokens = stored(run_tokens(keys.select("key", "mark", "run"), pages), "url-tokens")
    counted = tokens.join(keys, "key").groupBy("token").agg(F.sum("block").alias("block"), F.sum("all").alias("all")).filter(F.col("all") > 0)
    odds, unseen = token_odds(stored(counted, "url-counts"), classes)
    of_key = salted_lookup(tokens, odds, "token", "key").groupBy("key").agg(F.sum(F.coalesce("odds", F.lit(unseen))).alias("odds"))
    met = salted_lookup(url_runs(open_), of_key, "key", "path")
    prior = round(math.log(classes[BLOCK] / classes[ALLOW]) * UNIT)
    total = F.coalesce(F.sum("odds"), F.lit(0)) + prior
    return met.groupBy("host", "path").agg(F.when(total > 0, F.lit(BLOCK)).otherwise(F.lit(ALLOW)).alias("method"))


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` columns with ``host, path, rule, verdict``; columns of those names are replaced."""
    host, path = host_and_path(F.col("url"))
    rest = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", *_OWN)]
    parts = pages.select(*rest, host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumn("rule", rule).withColumn("__decided", verdict)
    urls = stored(
        ruled.groupBy("host", "path", F.col("__decided").alias("decided")).agg(F.count(F.lit(1)).alias("n")), "urls"
    )
    # Pages that share a URL are spread over tasks; the verdict of a URL is repeated for each.
    found = method_verdicts(pages, urls).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("method", "__method")
    salted = ruled.withColumn("__salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    return salted.join(found, ["host", "path", "__salt"], "left").select(
        *rest, "host", "path", "rule", F.coalesce("__decided", "__method").alias("verdict")
    )


#: Names that :func:`judged` uses on the way; columns of these names are replaced as well.
_OWN = ("__decided", "__method", "__salt")
