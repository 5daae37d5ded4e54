"""Language of a text by a blended-spectrum string kernel.

A text is the set of its character n-grams of 1 to ``SPECTRUM`` letters over
lower-cased letters, everything else being one blank. The kernel of two texts
is the number of n-grams present in both, divided by the root of the product
of their set sizes. Landmarks span a Nyström feature space in which one kernel
ridge regression per language is solved (one versus the rest). A batch of
texts is scored by two matrix products: presence x landmarks, kernels x
coefficients.

The ``MOST_GRAMS`` n-grams that most fitting texts have are the model's columns.
Every language is learned. At most ``PER_LANG`` texts of a language and
``MOST_SAMPLE`` in all are used for fitting, the ones with the lowest hash of id
and text; repeated rows count once. The sample leaves the executors as sets of
n-gram numbers, never as texts, and no more rows than that come to the driver,
however often an id is repeated.

Null texts and texts without a letter are ``und`` with score 0. Without any
labelled text every row is ``und``. Null labels are never learned. A long text
costs about 50 bytes a letter while it is measured.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corvane.llm.common import stored

SPECTRUM = 4
GRAM_BITS = 20
MOST_GRAMS = 8192
PER_LANG = 250
#: Texts of the whole sample.
MOST_SAMPLE = 4000
LANDMARKS_PER_LANG = 40
RIDGE = 1e-2
UNKNOWN = "und"
BATCH = 256


def gram_numbers(text: str) -> np.ndarray:
    """Numbers below ``2 ** GRAM_BITS`` of all n-grams of a text, repeats included."""
    import regex

    plain = " " + regex.sub(r"\P{L}+", " ", text.lower()).strip() + " "
    points = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    out = []
    value = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, SPECTRUM + 1):
        if len(points) < n:
            break
        value = value[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(n)
        spread = (value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAM_BITS)
        out.append(spread.astype(np.int64))
    return np.concatenate(out)


def has_letter(text: str | None) -> bool:
    import regex

    return bool(text) and regex.search(r"\p{L}", text) is not None


@dataclass
class Model:
    """``column`` numbers the kept n-grams (-1: not kept); the rest is dense."""

    langs: list[str]
    column: np.ndarray
    landmarks: np.ndarray
    landmark_norm: np.ndarray
    weights: np.ndarray

    def presence(self, texts: list[str]) -> np.ndarray:
        """Texts x kept n-grams, 0 or 1."""
        out = np.zeros((len(texts), self.landmarks.shape[1] + 1), dtype=np.float32)
        for row, text in zip(out, texts, strict=True):
            row[self.column[gram_numbers(text)]] = 1
        return out[:, :-1]

    def outputs(self, texts: list[str]) -> np.ndarray:
        """Regression outputs, texts x languages; about 1 for a text's own language."""
        here = self.presence(texts)
        kernel = here @ self.landmarks.T.astype(np.float32)
        norm = np.sqrt(np.maximum(here.sum(axis=1), 1))
        kernel /= norm[:, None] * self.landmark_norm[None, :]
        return kernel @ self.weights

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return names, scores
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        for at in range(0, len(known), BATCH):
            rows = known[at : at + BATCH]
            out = self.outputs([texts[i] for i in rows])
            best = np.argmax(out, axis=1)
            share = np.clip(out, 0, None)
            total = np.maximum(share.sum(axis=1), 1e-9)
            for i, b, s in zip(rows, best, share[np.arange(len(rows)), best] / total, strict=True):
                names[i], scores[i] = self.langs[b], float(min(max(s, 0.0), 1.0))
        return names, scores


def fit_sample(labelled: DataFrame, per_lang: int = PER_LANG) -> list[tuple[str, np.ndarray]]:
    """``(lang, n-gram numbers)`` of at most ``per_lang`` texts of each language and ``MOST_SAMPLE`` in all.

    Texts with a letter are ranked in their language by a hash of id and text,
    equal rows as one. Only the hashes are ranked; texts of the lowest ones are
    read afterwards. With more languages than texts of the sample, the lowest
    hashes of all first ranks are taken.
    """
    draw = F.xxhash64("doc_id", "text", F.lit("language")).alias("draw")
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", draw)
    draws = stored(usable.select("lang", "draw").distinct(), "language-draws")
    per_lang = min(per_lang, max(1, MOST_SAMPLE // max(1, draws.select("lang").distinct().count())))
    # Each task cuts a language at its lowest ranks before rows meet.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    ranked = draws.withColumn("place", place).filter(F.col("place") <= per_lang)
    chosen = ranked.orderBy("place", "draw", "lang").limit(MOST_SAMPLE).select("lang", "draw")

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [np.unique(gram_numbers(t)).astype("<u4").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "draw": batch["draw"], "grams": pd.Series(sets, index=batch.index, dtype=object)})

    # At most MOST_SAMPLE hashes.
    drawn = usable.join(F.broadcast(chosen), ["lang", "draw"])
    sets = drawn.mapInPandas(numbers, "lang string, draw bigint, grams binary")
    rows = sets.groupBy("lang", "draw").agg(F.min("grams").alias("grams")).collect()
    rows.sort(key=lambda r: (r["lang"], r["draw"]))
    return [(r["lang"], np.frombuffer(r["grams"], dtype="<u4")) for r in rows]


def fit(labelled: DataFrame, per_lang: int = PER_LANG, landmarks: int = LANDMARKS_PER_LANG, ridge: float = RIDGE) -> Model:
    """Learns from ``doc_id, text, lang``; ids only draw the sample."""
    sample = fit_sample(labelled, per_lang)
    column = np.full(1 << GRAM_BITS, -1, dtype=np.int32)
    if not sample:
        return Model([], column, np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)))
    langs = sorted({lang for lang, _ in sample})
    seen = np.bincount(np.concatenate([g for _, g in sample]), minlength=1 << GRAM_BITS)
    frequent = np.argsort(-seen, kind="stable")[:MOST_GRAMS]
    frequent = np.sort(frequent[seen[frequent] > 0])
    column[frequent] = np.arange(len(frequent))
    presence = np.zeros((len(sample), len(frequent) + 1), dtype=np.float32)
    for row, (_, grams) in zip(presence, sample, strict=True):
        row[column[grams]] = 1
    presence = presence[:, :-1]
    presence_norm = np.sqrt(np.maximum(presence.sum(axis=1), 1))

    turn: dict[str, int] = {}
    chosen = []
    for i, (lang, _) in enumerate(sample):
        turn[lang] = turn.get(lang, 0) + 1
        if turn[lang] <= landmarks:
            chosen.append(i)
    marks, norm = presence[chosen], presence_norm[chosen]
    kernel = (presence @ marks.T) / (presence_norm[:, None] * norm[None, :])
    own = kernel[chosen].astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    mapped = kernel.astype(np.float64) @ root
    truth = np.array([[float(lang == x) for x in langs] for lang, _ in sample])
    # Rare languages weigh as much as frequent ones.
    weight = 1 / truth.sum(axis=0)[np.argmax(truth, axis=1)]
    scaled = mapped * weight[:, None]
    inner = np.linalg.solve(scaled.T @ mapped + ridge * weight.mean() * np.eye(mapped.shape[1]), scaled.T @ truth)
    return Model(langs, column, marks.astype(np.uint8), norm.astype(np.float32), (root @ inner).astype(np.float32))


def language_column(text: Column, model: Model) -> Column:
    """``struct<lang_pred, score>`` of whole texts."""
    shared = {"model": model}

    @pandas_udf("struct<lang_pred:string,score:double>")
    def of(texts: pd.Series) -> pd.DataFrame:
        names, scores = shared["model"].predict([None if t is None else str(t) for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return of(text)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of those names are replaced."""
    rest = [c for c in docs.columns if c not in ("lang_pred", "score", "__language")]
    found = docs.withColumn("__language", language_column(F.col("text"), model))
    return found.select(*rest, F.col("__language.lang_pred").alias("lang_pred"), F.col("__language.score").alias("score"))
