"""Document quality by Bradley-Terry ranking.

A document's strength is a weighted sum of measures of its text. Weights are
learned from preference pairs (a document labelled 1 before one labelled 0) by
logistic loss on the difference of their measures. A strength becomes a score
between 0 and 1 on the logistic curve that puts the strength at the quantile
of the labelled documents that equals their share of 0 labels at ``CUT``.

Every labelled document and every pair of them counts. The mean over all pairs
needs no pair one by one: a function of the difference of two strengths is, on
intervals of strength of length 1, the polynomial through its values at ``NODES``
Chebyshev nodes (to about nine places), so sums over all pairs follow from sums
over documents by label, interval and node. One Spark aggregation makes those for
each Newton step; the driver gets rows by interval of strength, not by document.
A caller may bound the documents of each label (``per_label``, by lowest hash of
id and text) or the pairs (``pairs``, drawn) instead; no query does.
A labelled id that several rows bear labels all of them, and an id labelled 0
and 1 counts as 0. Ids, sources, languages and labels are never measured.
Null and empty texts have all measures 0 and are scored like any other. With
labels of one kind only, or none, every score is 0.5. A long text costs a list
of its words while it is measured.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corvane.llm.common import stored

PER_LABEL = 2000
PAIRS = 40_000
PENALTY = 1e-3
CUT = 0.3
STEEPNESS = 4.0
#: Nodes of an interval of strength, bins of a pass over strengths, and places that weights and scales are rounded to: sums
#: come in any order, and reruns should agree.
NODES = 8
BINS = 4096
WEIGHT_PLACES, SCALE_PLACES = 6, 12

MEASURES = [
    "length", "word length", "upper", "digits", "marks", "symbols", "bars", "sentence ends", "adjacent repeats",
    "distinct words", "most frequent word", "distinct pairs", "words that end a symbol", "wide letters",
    "lower-case starts", "line repeats", "all-capital words", "long words",
]


def measures(text: str | None) -> np.ndarray:
    """The measures of a whole text; every one stays bounded."""
    out = np.zeros(len(MEASURES))
    raw = (text or "").encode("utf-8", "surrogatepass")
    found = raw.split()
    n = len(found)
    if not n:
        return out
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    solid = max(1, int(counts.sum() - counts[9:14].sum() - counts[32]))
    spread = sum(map(len, found)) / n
    distinct = set(found)
    pairs = n - 1
    out[0] = np.log1p(n) / 10
    out[1] = np.log1p(spread)
    out[2] = counts[65:91].sum() / solid
    out[3] = counts[48:58].sum() / solid
    out[4] = (counts[33] + counts[63]) / solid
    out[5] = (counts[35:39].sum() + counts[42] + counts[60:63].sum() + counts[94:97].sum() + counts[126]) / solid
    out[6] = counts[124] / n
    out[7] = min(1.0, counts[46] / n)
    out[8] = sum(a == b for a, b in zip(found, found[1:], strict=False)) / max(1, pairs)
    out[9] = len(distinct) / n ** 0.8
    tally: dict[bytes, int] = {}
    for w in found:
        tally[w] = tally.get(w, 0) + 1
    out[10] = max(tally.values()) / n if n >= 10 else 0.1
    out[11] = len(set(zip(found, found[1:], strict=False))) / max(1, pairs) if pairs > 4 else 1.0
    ends = np.bincount(np.frombuffer(b"".join(w[-1:] for w in found), dtype=np.uint8), minlength=256)
    out[12] = (ends[33] + ends[35:39].sum() + ends[42]) / n
    out[13] = counts[128:].sum() / solid
    starts = np.bincount(np.frombuffer(b"".join(w[:1] for w in found), dtype=np.uint8), minlength=256)
    out[14] = starts[97:123].sum() / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    out[15] = 1 - len(set(lines)) / len(lines)
    out[16] = sum(w.isupper() and len(w) > 1 for w in found) / n
    out[17] = sum(len(w) > 25 for w in found) / n
    return out


@dataclass
class Ranker:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8)

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        base = np.log(CUT / (1 - CUT)) if np.any(self.weights) else 0.0
        z = STEEPNESS * (self.strength(x) - self.threshold) + base
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def measure_column(text: Column) -> Column:
    @pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([measures(t) for t in texts], dtype=object)

    return of(text)


def label_by_id(labels: DataFrame) -> DataFrame:
    """``doc_id, quality``: one label for each id."""
    return labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``quality, x``: label and measures of every labelled document. Texts are measured where they lie and never shuffled."""
    measured = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", measure_column(F.col("text")).alias("x"))
    return measured.join(label_by_id(labels), "doc_id").select(F.col("quality").cast("int").alias("quality"), "x")


def fit_sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> tuple[np.ndarray, np.ndarray]:
    """``(measures, labels)`` of the drawn documents. Labels are drawn before any text is read."""
    usable = label_by_id(labels)
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    none = np.zeros((0, len(MEASURES))), np.zeros(0)
    if not counts:
        return none
    share = F.create_map(*[F.lit(x) for q, n in counts.items() for x in (q, min(1.0, 1.2 * per_label / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
    drawn = usable.withColumn("__draw", draw).filter(F.col("__draw") <= F.element_at(share, F.col("quality")))
    # Drawn ids are at most about 2.4 times per_label rows.
    mine = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    x, y = [], []
    for quality in sorted(counts):
        # Each task keeps its lowest rows, so no more than per_label of a task leave it.
        own = mine.filter(F.col("quality") == quality).orderBy(F.xxhash64("doc_id", "text", F.lit("quality"))).limit(per_label)
        found = own.select(measure_column(F.col("text")).alias("x")).collect()
        x += sorted(r["x"] for r in found)
        y += [quality] * len(found)
    return (np.array(x), np.array(y)) if x else none


def fit(docs: DataFrame, labels: DataFrame, per_label: int | None = None, pairs: int | None = None, seed: int = 3) -> Ranker:
    """Learns from the ``quality`` of ``labels`` (1 is better) and the texts of ``docs``: all of them, unless bounds are given."""
    if per_label is not None or pairs is not None:
        return fit_bounded(docs, labels, per_label or PER_LABEL, pairs or PAIRS, seed)
    rows = stored(labelled(docs, labels), "labelled-measures")
    counts = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    ranker = flat()
    if len(counts) < 2:
        return ranker
    n = sum(counts.values())
    got = rows.select(Summarizer.metrics("mean", "variance").summary(array_to_vector("x")).alias("s")).first()["s"]
    spread = np.sqrt(np.maximum(got["variance"].toArray(), 0) * (n - 1) / n)
    ranker.centre = np.round(got["mean"].toArray(), SCALE_PLACES)
    ranker.scale = np.round(np.maximum(spread, 1e-6), SCALE_PLACES)
    ranker.weights = np.round(all_pairs(rows, ranker), WEIGHT_PLACES)
    strengths = stored(rows.select(strength_column(ranker).alias("v")), "strengths")
    at = (n - 1) * (counts[0] / n)
    ranker.threshold = (at_rank(strengths, int(np.floor(at))) + at_rank(strengths, int(np.ceil(at)))) / 2
    return ranker


def flat() -> Ranker:
    return Ranker(np.zeros(len(MEASURES)), np.ones(len(MEASURES)), np.zeros(len(MEASURES)), 0.0)


def strength_column(ranker: Ranker) -> Column:
    @pandas_udf("double")
    def of(x: pd.Series) -> pd.Series:
        return pd.Series(ranker.strength(np.stack(x.to_list())) if len(x) else [], dtype="float64")

    return of(F.col("x"))


def at_rank(strengths: DataFrame, rank: int) -> float:
    """The exact value of ``v`` with ``rank`` values before it, by counts of ever narrower bins."""
    low, high = strengths.agg(F.min("v"), F.max("v")).first()
    part, before = strengths, 0
    while low < high:
        place = F.least(F.floor((F.col("v") - low) / (high - low) * BINS), F.lit(BINS - 1))
        bins = part.groupBy(place.alias("bin")).agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        for found in sorted(bins.collect()):
            if rank < before + found["n"]:
                break
            before += found["n"]
        low, high = found["low"], found["high"]
        part = strengths.filter(F.col("v").between(low, high))
    return float(low)


def nodes() -> np.ndarray:
    """Chebyshev nodes of the interval from 0 to 1."""
    return (1 - np.cos((2 * np.arange(NODES) + 1) * np.pi / (2 * NODES))) / 2


def basis(t: np.ndarray) -> np.ndarray:
    """Values at ``t`` of the polynomials that are 1 at one node and 0 at the others."""
    at = nodes()
    out = np.ones((len(t), NODES))
    for k in range(NODES):
        for other in np.delete(at, k):
            out[:, k] *= (t - other) / (at[k] - other)
    return out


def moments(rows: DataFrame, ranker: Ranker) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By label: nodes of strength, and at each the sums over documents of 1, the scaled measures and their products."""
    upper = np.triu_indices(len(MEASURES))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            quality = batch.column(0).to_numpy()
            z = ranker.scaled(batch.column(1).flatten().to_numpy().reshape(-1, len(MEASURES)))
            strength = z @ ranker.weights
            interval = np.floor(strength).astype(np.int64)
            near = basis(strength - interval)
            terms = np.hstack([np.ones((len(z), 1)), z, z[:, upper[0]] * z[:, upper[1]]])
            order = np.lexsort((interval, quality))
            new = np.flatnonzero((np.diff(interval[order]) != 0) | (np.diff(quality[order]) != 0)) + 1
            for own in np.split(order, new):
                key = int(quality[own[0]]), int(interval[own[0]])
                sums[key] = sums.get(key, 0) + near[own].T @ terms[own]
        for (label, at), total in sums.items():
            yield pa.RecordBatch.from_pydict({
                "quality": pa.array([label], pa.int32()), "interval": pa.array([at], pa.int64()),
                "sums": pa.array([total.ravel()], pa.list_(pa.float64())),
            })

    parts = rows.select("quality", "x").mapInArrow(add, "quality int, interval bigint, sums array<double>")
    summed = parts.groupBy("quality", "interval").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    found = sorted(summed.collect(), key=lambda r: (r["quality"], r["interval"]))
    return {
        label: (
            np.concatenate([r["interval"] + nodes() for r in found if r["quality"] == label]),
            np.vstack([r["sums"].toArray().reshape(NODES, -1) for r in found if r["quality"] == label]),
        )
        for label in (0, 1)
    }


def pair_sums(found: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean over all pairs of the logistic loss, its gradient and its second derivatives, from :func:`moments`."""
    k = len(MEASURES)
    (low, worse), (high, better) = found[0], found[1]
    loss, gradient, products, crossed = 0.0, np.zeros(k), np.zeros(k * (k + 1) // 2), np.zeros((k, k))
    for at in range(0, len(high), NODES):
        own = better[at : at + NODES]
        gap = high[at : at + NODES, None] - low
        p = 1 / (1 + np.exp(np.clip(gap, -700, 700)))
        loss += own[:, 0] @ np.logaddexp(0, -gap) @ worse[:, 0]
        first = p @ worse[:, : k + 1]
        gradient -= first[:, 0] @ own[:, 1 : k + 1] - own[:, 0] @ first[:, 1:]
        second = (p * (1 - p)) @ worse
        products += second[:, 0] @ own[:, k + 1 :] + own[:, 0] @ second[:, k + 1 :]
        crossed += own[:, 1 : k + 1].T @ second[:, 1 : k + 1]
    curve = np.zeros((k, k))
    curve[np.triu_indices(k)] = products
    curve = curve + curve.T - np.diag(np.diag(curve)) - crossed - crossed.T
    n = better[:, 0].sum() * worse[:, 0].sum()
    return loss / n, gradient / n, curve / n


def all_pairs(rows: DataFrame, ranker: Ranker, penalty: float = PENALTY, steps: int = 40) -> np.ndarray:
    """Weights that minimise the mean of ``log(1 + exp(-w.d))`` over all pairs plus a ridge; a step that gains nothing is halved."""
    w, step, lowest = np.zeros(len(MEASURES)), np.zeros(len(MEASURES)), np.inf
    for _ in range(steps):
        loss, gradient, curve = pair_sums(moments(rows, replace(ranker, weights=w + step)))
        loss += penalty / 2 * float((w + step) @ (w + step))
        if loss > lowest + 1e-9:
            step = step / 2
            continue
        w, lowest = w + step, loss
        step = -np.linalg.solve(curve + penalty * np.eye(len(w)), gradient + penalty * w)
        if np.abs(step).max() < 1e-5:
            # Newton steps square their error, so this last one leaves far less than the places kept.
            return w + step
    return w


def fit_bounded(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, pairs: int = PAIRS, seed: int = 3) -> Ranker:
    """As :func:`fit`, from at most ``per_label`` documents of each label and ``pairs`` drawn pairs of them."""
    x, y = fit_sample(docs, labels, per_label)
    if not len(y) or y.min() == y.max():
        return flat()
    ranker = Ranker(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6), np.zeros(len(MEASURES)), 0.0)
    scaled = np.clip((x - ranker.centre) / ranker.scale, -8, 8)
    draw = np.random.default_rng(seed)
    better, worse = (draw.choice(np.flatnonzero(y == q), pairs) for q in (1, 0))
    ranker.weights = bradley_terry(scaled[better] - scaled[worse])
    strength = scaled @ ranker.weights
    share = labels_share(y)
    low, high = np.quantile(strength, share, method="lower"), np.quantile(strength, share, method="higher")
    ranker.threshold = float((low + high) / 2)
    return ranker


def labels_share(y: np.ndarray) -> float:
    """Share of 0 labels in the sample: the quantile at which strengths are cut."""
    return float(np.mean(y == 0))


def bradley_terry(differences: np.ndarray, penalty: float = PENALTY, steps: int = 30) -> np.ndarray:
    """Weights that minimise the mean of ``log(1 + exp(-w.d))`` plus a ridge, by Newton steps."""
    w = np.zeros(differences.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(differences @ w, -40, 40)))
        gradient = -(differences * p[:, None]).mean(axis=0) + penalty * w
        curve = (differences * (p * (1 - p))[:, None]).T @ differences / len(differences)
        step = np.linalg.solve(curve + penalty * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def scored(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; columns of those names are replaced."""

    @pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(ranker.score(np.stack([measures(t) for t in texts])))

    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*rest, of(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int")
    )
