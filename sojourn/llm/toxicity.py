"""Toxicity by character n-grams: a linear classifier over naive Bayes log-count ratios."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, mix, slices

#: Characters in an n-gram, from and to; number of hashed n-grams; smoothing of their counts.
ORDERS, GRAMS, SMOOTH = (3, 5), 1 << 18, 1.0
#: An n-gram is a feature of its own again where it starts at one of so many characters or more.
DENSITIES = (400, 100)
BUCKETS = GRAMS * (1 + len(DENSITIES))
#: The classifier is fitted to at most so many labelled documents of each class; ratios count all.
SAMPLE = 1500
#: Passes of the fit, its step and its penalty.
STEPS, STEP, PENALTY = 80, 0.05, 2e-3
#: Features gone through at a time.
_PART = 1 << 20
#: Labelled rows whose crc32 of the id leaves 0 by FOLDS are held out.
FOLDS = 5

_U = np.uint64
_PRIME = _U(0x100000001B3)


def features(text: str | None) -> np.ndarray:
    """The features of a text in lower case, edges as spaces: each n-gram that occurs, and once more
    for each of the densities it reaches when it occurs again."""
    if not text:
        return np.empty(0, dtype=np.int64)
    chars = f" {text.lower()} ".encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(chars, dtype=np.uint32).astype(np.uint64)
    grams, found = codes + _U(1), []
    for n in range(2, ORDERS[1] + 1):
        grams = grams[:-1] * _PRIME + codes[n - 1 :] + _U(1)
        if n >= ORDERS[0]:
            found.append(mix(grams ^ _U(n)) & _U(GRAMS - 1))
    times = np.bincount(np.concatenate(found).astype(np.int64), minlength=GRAMS)
    seen = np.flatnonzero(times)
    times = times[seen]
    dense = [seen[(times > 1) & (times * d >= len(codes))] + GRAMS * (k + 1) for k, d in enumerate(DENSITIES)]
    return np.concatenate([seen, *dense])


def held_out(folds: int = FOLDS) -> Column:
    """Whether a document is kept from learning; a null id is."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(True))


def class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each feature, how many labelled documents (text, toxic) of either class have it, and how
    many documents there are: arrays of two columns. Every task adds up its own documents first."""

    def run(batches):
        count, n = np.zeros((2, BUCKETS), dtype=np.int64), [0, 0]
        for batch in slices(batches):
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                count[int(toxic), features(text)] += 1
                n[int(toxic)] += 1
        at = np.flatnonzero(count.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(at, -1).astype(np.int32)),
                pa.array(np.append(count[0, at], n[0])),
                pa.array(np.append(count[1, at], n[1])),
            ],
            names=["feature", "clean", "toxic"],
        )

    per_task = arrow_map(labelled.select("text", "toxic"), run, "feature int, clean long, toxic long")
    # At most one row for each feature comes to the driver, however large the corpus.
    got = per_task.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    count = np.zeros((BUCKETS + 1, 2), dtype=np.int64)
    count[got["feature"].to_numpy()] = np.column_stack([got["clean"].to_numpy(), got["toxic"].to_numpy()])
    return count[:-1], count[-1]


def ratios(count: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The log ratio of each feature's smoothed share of toxic and of clean documents."""
    share = (count + SMOOTH) / (n + 2 * SMOOTH)
    return np.log(share[:, 1]) - np.log(share[:, 0])


def fit(
    found: np.ndarray, lengths: np.ndarray, toxic: np.ndarray, ratio: np.ndarray, prior: float
) -> tuple[np.ndarray, float]:
    """Weights of the features (their ratios times what logistic regression learns) and the intercept.

    ``found`` has the documents' features one after the other, ``lengths`` how many each has; they
    are gone through in parts, so that memory stays near their own size. The sample has its own
    share of toxic documents, so the intercept moves to the true ``prior``.
    """
    used = np.flatnonzero(np.bincount(found, minlength=BUCKETS)) if len(found) else np.empty(0, np.int64)
    place = np.zeros(BUCKETS, dtype=np.int32)
    place[used] = np.arange(len(used))
    n = len(lengths)
    ends = np.cumsum(lengths)
    cuts = np.unique([0, *np.searchsorted(ends, np.arange(_PART, ends[-1] if n else 0, _PART)), n])
    parts = []
    for a, b in zip(cuts, cuts[1:]):
        rows = place[found[ends[a] - lengths[a] : ends[b - 1]]]
        parts.append((a, b, rows, np.repeat(np.arange(b - a, dtype=np.int32), lengths[a:b])))
    value = ratio[used]
    weight, bias = np.ones(len(used)) * 0.1, 0.0
    moments = np.zeros((2, len(used) + 1))
    for t in range(1, STEPS + 1):
        slope, total = np.zeros(len(used)), 0.0
        now = weight * value
        for a, b, rows, owner in parts:
            z = np.bincount(owner, weights=now[rows], minlength=b - a) + bias
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic[a:b]
            slope += np.bincount(rows, weights=error[owner], minlength=len(used))
            total += error.sum()
        grad = np.append(slope * value / n + PENALTY * weight, total / n)
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.99 * moments[1] + 0.01 * grad * grad
        step = STEP * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.99**t)) + 1e-8)
        weight, bias = weight - step[:-1], bias - step[-1]
    out = np.zeros(BUCKETS)
    out[used] = weight * value
    share = toxic.mean()
    logit = lambda p: np.log(p / (1 - p))
    return out, float(bias + logit(prior) - logit(share))


def learned(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> tuple[np.ndarray, float]:
    """Weights and intercept from the labelled documents that are not held out.

    Of several labels of a document the highest counts; null labels and ids do not. Without
    documents of both classes the weights are 0 and the intercept is their share's (0 for none).
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(folds))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    # Labels grow with the documents: always joined by sorting both, the same plan at every size.
    count, n = class_counts(docs.select("doc_id", "text").join(known.hint("merge"), "doc_id"))
    if not n.all():
        share = (n[1] + SMOOTH) / (n.sum() + 2 * SMOOTH)
        return np.zeros(BUCKETS), float(np.log(share / (1 - share)))
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(SAMPLE) for k in (0, 1)]
    # Twice SAMPLE ids and labels: a bounded table.
    chosen = docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")

    def run(batches):
        for batch in slices(batches):
            found = [features(t).astype(np.int32) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["toxic"], pa.array(found, type=pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "found"],
            )

    rows = arrow_map(chosen, run, "doc_id long, toxic int, found array<int>").toArrow()
    rows = rows.sort_by([("doc_id", "ascending")])
    found = rows["found"].combine_chunks()
    lengths = found.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    toxic = rows["toxic"].to_numpy().astype(float)
    return fit(found.flatten().to_numpy(), lengths, toxic, ratios(count, n), n[1] / n.sum())


def scored(docs: DataFrame, model: tuple[np.ndarray, float], folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs`` (doc_id, text).

    Null and empty texts have no features and get the intercept's score. Rows are scored one by
    one, whatever their ids; a null id counts as held out.
    """
    weights, bias = model[0].astype(np.float32), model[1]

    def run(batches):
        for batch in slices(batches):
            z = np.array([weights[features(t)].sum(dtype=np.float64) for t in batch["text"].to_pylist()]) + bias
            score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", "text", held_out(folds).alias("held_out"))
    return arrow_map(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, learned(docs, labels))

