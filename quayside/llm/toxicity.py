"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

Grades are 0 (labelled not toxic), 1 and 2 (labelled toxic, below or at least the median count
of toxic-leaning words). All thresholds share one weight vector: P(grade <= k) =
logistic(theta_k - w.x), theta_0 < theta_1. ``expected_severity`` is the sum of P(grade > k).

Features are word counts, hashed (lower case; words are runs of letters, digits and
non-ASCII characters). From a bounded, repeatable sample of labelled rows (``SAMPLE`` of either label) the
words whose share of toxic documents differs from that of others by ``Z`` standard errors and a
factor of ``exp(EFFECT)`` are kept;
their weights and the thresholds are fitted by gradient steps, each label weighted by its
true frequency. Scoring covers every document and its whole text.

Nulls: a null text has no words; a null label or id is not learned from; several labels of
one id count as the highest. Without both labels every grade is 0. Equal texts get equal
grades.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import IS_MARK, byte_rows, row_sums, slices, span_hashes, unit_hash, word_spans

SAMPLE = 4_000
HASH_BITS = 20
Z = 3.0
EFFECT = 1.5
STEPS = 400
GRADES = 3


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed words in text order, words per row)."""
    starts, ends, counts = word_spans(data, off, IS_MARK)
    return (span_hashes(data, starts, ends) >> np.uint64(64 - HASH_BITS)).astype(np.int32), counts


@dataclass
class OrdinalModel:
    weights: np.ndarray  # per hashed word
    thresholds: np.ndarray  # ascending, one fewer than grades

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None] - scores[:, None], -500, 500)))


def fit_ordinal(x: np.ndarray, y: np.ndarray, weight: np.ndarray, n_grades: int = GRADES, steps: int = STEPS, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of the cumulative-link model, by Adam steps on the
    weighted likelihood. Thresholds are a first value and positive gaps."""
    n, m = x.shape
    k = n_grades - 1
    p = np.zeros(m + k)
    p[m:] = [1.0] + [0.0] * (k - 1)
    m1, m2 = np.zeros_like(p), np.zeros_like(p)
    weight = weight / weight.sum()
    for t in range(1, steps + 1):
        theta = p[m] + np.concatenate([[0.0], np.cumsum(np.exp(p[m + 1 :]))])
        z = theta[None] - (x @ p[:m])[:, None]
        cdf = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        slope = cdf * (1 - cdf)
        full = np.concatenate([np.zeros((n, 1)), cdf, np.ones((n, 1))], 1)
        dfull = np.concatenate([np.zeros((n, 1)), slope, np.zeros((n, 1))], 1)
        rows = np.arange(n)
        like = np.maximum(full[rows, y + 1] - full[rows, y], 1e-12)
        # d loss / d theta_k of every row
        g = np.zeros((n, k))
        for j in range(k):
            g[:, j] = -weight * ((y == j) * dfull[:, j + 1] - (y == j + 1) * dfull[:, j + 1]) / like
        grad = np.zeros_like(p)
        grad[:m] = -(x.T @ g.sum(1)) + ridge * p[:m] / n
        total = g.sum(0)
        grad[m] = total.sum()
        for j in range(1, k):
            grad[m + j] = total[j:].sum() * np.exp(p[m + j])
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        p -= 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-9)
    return p[:m], p[m] + np.concatenate([[0.0], np.cumsum(np.exp(p[m + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> OrdinalModel:
    nothing = OrdinalModel(np.zeros(1 << HASH_BITS, np.float32), np.full(GRADES - 1, np.inf))
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return nothing
    share = F.when(F.col("toxic"), F.lit(min(1.0, sample / sizes[True]))).otherwise(F.lit(min(1.0, sample / sizes[False])))
    chosen = known.filter(unit_hash(F.col("doc_id"), F.lit(5)) < share)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = byte_rows(b.column(1), lower=True)
            rows = []
            for _, _, d, o in slices(data, off):
                h, n = _words(d, o)
                rows += [np.sort(x).tobytes() for x in np.split(h, np.cumsum(n)[:-1])]
            yield pa.record_batch([b.column(0), pa.array(rows, pa.binary())], ["toxic", "words"])

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    got = texts.select("toxic", "text").mapInArrow(hashed, "toxic boolean, words binary").collect()
    if len({r["toxic"] for r in got}) < 2:
        return nothing
    toxic = np.array([r["toxic"] for r in got])
    words = [np.frombuffer(r["words"], np.int32) for r in got]
    seen = np.zeros((2, 1 << HASH_BITS), np.int32)
    for t, w in zip(toxic, words, strict=True):
        seen[int(t), np.unique(w)] += 1
    n0, n1 = (~toxic).sum(), toxic.sum()
    p0, p1 = (seen[0] + 0.5) / (n0 + 1), (seen[1] + 0.5) / (n1 + 1)
    odds = np.log(p1 / p0)
    z = odds / np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))
    kept = np.flatnonzero((np.abs(z) > Z) & (np.abs(odds) > EFFECT))
    if not len(kept):
        return nothing
    column = np.full(1 << HASH_BITS, -1, np.int32)
    column[kept] = np.arange(len(kept))
    x = np.zeros((len(got), len(kept)))
    for i, w in enumerate(words):
        c = column[w]
        np.add.at(x[i], c[c >= 0], 1)
    hits = x[:, z[kept] > 0].sum(1)
    y = np.where(toxic, 1 + (hits >= max(1, np.median(hits[toxic]))), 0)
    truth = np.where(toxic, sizes[True] / n1, sizes[False] / n0)
    w, theta = fit_ordinal(x, y, truth)
    weights = np.zeros(1 << HASH_BITS, np.float32)
    weights[kept] = w
    return OrdinalModel(weights, theta)


def grade(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """``doc_id, toxic, grade, expected_severity, p_toxic`` for every row: the likeliest of
    the grades, and whether a grade above 0 is likelier than not."""
    schema = docs.select("doc_id").schema.add("toxic", "boolean").add("grade", "integer").add("expected_severity", "double").add("p_toxic", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = byte_rows(b.column(1), lower=True)
            score = np.zeros(len(off) - 1)
            for i, j, d, o in slices(data, off):
                h, n = _words(d, o)
                score[i:j] = row_sums(model.weights[h].astype(np.float64), n)
            up = model.above(score)
            p = -np.diff(np.concatenate([np.ones((len(up), 1)), up, np.zeros((len(up), 1))], 1), axis=1)
            toxic = up[:, 0] >= 0.5
            level = np.where(toxic, 1 + p[:, 1:].argmax(1), 0).astype(np.int32)
            yield pa.record_batch([b.column(0), pa.array(toxic), pa.array(level), pa.array(up.sum(1)), pa.array(up[:, 0])], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return grade(docs, fit(docs, labels))
