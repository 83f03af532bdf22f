"""Language identification by error-correcting output codes.

Every language gets a codeword; a binary classifier over hashed byte trigrams predicts each of
its bits. A classifier's weights are the log-odds of a trigram in the languages with the bit
set against those without, every language counted alike, from the trigram counts of *all*
training documents (Spark sums them). Decoding is loss-weighted: a language's loss is the
logistic loss of the scaled bit margins against its codeword, each bit weighted by how
often its classifier is right on that language. The margins' scales and these weights come
from a bounded sample of training documents (``SAMPLE_PER_LANG`` of each language).

A text that is null or holds no letter is ``und`` with score 0, and so is every text when
nothing is labelled. Null languages are not learned; equal texts get equal predictions. Texts
are taken whole, in lower case, with a blank before and after.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import byte_rows, crc_mod, slices, unit_hash

HASH_BITS = 14
SAMPLE_PER_LANG = 1_000
#: Below this lead of the best language's score over the second, a prediction is ambiguous.
LEAD = 0.2
UNDETERMINED = "und"


def code_matrix(n: int, seed: int = 11) -> np.ndarray:
    """Codewords of +1 and -1 as rows: all distinct bipartitions up to 5 languages, beyond
    that the random code of the greatest least distance among 200."""
    if n <= 1:
        return np.ones((n, 1), np.float32)
    if n <= 5:
        bits = np.arange(1, 2 ** (n - 1))
        rows = [np.ones(len(bits))] + [1 - 2 * ((bits >> k) & 1) for k in range(n - 1)]
        return np.array(rows, np.float32)
    rng, width = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, least = None, -1
    for _ in range(200):
        m = rng.choice([-1.0, 1.0], (n, width)).astype(np.float32)
        m[:, np.abs(m.sum(0)) == n] *= np.where(np.arange(n) % 2, 1, -1)[:, None]
        gap = width - m @ m.T
        np.fill_diagonal(gap, np.inf)
        if gap.min() > least:
            best, least = m, gap.min()
    return best


def _grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed trigrams at every byte, first and end position of each row's own)."""
    if len(data) < 3:
        z = np.zeros(len(off) - 1, np.int64)
        return np.zeros(0, np.uint32), z, z
    d = data.astype(np.uint32)
    code = d[:-2] | (d[1:-1] << 8) | (d[2:] << 16)
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - HASH_BITS), off[:-1], np.maximum(off[:-1], off[1:] - 2)


def _padded(text: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise("", pc.fill_null(text.cast(pa.string()), ""), "", " ")


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).dictionary_encode()
        names, ids = langs.dictionary.to_pylist(), np.asarray(langs.indices)
        data, off = byte_rows(_padded(batch.column(0)), lower=True)
        for i, j, d, o in slices(data, off):
            h, first, end = _grams(d, o)
            for k in np.unique(ids[i:j]):
                rows = np.flatnonzero(ids[i:j] == k)
                own = np.concatenate([h[a:b] for a, b in zip(first[rows], end[rows], strict=True)]) if len(rows) else h[:0]
                t = totals.setdefault(names[k], np.zeros(1 << HASH_BITS, np.int64))
                t += np.bincount(own, minlength=1 << HASH_BITS)
    for name, t in totals.items():
        at = np.flatnonzero(t)
        yield pa.record_batch([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(t[at], pa.int64())], ["lang", "gram", "n"])


def _margins(text: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Mean weight of each text's trigrams, a row per text, a column per bit."""
    data, off = byte_rows(_padded(text), lower=True)
    out = np.zeros((len(off) - 1, weights.shape[1]), np.float64)
    for i, j, d, o in slices(data, off, 1 << 18):
        h, first, end = _grams(d, o)
        if not len(h):
            continue
        n = end - first
        at = np.flatnonzero(n)
        w = np.concatenate([weights[h], np.zeros((1, weights.shape[1]), np.float32)])
        pairs = np.stack([first[at], end[at]], 1).ravel()
        out[i + at] = np.add.reduceat(w, pairs, axis=0)[::2] / n[at, None]
    return out


def has_letter(text: pa.Array) -> np.ndarray:
    return np.asarray(pc.match_substring_regex(pc.fill_null(text.cast(pa.string()), ""), r"\p{L}"), bool)


@dataclass
class CodeModel:
    langs: list[str]
    code: np.ndarray  # language x bit
    weights: np.ndarray  # trigram x bit
    scale: np.ndarray  # per bit
    trust: np.ndarray  # language x bit, rows sum to 1

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """Probabilities of the languages from the bit margins."""
        f = margins * self.scale
        loss = np.logaddexp(0, -self.code[None] * f[:, None, :])
        d = -(loss * self.trust[None]).sum(2) * self.code.shape[1]
        p = np.exp(d - d.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


    def label(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, ambiguous) of every text."""
        text = pc.fill_null(text.cast(pa.string()), "")
        some = has_letter(text) & bool(self.langs)
        lang = np.full(len(text), UNDETERMINED, object)
        score, unclear = np.zeros(len(text)), ~some
        if some.any():
            p = self.decode(_margins(text.filter(pa.array(some)), self.weights))
            top = np.sort(p, 1)
            lang[some], score[some] = np.array(self.langs, object)[p.argmax(1)], top[:, -1]
            unclear[some] = (top[:, -1] - top[:, -2] < LEAD) if p.shape[1] > 1 else False
        return lang, score, unclear


def fit(docs: DataFrame, train: Column, sample_per_lang: int = SAMPLE_PER_LANG) -> CodeModel:
    """Learn from ``text`` and ``lang`` of the rows for which ``train`` holds."""
    rows = docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    grams = rows.select("text", "lang").mapInArrow(_count_grams, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(grams["lang"].unique())
    counts = np.zeros((len(langs), 1 << HASH_BITS))
    counts[np.searchsorted(langs, grams["lang"]), grams["gram"]] = grams["n"]
    code = code_matrix(len(langs))
    if not langs:
        return CodeModel([], code, np.zeros((1 << HASH_BITS, 1), np.float32), np.ones(1), np.ones((0, 1)))
    p = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * counts.shape[1])
    side = lambda s: ((code == s).astype(float).T @ p) / np.maximum((code == s).sum(0), 1)[:, None]
    plus, minus = side(1), side(-1)
    weights = np.where(minus > 0, np.log(plus / np.where(minus > 0, minus, 1)), 0).T.astype(np.float32)

    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample_per_lang / n))])
    sample = rows.filter(F.col("doc_id").isNotNull() & (unit_hash(F.col("doc_id"), F.lit(3)) < F.element_at(share, F.col("lang"))))
    # a row per id: an id of many rows counts once
    sample = sample.groupBy("doc_id").agg(F.max(F.struct("lang", "text")).alias("x")).select("x.lang", "x.text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _margins(b.column(1), weights)
            yield pa.record_batch([b.column(0), pa.array(list(m), pa.list_(pa.float64()))], ["lang", "m"])

    got = sample.mapInArrow(measure, "lang string, m array<double>").toPandas()
    m = np.array(got["m"].tolist()).reshape(len(got), code.shape[1])
    truth = np.searchsorted(langs, got["lang"])
    scale = 3 / np.maximum(np.median(np.abs(m), axis=0), 1e-6) if len(m) else np.ones(code.shape[1])
    right = pd.DataFrame((m * code[truth]) > 0).groupby(truth).mean().reindex(range(len(langs))).fillna(1.0).to_numpy()
    trust = np.maximum(right, 1e-3)
    return CodeModel(langs, code, weights, scale, trust / trust.sum(1, keepdims=True))


def predict(docs: DataFrame, model: CodeModel) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` for every row."""
    schema = docs.select("doc_id").schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, unclear = model.label(b.column(1))
            yield pa.record_batch([b.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(unclear)], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def kept(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a letter, ``lang`` being the predicted language, or as it was where none
    could be learned. An ambiguous prediction stays: it names a language, only less surely."""
    model = fit(docs, ~held_out(F.col("doc_id")))

    at, names = docs.columns.index("lang"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(names.index("text"))
            lang = pa.array(model.label(text)[0], pa.string()) if model.langs else b.column(at)
            whole = pa.RecordBatch.from_arrays([lang if k == at else c for k, c in enumerate(b.columns)], names)
            yield whole.filter(pa.array(has_letter(text)))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_mod(doc_id, 5) == 0, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous``: learned from the documents outside
    the held-out fold, predicted for all."""
    model = fit(docs, ~held_out(F.col("doc_id")))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
