"""Helpers shared by the operators: written intermediate tables and vectorised text.

The text helpers see a batch of texts as one UTF-8 byte array with row offsets (Arrow's own
layout), so that words, hashes and n-grams of thousands of documents come from a few numpy
passes. ``slices`` bounds the bytes that one pass holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch_dir

#: A word is a run of other bytes than these (they never occur inside a UTF-8 sequence).
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20

_U = np.uint64


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written below ``spark.checkpoint.dir`` and read again (cut lineage
    that survives lost executors)."""
    path = scratch_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (the documented fold of a document)."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(m))


def unit_hash(*cols: Column) -> Column:
    """A repeatable uniform number in [0, 1) from the columns' values."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / F.lit(float(1 << 52))


def sampled(rows: DataFrame, key: str, value: str, n: float, salt: int) -> DataFrame:
    """(key, value) of about ``n`` keys, or of all if fewer, chosen by a hash of the key: one row per key, so
    that a key of many rows counts once. Null keys are not chosen."""
    total = rows.count()
    picked = rows.filter(F.col(key).isNotNull() & (unit_hash(F.col(key), F.lit(salt)) < min(1.0, n / max(total, 1))))
    return picked.groupBy(key).agg(F.max(value).alias(value))


# ---------------------------------------------------------------- vectors of whole numbers

#: Inner products of whole numbers are exact in doubles below this size; scores are held there.
EXACT = float(1 << 53)
#: Components are held below this size, so that no inner product is infinite.
LARGEST = 1e150


def whole_vector(name: str, scale: int) -> tuple[Column, Column]:
    """(``floor(scale * x)`` of every component as doubles, whether the vector is usable: not null, of at
    least one component, none null or non-finite, once scaled)."""
    scaled = F.transform(name, lambda x: x.cast("double") * scale)
    finite = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    # floor() gives a long; beyond EXACT a double has no fraction anyway
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < F.lit(EXACT), F.floor(x).cast("double")).otherwise(F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST))))
    return whole, F.coalesce(finite, F.lit(False)) & (F.size(name) > 0)


def held_score(score: np.ndarray) -> np.ndarray:
    """Scores held at ``EXACT`` in size."""
    return np.clip(score, -EXACT, EXACT)


# ---------------------------------------------------------------- texts as byte arrays


def byte_rows(col: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is the empty text."""
    col = pc.fill_null(col.cast(pa.string()), "")
    if lower:
        col = pc.utf8_lower(col)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    buf = col.buffers()[2] if len(col) else None
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(data: np.ndarray, off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes; a longer
    text stands alone and whole."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (xor-shift and multiply)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0xA24BAED4963EE407))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        m = max(n, 2 * SLICE_BYTES)
        for k, b in enumerate((_BASE, _BASE_INV)):
            p = np.full(m, b)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings [start, end), equal for equal bytes: one prefix sum
    of bytes times powers, then a difference per span."""
    fwd, inv = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * fwd[: len(data)], out=total[1:])
    return mix64((total[ends] - total[starts]) * inv[starts])


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True
#: For words as letters, digits and non-ASCII only.
IS_MARK = np.zeros(256, bool)
IS_MARK[[b for b in range(128) if not chr(b).isalnum()]] = True


def word_spans(data: np.ndarray, off: np.ndarray, sep: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words per row) of the maximal runs of bytes that are no separators;
    a word never crosses rows."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off) - 1, np.int64)
    inside = ~sep[data]
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    edge[off[:-1][off[:-1] < n]] = True
    at = np.flatnonzero(edge)
    ends = np.append(at[1:], n)
    keep = inside[at]
    starts, ends = at[keep], ends[keep]
    return starts, ends, np.diff(np.searchsorted(starts, off))


def row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``counts`` values (0 for empty runs)."""
    out = np.zeros((len(counts), *values.shape[1:]), values.dtype)
    full = counts > 0
    if full.any():
        begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
        out[full] = np.add.reduceat(values, begin[full], axis=0)
    return out
