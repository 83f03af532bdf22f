"""Document fingerprints by locally consistent parsing.

The bytes of a text are level 0. A level is parsed into phrases by deterministic coin tossing:
runs of an equal symbol are first one symbol, named by symbol and run length; every symbol is
labelled by the lowest bit in which it differs from its left neighbour; the labels are labelled
again in the same way until they are below 6; a phrase begins at every local maximum of
the labels. A phrase's name is a hash of the names inside it, and the names are the next
level. A cut depends on a few neighbours only, so equal substrings have equal names
except near their ends, at whatever offset they stand.

The fingerprint is a one-permutation sketch of the set of phrase names of levels ``FIRST_LEVEL``
and up (a phrase there spans about 25 bytes or more): the name with the least hash in each of ``SLOTS``
slots, as 4 hex digits, or ``....`` for a slot without one. The likeness of two fingerprints is the
Dice coefficient 2J / (1 + J) of the sets, J estimated as equal slots by slots filled in either.

Nulls: a null text is the empty text; two empty texts are alike (1). Equal texts have equal
fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import byte_rows, mix64, slices

FIRST_LEVEL = 3
SLOTS = 128
_EMPTY = 0xFFFF
_U = np.uint64
_STEPS = mix64(np.arange(1, 65, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


def _bit_labels(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """2 * (lowest bit in which a symbol differs from its left neighbour) + that bit. A row's
    first symbol differs from its neighbour in bit 0."""
    left = np.empty_like(s)
    left[1:] = s[:-1]
    left[first] = s[first] ^ s.dtype.type(1)
    x = s ^ left
    pos = np.bitwise_count((x & -x) - s.dtype.type(1)) if s.dtype == np.uint64 else _LOW[x]
    return (2 * pos + ((s >> pos.astype(s.dtype)) & s.dtype.type(1)).astype(np.uint8)).astype(np.uint8)


_LOW = np.array([(x & -x).bit_length() - 1 if x else 0 for x in range(256)], np.uint8)


def parse_level(s: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and row offsets of the next level: one name per phrase of every row."""
    n = len(s)
    first = off[:-1][np.diff(off) > 0]
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(s[1:], s[:-1], out=new[1:])
    new[first] = True
    at = np.flatnonzero(new)
    names = mix64(s[at].astype(np.uint64) + (np.diff(np.append(at, n)).astype(np.uint64) << _U(32)) * _U(0x9E3779B97F4A7C15))
    off = np.searchsorted(at, off)
    s, n = (s[at] if s.dtype == np.uint8 else names), len(at)  # neighbours differ now
    first = off[:-1][np.diff(off) > 0]
    label = _bit_labels(s, first)
    for _ in range(3):  # 128 -> 14 -> 8 -> 6 labels
        label = _bit_labels(label, first)
    cut = np.zeros(n, bool)
    cut[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    last = off[1:][np.diff(off) > 0] - 1
    cut[last] = False  # a row's last symbol has no right neighbour to exceed
    cut[first] = True
    begin = np.flatnonzero(cut)
    place = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    return mix64(np.add.reduceat(names * _STEPS[place & 63], begin)), np.searchsorted(begin, off)


def sketches(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, SLOTS) uint16 fingerprints of a batch of byte texts."""
    rows = len(off) - 1
    out = np.full((rows, SLOTS), 1 << 63, np.uint64)
    s, level = data, 0
    live = np.arange(rows)[np.diff(off) > 0]
    off = np.append(off[:-1][np.diff(off) > 0], off[-1:])
    while len(live):
        s, off = parse_level(s, off)
        level += 1
        if level < FIRST_LEVEL:
            continue
        h = mix64(s) >> _U(1)
        slot = np.repeat(live, np.diff(off)) * SLOTS + (h % _U(SLOTS)).astype(np.int64)
        order = np.lexsort((h, slot))
        one = np.flatnonzero(np.diff(slot[order], prepend=-1))
        flat = out.reshape(-1)
        flat[slot[order][one]] = np.minimum(flat[slot[order][one]], h[order][one])
        go = np.diff(off) > 1  # a row of one phrase is parsed to its end
        keep = np.repeat(go, np.diff(off))
        s, live = s[keep], live[go]
        off = np.concatenate([[0], np.cumsum(np.diff(off)[go])])
    mark = (out >> _U(20)) % _U(_EMPTY)
    return np.where(out == _U(1 << 63), _EMPTY, mark).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: 2J / (1 + J) with J from the sketches."""
    filled = ((a != _EMPTY) | (b != _EMPTY)).sum(1)
    j = np.where(filled > 0, ((a == b) & (a != _EMPTY)).sum(1) / np.maximum(filled, 1), 1.0)
    return 2 * j / (1 + j)


def as_text(sketch: np.ndarray) -> list[str]:
    hexes = sketch.astype(">u2").tobytes().hex()
    width = 4 * SLOTS
    return [hexes[i : i + width].replace("ffff", "....") if "ffff" in hexes[i : i + width] else hexes[i : i + width] for i in range(0, len(hexes), width)] if len(sketch) else []


def sketch_texts(texts: list[str]) -> np.ndarray:
    data, off = byte_rows(pa.array(texts, pa.string()))
    parts = [sketches(d, o) for _, _, d, o in slices(data, off)]
    return np.concatenate(parts) if parts else np.zeros((0, SLOTS), np.uint16)


def edit(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, _range, _extra)``, arranged so that in every partition each document is
    followed by the next one (ascending doc_id, null first, then text; the last by the first).

    Ids are cut at quantiles into as many ranges as the session has shuffle partitions. The first
    document of a range is sent a second time, marked ``_extra``, to the end of the range before;
    so a text is shuffled once. Every range is a task of its own. The driver holds one id per range."""
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    at = [k / parts for k in range(1, parts)]
    cuts = sorted(set(docs.select(F.percentile_approx("doc_id", at, 100 * parts).alias("q")).first()["q"] or [])) if at else []
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    place = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(place)
    heads = {r["_range"]: r for r in docs.groupBy(place.alias("_range")).agg(F.min("doc_id").alias("head"), F.bool_or(F.col("doc_id").isNull()).alias("nulls")).collect()}
    order = sorted(heads)
    before = {r: order[k - 1] for k, r in enumerate(order)}  # the first range comes after the last
    first = F.array(*[F.lit(None if r not in heads or heads[r]["nulls"] else heads[r]["head"]).cast("long") for r in range(len(cuts) + 1)])
    back = F.array(*[F.lit(before.get(r, 0)) for r in range(len(cuts) + 1)])
    is_head = F.col("doc_id").isNull() | F.coalesce(F.col("doc_id") == F.element_at(first, place + 1), F.lit(False))
    own = F.struct(place.cast("int").alias("_range"), F.lit(False).alias("_extra"))
    again = F.struct(F.element_at(back, place + 1).cast("int").alias("_range"), F.lit(True).alias("_extra"))
    sent = docs.select("doc_id", "text", F.explode(F.when(is_head, F.array(own, again)).otherwise(F.array(own))).alias("_t")).select("doc_id", "text", "_t._range", "_t._extra")
    return sent.repartitionById(parts, F.col("_range")).sortWithinPartitions("_range", "_extra", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``
    for every row, its text edited with the next document's."""
    schema = docs.select("doc_id").schema.add("n_chars", "long").add("edited_sha256", "string").add("fingerprint", "string").add("edited_fingerprint", "string").add("near_edited", "double").add("near_next", "double")

    def rows(kind: pa.DataType, ids: list, texts: list[str], own: np.ndarray, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
        edits = [edit(texts[i], texts[j]) for i, j in pairs]
        changed = sketch_texts(edits)
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in edits]
        return pa.record_batch([
            pa.array([ids[i] for i in a], kind), pa.array([len(texts[i]) for i in a], pa.int64()), pa.array(sums, pa.string()),
            pa.array(as_text(own[a]), pa.string()), pa.array(as_text(changed), pa.string()),
            pa.array(likeness(own[a], changed)), pa.array(likeness(own[a], own[b])),
        ], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A document's pair is the row after it in the same range; what may still want its
        successor is carried into the next piece."""
        held: tuple | None = None  # id, text, range, extra
        for batch in batches:
            whole = [x.to_pylist() for x in batch.columns]
            data, off = byte_rows(batch.column(1))
            for i, j, d, o in slices(data, off):
                ids, texts, ranges, extra = ([*([held[k]] if held else []), *whole[k][i:j]] for k in range(4))
                texts = [t or "" for t in texts]
                own = sketches(d, o)
                if held:
                    own = np.concatenate([held[4][None], own])
                pairs = [(k, k + 1) for k in range(len(ids) - 1) if not extra[k] and ranges[k] == ranges[k + 1]]
                if pairs:
                    yield rows(batch.schema.field(0).type, ids, texts, own, pairs)
                held = (ids[-1], texts[-1], ranges[-1], extra[-1], own[-1])

    return with_next(docs).mapInArrow(run, schema)
