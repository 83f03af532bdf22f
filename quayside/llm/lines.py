"""Dropping of lines that another document has, by range-partitioned line hashes.

1. A pass over the texts makes a row of every line long enough: the 128-bit hash of its key,
   document, line number. No text leaves its task here.
2. The hashes are dealt by ranges and sorted by hash, document and line number (``runs.mark_runs``; a
   line of very many documents spreads over ranges). In that order the first document of a run holds
   the line first; in every other document the line goes.
3. The lines that go become one compressed keep bitmap per document that loses any.
4. ``drop_lines`` joins bitmaps, not lines, to the texts.

A line's key is the line without white space at both ends, A-Z in lower case; keys of fewer than
``MIN_CHARS`` code points are never dropped. A null text counts as empty, an empty text has one empty line.
Rows of one id are one document, whatever their texts; rows without id are one document, after all
others. Repeated rows get the same result each. Other columns of the input are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import SPACE_BYTES, written
from quayside.llm.runs import mark_runs

MIN_CHARS = 10
#: So many recent rows are remembered in a task to leave out repeated ones early; the result does not
#: depend on it.
RECENT = 100_000
ROWS_OUT = 20_000


def line_key(line: bytes, least: int = MIN_CHARS) -> bytes | None:
    """The key of a line (UTF-8), None if it is too short to be dropped."""
    key = line.strip(SPACE_BYTES).lower()  # bytes.lower() changes A-Z only
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return key


def pack(keep: np.ndarray) -> bytes:
    """A keep bitmap, a bit a line, compressed."""
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``k1, k2, doc_id, text_key, n_lines, line`` of the lines with a key, from ``_keyed`` rows."""
    id_type = docs.schema["doc_id"].dataType
    out = T.StructType([T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("doc_id", id_type), *(T.StructField(c, T.LongType()) for c in ("text_key", "n_lines", "line"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: set = set()
        for b in batches:
            ids, keys = b.column("doc_id"), b.column("text_key").to_pylist()
            doc, hashes, n_lines, place = [], [], [], []

            def rows(doc=doc, hashes=hashes, n_lines=n_lines, place=place, ids=ids, keys=keys):
                k = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
                at = pa.array(doc, pa.int32())
                return pa.record_batch([pa.array(k[:, 0]), pa.array(k[:, 1]), ids.take(at), pa.array(keys, pa.int64()).take(at), pa.array(n_lines, pa.int64()), pa.array(place, pa.int64())], out.names)

            for i, text in enumerate(b.column("text")):
                row = (ids[i].as_py(), keys[i])
                if row in recent:
                    continue
                if len(recent) >= RECENT:
                    recent.clear()
                recent.add(row)
                lines = text.as_buffer().to_pybytes().split(b"\n")
                for j, line in enumerate(lines):
                    key = line_key(line, min_chars)
                    if key is not None:
                        doc.append(i)
                        hashes.append(xxhash.xxh3_128_digest(key))
                        n_lines.append(len(lines))
                        place.append(j)
                if len(doc) >= ROWS_OUT:
                    yield rows()
                    for part in (doc, hashes, n_lines, place):
                        part.clear()
            if doc:
                yield rows()

    return docs.mapInArrow(run, out)


def _bitmaps(keyed: DataFrame, min_chars: int) -> DataFrame:
    spark = keyed.sparkSession
    lines = written(spark, hashed_lines(keyed, min_chars), "line-hashes")
    runs = mark_runs(lines, "doc_id", F.asc_nulls_last("doc_id"), F.asc("text_key"), F.asc("line"), name="line-runs")
    gone = runs.filter(~F.col("doc_id").eqNullSafe(F.col("_lead")))
    gone = gone.groupBy("doc_id", "text_key").agg(F.max("n_lines").alias("n_lines"), F.collect_set("line").alias("lines"))
    out = T.StructType([keyed.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("text_key", "n_lines", "n_dropped")), T.StructField("keep", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maps, n_dropped = [], []
            for n, lines in zip(b.column("n_lines").to_pylist(), b.column("lines"), strict=True):
                keep = np.ones(n, bool)
                keep[np.asarray(lines.values)] = False
                maps.append(pack(keep))
                n_dropped.append(n - int(keep.sum()))
            yield pa.record_batch([b.column("doc_id"), b.column("text_key"), b.column("n_lines"), pa.array(n_dropped, pa.int64()), pa.array(maps, pa.binary())], out.names)

    return written(spark, gone.mapInArrow(run, out), "line-bitmaps")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_key, n_lines, n_dropped, keep`` of every document that loses a line: ``keep`` is its
    compressed keep bitmap (``unpack``), ``text_key`` the xxhash64 of its text."""
    return _bitmaps(_keyed(docs, id_col, text_col), min_chars)


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``, a row for every row of ``docs``: its text without the lines
    that go, the others joined by a line feed."""
    keyed = _keyed(docs, id_col, text_col)
    maps = _bitmaps(keyed, min_chars).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "n_dropped", "keep")
    both = keyed.join(maps.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    out = T.StructType([keyed.schema["doc_id"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, n, bitmap in zip(b.column("text"), b.column("n_dropped").to_pylist(), b.column("keep"), strict=True):
                raw = text.as_buffer().to_pybytes()
                n_lines.append(raw.count(b"\n") + 1)
                n_dropped.append(n or 0)
                if n:
                    lines = raw.split(b"\n")
                    raw = b"\n".join([lines[i] for i in np.flatnonzero(unpack(bitmap.as_py(), len(lines)))])
                texts.append(raw)
            yield pa.record_batch([b.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], out.names)

    return both.select("doc_id", "text", "n_dropped", "keep").mapInArrow(run, out)


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL = f"""
WITH l AS (
  SELECT doc_id, md5(coalesce(text, '')) AS t, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS j
  FROM (SELECT DISTINCT doc_id, text FROM documents)),
k AS (
  SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (
  SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key),
d AS (
  SELECT k.doc_id, t, j, line, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM first_id AS gone
  FROM k LEFT JOIN f ON f.key = k.key),
r AS (
  SELECT doc_id, t, count(*) AS n_lines, count_if(gone) AS n_dropped,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY j) FILTER (NOT gone), '')) AS kept_sha256
  FROM d GROUP BY doc_id, t)
SELECT x.doc_id, r.n_lines, CAST(r.n_dropped AS BIGINT) AS n_dropped, r.kept_sha256
FROM documents x JOIN r ON r.doc_id IS NOT DISTINCT FROM x.doc_id AND r.t = md5(coalesce(x.text, ''))
"""
