"""Packing documents into batches by optimal length buckets.

1. The exact histogram of all lengths. Different lengths add up to no more than the corpus has words,
   so there are at most about the square root of twice its words of them; they come to the driver
   as two columns of numbers.
2. Dynamic programming over the lengths chooses the ``n_buckets`` boundaries with the least
   padding when every document is padded to its bucket's longest. The cost of a bucket satisfies the
   quadrangle inequality, so the best boundary before a length never falls as lengths grow, and each step of the program is
   worked out by halving (middle lengths first, each between its neighbours' boundaries): n log n a bucket.
   Among equal costs the smallest boundary wins.
3. Inside a bucket, documents in the order of their id's md5 fill batches of as many rows as
   the token budget holds at the padded length (one, where a document exceeds the budget).
   Ranks are exact over the whole bucket: counts by md5 prefix give the offsets, so no task
   sorts more than about ``RANK_ROWS`` rows, even where one bucket holds most documents.

Nulls: a null text has length 0; a null id sorts first. Equal ids take neighbouring places.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import WORD, written

N_BUCKETS = 12
TOKEN_BUDGET = 16_384
RANK_ROWS = 10_000


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _step(best: np.ndarray, first: int, cost) -> tuple[np.ndarray, np.ndarray]:
    """One more bucket: for every j > ``first`` the least ``best[i] + cost(i, j)`` over first <= i < j, and the
    least i that gives it; all middles of a depth at once."""
    n = len(best)
    out, frm = np.full(n, np.iinfo(np.int64).max // 4), np.zeros(n, np.int64)
    lo, hi = np.array([first + 1]), np.array([n - 1])  # ranges of j still open, and of their i
    at, to = np.array([first]), np.array([n - 2])
    while len(lo):
        mid = (lo + hi) // 2
        end = np.minimum(to, mid - 1)
        size = end - at + 1
        begin = np.cumsum(size) - size
        i = np.arange(size.sum()) - np.repeat(begin, size) + np.repeat(at, size)
        value = best[i] + cost(i, np.repeat(mid, size))
        out[mid] = np.minimum.reduceat(value, begin)
        hit = np.flatnonzero(value == np.repeat(out[mid], size))
        frm[mid] = i[hit[np.searchsorted(hit, begin)]]
        parts = [(lo, mid - 1, at, frm[mid]), (mid + 1, hi, frm[mid], to)]
        lo, hi, at, to = (np.concatenate(c) for c in zip(*parts, strict=True))
        keep = lo <= hi
        lo, hi, at, to = lo[keep], hi[keep], at[keep], to[keep]
    return out, frm


def bucket_bounds(counts: np.ndarray, lengths: np.ndarray, n_buckets: int) -> list[int]:
    """Upper bounds of the buckets, ascending, from the counts of different lengths, ascending: the choice
    with the least total padding."""
    n = len(counts)
    if not n:
        return []
    lengths = np.asarray(lengths, np.int64)
    c, s = (np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in (counts, counts * lengths))
    cost = lambda i, j: lengths[j] * (c[j + 1] - c[i + 1]) - (s[j + 1] - s[i + 1])
    best = lengths * c[1:] - s[1:]  # one bucket for the lengths 0..j
    back = []
    for k in range(min(n_buckets, n) - 1):
        best, frm = _step(best, k, cost)
        back.append(frm)
    j, out = n - 1, []
    for frm in [*reversed(back), None]:
        out.append(int(lengths[j]))
        j = int(frm[j]) if frm is not None else j
    return out[::-1]


def pack(docs: DataFrame, n_buckets: int = N_BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """``doc_id, n_tokens, bucket, padded_length, batch``: one row per row of ``docs``; a
    batch is a (bucket, batch) pair."""
    spark = docs.sparkSession
    sized = written(spark, docs.select("doc_id", token_count(F.col("text")).alias("n_tokens")), "pack-lengths")
    histogram = sized.groupBy("n_tokens").count().orderBy("n_tokens").toArrow()
    lengths, counts = (histogram.column(c).to_numpy() for c in ("n_tokens", "count"))
    bounds = bucket_bounds(counts, lengths, n_buckets) or [0]
    spread = counts.sum() / RANK_ROWS
    digits = max(0, int(np.ceil(np.log(max(spread, 1)) / np.log(16))))

    sides = F.array(*[F.lit(b).cast("long") for b in bounds])
    bucket = F.size(F.filter(sides, lambda b: b < F.col("n_tokens")))
    rows = sized.withColumn("bucket", bucket).withColumn("padded_length", F.element_at(sides, F.col("bucket") + 1))
    key = F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit(""))
    rows = rows.withColumn("_key", key).withColumn("_part", F.substring("_key", 1, digits) if digits else F.lit(""))
    before = Window.partitionBy("bucket").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("bucket", "_part").count().withColumn("_offset", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    here = Window.partitionBy("bucket", "_part").orderBy("_key", "doc_id", "n_tokens")
    rows = rows.join(offsets, ["bucket", "_part"]).withColumn("_rank", F.col("_offset") + F.row_number().over(here) - 1)
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("padded_length"), F.lit(1))))
    return rows.select("doc_id", "n_tokens", "bucket", "padded_length", F.floor(F.col("_rank") / per_batch).cast("long").alias("batch"))


SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS n FROM documents),
h AS (SELECT n AS m, count(*) AS c, sum(n) AS s FROM d GROUP BY 1),
cells AS (SELECT row_number() OVER w AS j, m,
    CAST(sum(c) OVER w AS BIGINT) AS c, CAST(sum(s) OVER w AS BIGINT) AS s FROM h WINDOW w AS (ORDER BY m)),
dp AS (
  SELECT 1 AS k, j, {{'cost': m * c - s, 'i': CAST(0 AS BIGINT)}} AS b FROM cells
  UNION ALL
  SELECT k + 1, x.j, min({{'cost': dp.b.cost + x.m * (x.c - y.c) - (x.s - y.s), 'i': y.j}})
  FROM dp JOIN cells y ON y.j = dp.j JOIN cells x ON x.j > y.j
  WHERE k < least({N_BUCKETS}, (SELECT count(*) FROM cells)) AND y.j >= k GROUP BY 1, 2),
path AS (
  SELECT k, j, b.i AS i FROM dp WHERE k = (SELECT max(k) FROM dp) AND j = (SELECT max(j) FROM cells)
  UNION ALL
  SELECT dp.k, dp.j, dp.b.i FROM path JOIN dp ON dp.k = path.k - 1 AND dp.j = path.i),
bounds AS (SELECT k - 1 AS bucket, m AS padded_length FROM path JOIN cells USING (j)),
placed AS (
  SELECT doc_id, n, (SELECT count(*) FROM bounds WHERE padded_length < n) AS bucket FROM d)
SELECT doc_id, n AS n_tokens, CAST(p.bucket AS INTEGER) AS bucket, CAST(padded_length AS BIGINT) AS padded_length,
  CAST((row_number() OVER (PARTITION BY p.bucket ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1)
    // greatest(1, {TOKEN_BUDGET} // greatest(padded_length, 1)) AS BIGINT) AS batch
FROM placed p JOIN bounds b ON b.bucket = p.bucket
"""
