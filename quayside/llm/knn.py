"""Exact top-k search by a Voronoi join.

Vectors are grouped by their nearest pivot (a bounded, repeatable sample of ``PIVOTS`` vectors). Scores are
inner products, so bounds come from the Cauchy-Schwarz inequality: for a query q within r of pivot p
and any vector x, q.x lies within r|x| of p.x.

1. Queries are grouped by the nearest of the first pivots, data by the nearest of all.
   Summaries: every data cell reports its radius and, of ``k + 1`` different ids, the members nearest
   to the pivot; every query group its radius. All are bounded by the number of pivots.
2. For a query group, the summaries' members give a floor under its k-th best score: the
   (k + 1)-th greatest of p.x - r|x| over different ids (one more, as a query may meet its own id).
3. A vector x is replicated to a query group only if p.x + r|x| reaches the group's floor; the
   same bound over a whole cell, p.pj + |p| rj + r(|pj| + rj), first rules out whole cells.
4. Locally, a block of queries meets the vectors sent to its group in blocks, keeping the k best ids of
   each query, an id by its best row; partial results of a group's salts are merged by rank.

Result: for each query its ``k`` highest integer scores over ``floor(256 * x)`` vectors, the query's own row
left out, ties to the smaller id. A query is answered within the vectors of its own length, one search a
length. Vectors that are null or empty, or hold a null or non-finite component (also once scaled), take no part, nor do null
ids. Scores are exact below 2 ** 53 and held there beyond it. Repeated ids are rows of their own, except that a query has
one result per id and skips all rows of its own id.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import EXACT, LARGEST, held_score, mix64, sampled, whole_vector, written

K = 5
SCALE = 256
PIVOTS = 48
#: Queries are grouped by as many of the pivots as gives groups of about this many, 4 at least: without
#: clusters in the data every vector goes to every group.
QUERIES_PER_GROUP = 128
QUERY_BLOCK = 4_096
DATA_BLOCK = 1_024
#: Pivots at most, as their summaries are collected.
MAX_PIVOTS = 1_024
#: The data of a query group are dealt over so many tasks at least, and over more from this many rows each on.
SALTS = 4
ROWS_PER_SALT = 1 << 18
_ID = "vec_id"


def _matrix(col: pa.Array, n: int) -> np.ndarray:
    return np.asarray(col.flatten()).reshape(n, -1) if n else np.zeros((0, 0))


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot, distance to it) of every row."""
    d2 = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None]
    cell = d2.argmin(1)
    return cell, np.sqrt(np.maximum(((x - pivots[cell]) ** 2).sum(1), 0))


def _nearest_ids(dist: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """The places of the ``n`` ids of least distance, an id by its nearest row."""
    order = np.argsort(dist, kind="stable")
    return order[np.sort(np.unique(ids[order], return_index=True)[1])[:n]]


def _best_per_id(score: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) with one column per id, its greatest score."""
    order = np.argsort(ids, kind="stable")
    begin = np.flatnonzero(np.append(True, np.diff(ids[order]) != 0))
    if len(begin) == len(ids):
        return score, ids
    return np.maximum.reduceat(score[:, order], begin, axis=1), ids[order][begin]


_FOUND = "query_id long, rank int, vec_id long, score long"


def top_k(vectors: DataFrame, is_query: Column, k: int = K, n_pivots: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows where ``is_query`` holds, against all rows of their
    vectors' length. ``n_pivots`` grows with the number of vectors by default."""
    spark = vectors.sparkSession
    v, usable = whole_vector("embedding", SCALE)
    rows = vectors.filter(F.col(_ID).isNotNull() & usable).select(_ID, v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = written(spark, rows, "knn-vectors")
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.count_if("is_query").alias("queries")).filter("queries > 0").orderBy("d").collect()
    found = [_search(rows.filter(F.size("v") == r["d"]), r["n"], r["queries"], k, n_pivots) for r in lengths]
    return functools.reduce(DataFrame.unionAll, found, spark.createDataFrame([], _FOUND)) if len(found) != 1 else found[0]


def _search(rows: DataFrame, n_rows: int, n_queries: int, k: int, n_pivots: int | None) -> DataFrame:
    """The search within vectors of one length."""
    spark = rows.sparkSession
    schema = _FOUND
    n_pivots = n_pivots or min(MAX_PIVOTS, max(PIVOTS, math.isqrt(n_rows) // 8))
    salts = max(SALTS, n_rows // ROWS_PER_SALT)
    few = sorted(sampled(rows, _ID, "v", 4 * n_pivots, 9).collect(), key=lambda r: mix64(np.array([r[_ID]]).astype(np.uint64))[0])
    pivots = np.array([r["v"] for r in few[:n_pivots] or rows.limit(1).collect()])
    pivots = pivots[np.sort(np.unique(pivots, axis=0, return_index=True)[1])]
    centres = pivots[: max(4, n_queries // QUERIES_PER_GROUP)]

    member = pa.list_(pa.struct([("id", pa.int64()), ("v", pa.list_(pa.float64()))]))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per cell: the radius of its queries and of its data and the members nearest to the pivot."""
        rq, rd, near = np.full(len(pivots), -1.0), np.full(len(pivots), -1.0), [[] for _ in pivots]
        for b in batches:
            x, q, ids = _matrix(b.column(1), b.num_rows), np.asarray(b.column(2)), np.asarray(b.column(0))
            if not len(x):
                continue
            cell, dist = _nearest(x, pivots)
            np.maximum.at(rd, cell, dist)
            if q.any():
                np.maximum.at(rq, *_nearest(x[q], centres))
            for c in np.unique(cell):
                own = np.flatnonzero(cell == c)
                own = own[_nearest_ids(dist[own], ids[own], k + 1)]
                both = [*near[c], *((dist[i], int(ids[i]), x[i].tolist()) for i in own)]
                near[c] = [both[i] for i in _nearest_ids(np.array([m[0] for m in both]), np.array([m[1] for m in both]), k + 1)]
        at = [c for c in range(len(pivots)) if max(rd[c], rq[c]) >= 0]
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(rq[at]), pa.array(rd[at]), pa.array([[{"id": i, "v": v} for _, i, v in near[c]] for c in at], member)], ["cell", "rq", "rd", "near"])

    parts = rows.mapInArrow(summarise, "cell int, rq double, rd double, near array<struct<id: long, v: array<double>>>")
    # merged a cell at a time: the radii are maxima, of the members the nearest of k + 1 ids remain
    dist = lambda v, p: F.aggregate(F.zip_with(v, p, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, t: s + t)
    places = spark.createDataFrame([(c, p.tolist()) for c, p in enumerate(pivots)], "cell int, p array<double>")
    radii = {r["cell"]: r for r in parts.groupBy("cell").agg(F.max("rq").alias("rq"), F.max("rd").alias("rd")).collect()}
    members = parts.select("cell", F.explode("near").alias("m")).join(F.broadcast(places), "cell")
    members = members.groupBy("cell", F.col("m.id").alias("id")).agg(F.min(F.struct(dist(F.col("m.v"), F.col("p")).alias("far"), F.col("m.v").alias("v"))).alias("m"))
    members = members.withColumn("place", F.row_number().over(Window.partitionBy("cell").orderBy("m.far", "id"))).filter(F.col("place") <= k + 1)
    members = members.select("id", "m.v").collect()
    sample, sample_ids = np.array([r["v"] for r in members]), np.array([r["id"] for r in members])

    groups = np.array(sorted(c for c, r in radii.items() if r["rq"] >= 0))
    if not len(groups):
        return spark.createDataFrame([], schema)
    rq = np.array([radii[c]["rq"] for c in groups])
    lows = np.sort(_best_per_id(centres[groups] @ sample.T - rq[:, None] * np.linalg.norm(sample, axis=1)[None], sample_ids)[0], axis=1)
    floor = held_score(lows[:, -(k + 1)]) if lows.shape[1] > k else np.full(len(groups), -np.inf)
    floor = floor - 1e-6 * (1 + np.abs(floor))  # rounding never rules a vector out
    norm = np.linalg.norm(pivots, axis=1)
    rd = np.array([radii[c]["rd"] if c in radii else 0.0 for c in range(len(pivots))])
    reach = centres[groups] @ pivots.T + norm[groups][:, None] * rd[None] + rq[:, None] * (norm + rd)[None]
    open_cells = held_score(reach) >= floor[:, None]  # group x cell

    counts = {r["cell"]: r["n"] for r in _grouped(rows, centres).groupBy("cell").agg(F.count("*").alias("n")).collect()}
    blocks = np.array([max(1, -(-counts.get(int(c), 0) // QUERY_BLOCK)) for c in groups])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A vector to every query group it may matter to (once for each block of its queries); a
        query to its own group and block."""
        for b in batches:
            x, q, ids = _matrix(b.column(1), b.num_rows), np.asarray(b.column(2)), np.asarray(b.column(0))
            if not len(x):
                continue
            cell, _ = _nearest(x, pivots)
            may = open_cells[:, cell] & (held_score(centres[groups] @ x.T + rq[:, None] * np.linalg.norm(x, axis=1)[None]) >= floor[:, None])
            g, i = np.nonzero(may)
            n = blocks[g]
            g, i, part = np.repeat(g, n), np.repeat(i, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            qi = np.flatnonzero(q)
            qg = np.searchsorted(groups, _nearest(x[qi], centres)[0]) if len(qi) else qi
            g, i, part = np.concatenate([qg, g]), np.concatenate([qi, i]), np.concatenate([(mix64(ids[qi].astype(np.uint64)) % blocks[qg].astype(np.uint64)).astype(np.int64), part])
            kind = np.repeat([0, 1], [len(qi), len(g) - len(qi)])
            for a in range(0, len(g), 20_000):
                t = slice(a, a + 20_000)
                yield pa.record_batch([pa.array(g[t], pa.int32()), pa.array(part[t], pa.int32()), pa.array((mix64(ids[i[t]].astype(np.uint64)) % np.uint64(salts)).astype(np.int32)), pa.array(kind[t], pa.int32()), pa.array(ids[i[t]], pa.int64()), b.column(1).take(pa.array(i[t]))], ["g", "part", "salt", "kind", "id", "v"])

    sent = rows.mapInArrow(send, "g int, part int, salt int, kind int, id long, v array<double>")
    # a query goes to every salt of its block; the data of a group are dealt over the salts
    sent = sent.withColumn("salt", F.explode(F.when(F.col("kind") == 0, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array("salt"))))
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = sent.repartition(shuffle, "g", "part", "salt").sortWithinPartitions("g", "part", "salt", "kind")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, qs, qv, best = None, [], [], None

        def done():
            if best is None:
                return
            s, v = best
            got = [(q, int(b), int(a)) for q, x, y in zip(qs, s, v, strict=True) for a, b in zip(x, y, strict=True) if np.isfinite(a)]
            yield pa.record_batch([pa.array([r[c] for r in got], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"])

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            keys = np.stack([np.asarray(b.column(c)) for c in range(3)], 1)
            kind, ids, x = np.asarray(b.column(3)), np.asarray(b.column(4)), _matrix(b.column(5), n)
            cuts = np.flatnonzero(np.any(np.diff(keys, axis=0), axis=1) | (np.diff(kind) != 0)) + 1
            for i, j in zip([0, *cuts], [*cuts, n], strict=True):
                if key != tuple(keys[i]):
                    yield from done()
                    key, qs, qv, best = tuple(keys[i]), [], [], None
                if kind[i] == 0:
                    qs += ids[i:j].tolist()
                    qv.append(x[i:j])
                    continue
                if not qs:
                    continue
                if best is None:
                    queries, own = np.concatenate(qv), np.array(qs)
                    best = np.full((len(qs), k), -np.inf), np.full((len(qs), k), np.iinfo(np.int64).max)
                for a in range(i, j, DATA_BLOCK):
                    c = slice(a, min(a + DATA_BLOCK, j))
                    score, block = _best_per_id(held_score(queries @ x[c].T), ids[c])
                    score[own[:, None] == block[None]] = -np.inf
                    # whoever reaches the k-th best id of this block or before, ties included
                    kth = np.partition(score, -min(k, score.shape[1]), axis=1)[:, -min(k, score.shape[1])]
                    for r in np.flatnonzero(score.max(1) >= best[0][:, -1]):
                        few = np.flatnonzero((score[r] >= max(kth[r], best[0][r, -1])) & np.isfinite(score[r]))
                        s, v = np.concatenate([best[0][r], score[r][few]]), np.concatenate([best[1][r], block[few]])
                        order = np.lexsort((v, -s))
                        s, v = s[order], v[order]
                        once = ~np.isfinite(s)  # places not taken yet
                        once[np.unique(v, return_index=True)[1]] = True
                        best[0][r], best[1][r] = s[once][:k], v[once][:k]
        yield from done()

    found = sent.mapInArrow(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _grouped(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """The group of every query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(0), b.num_rows)
            yield pa.record_batch([pa.array(_nearest(x, centres)[0] if len(x) else [], pa.int32())], ["cell"])

    return rows.filter("is_query").select("v").mapInArrow(run, "cell int")


SQL = f"""
WITH t AS (
  SELECT vec_id, list_transform(embedding, lambda x: greatest(least(floor(CAST(x AS DOUBLE) * {SCALE}), {LARGEST!r}), {-LARGEST!r})) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE) * {SCALE}))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(max(greatest(least(list_dot_product(q.v, d.v), {EXACT!r}), {-EXACT!r})) AS BIGINT) AS score
  FROM t q JOIN t d ON d.vec_id <> q.vec_id AND len(d.v) = len(q.v) WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= {K}
"""
