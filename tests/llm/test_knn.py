import duckdb
import numpy as np
from pyspark.sql import functions as F

from quayside.llm import knn
from quayside.llm.common import table
from tests.conftest import SF_SMALL


def brute(rows, k=5, every=50):
    good = [(i, np.clip(np.floor(np.array(v, dtype=np.float64) * 256), -1e150, 1e150)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x * 256) for x in v)]
    out = set()
    for q in {i for i, _ in good if i % every == 0}:
        scores = {}
        for x in (v for i, v in good if i == q):
            for i, v in good:
                if i != q and len(v) == len(x):
                    scores[i] = max(scores.get(i, -1 << 63), int(np.clip(x @ v, -(2.0**53), 2.0**53)))
        best = sorted((-s, i) for i, s in scores.items())[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def got(df, **options):
    return [tuple(r) for r in knn.top_k(df, F.col("vec_id") % 50 == 0, **options).collect()]


def test_matches_brute_force_and_sql(spark):
    df = table(spark, SF_SMALL, "embeddings")
    rows = got(df)
    assert len(set(rows)) == len(rows) and set(rows) == brute([(r["vec_id"], r["embedding"]) for r in df.collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    assert set(con.execute(knn.SQL).fetchall()) == set(rows)


def test_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 256]) for i in range(-100, 160)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (250, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (203, [1.0] * 3), (204, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("v", "cell", "rank", "score", "is_query")})
    rows += [(300 + i, [float(x) for x in rng.integers(-2, 3, 3) / 256]) for i in range(0, 120, 10)]  # queries of another length
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("v", "cell", "rank", "score", "is_query")})
    want = brute(rows)
    assert set(got(df)) == want and {300, 350, 400} <= {r[0] for r in want}
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    assert set(con.execute(knn.SQL).fetchall()) == want
    few = spark.createDataFrame(rows[100:103], "vec_id long, embedding array<float>")
    assert set(got(few)) == brute(rows[100:103])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert got(empty) == [] and got(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")) == []


def test_very_large_components(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(0, 1, 3) * 10.0 ** rng.integers(0, 300)).tolist()) for i in range(150)]
    rows += [(1000 + i, [1e12, 1e12 + i, 1.0]) for i in range(0, 100, 5)] + [(2000, [1.7e308, 0.0, 0.0])]
    assert set(got(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))) == brute(rows)


def test_blocks_of_queries_and_clusters(spark, monkeypatch):
    monkeypatch.setattr(knn, "QUERY_BLOCK", 3)
    monkeypatch.setattr(knn, "QUERIES_PER_GROUP", 2)
    monkeypatch.setattr(knn, "DATA_BLOCK", 16)
    rng = np.random.default_rng(2)
    centre = rng.normal(0, 3, (6, 8))
    rows = [(i, (centre[i % 6] + rng.normal(0, 0.05, 8)).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert set(got(df, n_pivots=8)) == brute(rows)


def test_repeated_ids(spark, monkeypatch):
    """Ids of ten rows each, of equal and of different vectors, around a query of 100 rows."""
    monkeypatch.setattr(knn, "QUERIES_PER_GROUP", 2)
    rng = np.random.default_rng(3)
    rows = [(0, [1.0] * 8)] * 100 + [(1, rng.normal(0, 0.1, 8).tolist())]
    for i in range(4, 160, 4):
        v = 1.2 - i / 200 + rng.normal(0, 0.02, 8)
        rows += [(i, (v + (k / 100 if i % 8 else 0)).round(3).tolist()) for k in range(10)]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    want = set(con.execute(knn.SQL).fetchall())
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    assert len(want) == 10 and set(got(df, n_pivots=4)) == want and set(got(df, n_pivots=64)) == want
