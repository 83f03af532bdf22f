import duckdb
import numpy as np
from pyspark.sql import functions as F

from quayside.llm import negatives
from quayside.llm.common import table
from quayside.llm.queries import op13_hard_negatives
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, every=50):
    """Rows of (vec_id, label, vector), by looking at every pair."""
    good = {}
    for i, label, v in sorted((r for r in rows if r[0] is not None and r[1] is not None and r[2]), key=lambda r: r[0]):
        if all(x is not None and np.isfinite(x * 256) for x in v):
            x = [float(np.clip(np.floor(np.float64(c) * 256), -1e150, 1e150)) for c in v]
            good[i] = min(good.get(i, (label, x)), (label, x))
    out = set()
    for a, (la, va) in good.items():
        if a % every:
            continue
        others = [(int(np.clip(np.dot(va, v), -(2.0**53), 2.0**53)), i, label) for i, (label, v) in good.items() if i != a and len(v) == len(va)]
        for p, pid, _ in sorted((r for r in others if r[2] == la), key=lambda r: (-r[0], r[1]))[:5]:
            fit = [r for r in others if r[2] != la and 50 * p <= 100 * r[0] <= 95 * p]
            out |= {(a, pid, k + 1, i, p, s) for k, (s, i, _) in enumerate(sorted(fit, key=lambda r: (-r[0], r[1]))[:3])}
    return out


def got(df):
    rows = [tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 50 == 0).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def clustered(rng, n, dims=12, labels=4):
    centre = rng.normal(0, 2, (labels * 2, dims))
    return [(i, int(i % labels), (centre[(i * 7 + i // 9) % len(centre)] + rng.normal(0, 0.3, dims)).tolist()) for i in range(n)]


def test_clusters_in_many_blocks(spark, monkeypatch):
    """Small blocks, groups and units, so that zones rule blocks out and parts are merged."""
    for name, value in (("BLOCK", 16), ("GROUP", 7), ("BLOCKS_PER_UNIT", 4)):
        monkeypatch.setattr(negatives, name, value)
    rows = clustered(np.random.default_rng(1), 1500)
    want = brute(rows)
    assert len(want) > 100 and got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == want


def test_zones_rule_blocks_out(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 16)
    rows = clustered(np.random.default_rng(4), 1500)
    kept = negatives.written(spark, negatives.usable(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0), "t")
    blocks = negatives.blocks_of(negatives.keyed(kept, negatives._moments(kept)), 8)
    groups = negatives.groups_of(blocks, 30)
    zones = negatives.range_zones(blocks)
    n_blocks, n_groups = blocks.filter("not anchor").count(), groups.count()
    assert sum(r["n"] for r in blocks.filter("not anchor").select("n").collect()) == 1500
    assert negatives.chosen_blocks(groups, blocks, zones).count() < 0.8 * n_blocks * n_groups


def test_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 3)), (rng.integers(-2, 3, 4) / 256).tolist()) for i in range(-150, 200)]
    rows += [(300, 1, None), (350, None, [1.0] * 4), (400, 1, [1.0, None, 0.0, 0.0]), (450, 1, [float("nan")] * 4), (500, 1, [float("inf"), 0.0, 0.0, 0.0]), (None, 1, [1.0] * 4), (550, 1, [])]
    rows += [(600 + i, i % 2, [float(i % 5), 1.0]) for i in range(0, 100, 10)]  # another length
    rows += [(100, 2, [0.5] * 4), (100, 0, [0.25] * 4), (7, 1, rows[157][2])]  # repeated ids
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("v", "d", "key", "block", "anchor", "rank", "score", "g", "range")})
    assert got(df.repartition(4)) == brute(rows)
    assert got(spark.createDataFrame([], SCHEMA)) == set() == got(spark.createDataFrame([(1, 1, [1.0])], SCHEMA))
    assert got(spark.createDataFrame([(0, 1, [1.0])], SCHEMA)) == set()


def test_very_large_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 2, (rng.normal(0, 1, 3) * 10.0 ** rng.integers(0, 300)).tolist()) for i in range(200)]
    rows += [(1000 + i, i % 2, [1e12, 1e12 + i, 1.0]) for i in range(0, 100, 5)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_one_label_of_most_rows_and_one_vector_of_many(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 32)
    rng = np.random.default_rng(5)
    rows = [(i, 0 if i % 3 else 1 + i % 5, (rng.normal(0, 1, 6) if i % 4 else np.ones(6)).tolist()) for i in range(800)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows)


def test_hilbert_curve():
    """Every cell once, and neighbours on the curve are neighbours in the grid."""
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = negatives.hilbert(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(6)
    x, a = np.floor(rng.normal(0, 200, (50, 9))), np.floor(rng.normal(0, 200, (20, 9)))
    s, lo, hi = a @ x.T, x.min(0)[None], x.max(0)[None]
    assert (negatives.upper(a, lo, hi)[:, 0] >= s.max(1)).all() and (negatives.lower(a, lo, hi)[:, 0] <= s.min(1)).all()
    p = np.arange(-300, 300)
    least, most = negatives.window(p)
    assert all({s for s in range(-400, 400) if 50 * q <= 100 * s <= 95 * q} == set(range(int(u), int(v) + 1)) for q, u, v in zip(p.tolist(), least, most, strict=True))


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    rows = [tuple(r) for r in op13_hard_negatives(spark, SF_SMALL).collect()]
    assert set(con.execute(negatives.SQL).fetchall()) == set(rows) and len(rows) == len(set(rows))
    noisy = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], list(r["embedding"])) for r in table(spark, SF_SMALL, "embeddings").collect()]
    assert set(rows) == brute(noisy)
