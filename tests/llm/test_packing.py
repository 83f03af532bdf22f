from itertools import combinations

import duckdb
import numpy as np
import pytest

from quayside.llm import packing
from quayside.llm.common import table
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_optimal(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(200, 9, replace=False)) + 1
    counts, k = rng.integers(1, 30, 9), 3
    got = packing.bucket_bounds(counts, lengths, k)

    def padding(bounds):
        return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts, strict=True))

    least = min(padding([*c, lengths[-1]]) for c in combinations(lengths[:-1], k - 1))
    assert len(got) == k and got[-1] == lengths[-1] and padding(got) == least


def plain_program(counts, lengths, k):
    """The program over all pairs; among equal costs the smallest boundary."""
    n = len(counts)
    pad = lambda i, j: sum(int(c) * int(lengths[j] - x) for c, x in zip(counts[i : j + 1], lengths[i : j + 1], strict=True))
    cost = [[pad(i, j) if i <= j else 0 for j in range(n)] for i in range(n)]
    best, back = [cost[0][j] for j in range(n)], []
    for b in range(min(k, n) - 1):
        step = [min(((best[i] + cost[i + 1][j], i) for i in range(b, j)), default=(1 << 60, 0)) if j > b else (1 << 60, 0) for j in range(n)]
        best, back = [x for x, _ in step], [*back, [i for _, i in step]]
    j, out = n - 1, []
    for frm in [*reversed(back), None]:
        out.append(int(lengths[j]))
        j = frm[j] if frm else j
    return out[::-1]


@pytest.mark.parametrize("seed", range(8))
def test_halving_equals_the_plain_program(seed):
    """Lengths in the thousands, as few as buckets and with many equal costs too."""
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 70))
    lengths = np.sort(rng.choice(20_000, n, replace=False)) if seed % 2 else np.arange(n) * 7
    counts = rng.integers(1, 30, n) if seed % 4 else np.ones(n, np.int64)
    for k in (1, 2, 5, 12):
        assert packing.bucket_bounds(counts, lengths, k) == plain_program(counts, lengths, k)


def test_many_long_lengths():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(rng.lognormal(8, 1, 300_000).astype(np.int64), return_counts=True)
    bounds = packing.bucket_bounds(counts, lengths, 12)
    assert len(bounds) == 12 and bounds[-1] == lengths[-1] and bounds == sorted(set(bounds))


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = con.execute(packing.SQL).df()
    got = packing.pack(table(spark, SF_SMALL, "documents")).toPandas()[list(want.columns)]
    a, b = (x.sort_values("doc_id").reset_index(drop=True) for x in (got, want))
    assert (a == b).all().all()


def test_batches_keep_the_budget_and_all_rows(messy, no_docs, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 10)
    got = packing.pack(messy, n_buckets=4, budget=300).toPandas()
    assert len(got) == messy.count() and (got["padded_length"] >= got["n_tokens"]).all()
    size = got.groupby(["bucket", "batch"]).agg(n=("n_tokens", "size"), length=("padded_length", "first"))
    assert ((size["n"] * size["length"] <= 300) | (size["n"] == 1)).all()
    full = size.groupby("bucket")["n"].agg(lambda x: (x.iloc[:-1] == x.max()).all())
    assert full.all()
    assert packing.pack(no_docs).count() == 0
