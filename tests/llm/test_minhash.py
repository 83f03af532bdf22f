import re
from collections import Counter, defaultdict

import numpy as np

from quayside.llm import minhash
from quayside.llm.common import table
from tests.conftest import SF_SMALL


def bags(docs):
    words = {i: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower()) for i, t in docs}
    return {i: Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else []) for i, w in words.items()}


def classes(docs):
    """Brute force over all pairs that share a shingle."""
    bag, by, up = bags(docs), defaultdict(list), {}
    for i, b in bag.items():
        up[i] = i
        for s in b:
            by[s].append(i)

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in {(min(a, b), max(a, b)) for x in by.values() for a in x for b in x if a != b}:
        both = sum((bag[i] & bag[j]).values())
        if both >= 0.8 * (sum(bag[i].values()) + sum(bag[j].values()) - both):
            a, b = sorted((find(i), find(j)))
            up[b] = a
    return {i: find(i) for i in up}


def test_classes_match_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert got == classes([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_hub_with_spread_copies(spark):
    """Copies near a hub but not near each other, several classes in shared buckets."""
    rng = np.random.default_rng(5)
    base = [f"b{k}" for k in range(120)]
    docs = []
    for k in range(60):
        w = list(base)
        for at in rng.choice(120, 1 + k % 9, replace=False):
            w[at] = f"x{rng.integers(10**6)}"
        docs.append((100 + k, " ".join(w)))
    docs += [(7, " ".join(base)), (400, " ".join(base[:60]) + " " + " ".join(f"q{k}" for k in range(60)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df).collect()} == classes(docs)


def test_odd_rows(messy, no_docs):
    got = minhash.near_duplicates(messy).collect()
    assert len(got) == messy.count()
    by = {r["doc_id"]: r["class_id"] for r in got}
    assert by[1] == by[55] == 1 and all(by[k] == k for k in (50, 51, 52, 53, 54, 56, 57, 58)) and by[None] is None
    kept = minhash.deduplicated(messy)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == messy.columns and sorted(x for x in ids if x) == sorted({c for c in by.values() if c}) and ids.count(None) == 1
    assert minhash.near_duplicates(no_docs).count() == 0 and minhash.deduplicated(no_docs).count() == 0


def test_texts_of_one_id_and_rows_without_id(spark):
    def text(name, change=0):
        return " ".join(f"{name}{k if k >= change else -k - 1}" for k in range(100))

    docs = [(1, text("a")), (1, text("b")), (2, text("b", 2)), (3, text("c")), (3, text("d")), (3, ""), (4, text("d", 3)), (4, text("e"))]
    docs += [(None, text("c", 2)), (None, text("f")), (None, text("f", 2)), (None, text("f")), (None, text("g"))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    kept = sorted((r["doc_id"] or 0, r["text"][:1]) for r in minhash.deduplicated(df).collect())
    assert kept == [(0, "f"), (0, "g"), (1, "a"), (1, "b"), (3, ""), (3, "c"), (3, "d"), (4, "e")]
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0) for r in minhash.near_duplicates(df).collect())
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 3), (3, 3), (3, 3), (4, 3), (4, 4), (0, 3), (0, 0), (0, 0), (0, 0), (0, 0)])


def test_signatures_are_unbiased_for_weights():
    rng = np.random.default_rng(0)
    diff = []
    for _ in range(60):
        h = minhash.mix64(rng.integers(1, 2**60, 200).astype(np.uint64))
        a = rng.integers(0, 40, 200)
        b = np.where(rng.random(200) < 0.6, a, rng.integers(0, 40, 200))
        row = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        s = minhash.bag_minhash(row, np.concatenate([h[a > 0], h[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 3)
        diff.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(diff)) < 4 * np.std(diff) / np.sqrt(len(diff)) and np.std(diff) < 0.08


def test_blocks_join_all_linked_roots():
    rng = np.random.default_rng(6)
    full = np.sort(rng.choice(2**31, 100, replace=False).astype(np.uint32))
    near, far = np.sort(np.append(full[:95], [5, 6, 7])).astype(np.uint32), np.sort(rng.choice(2**31, 100).astype(np.uint32))
    sig = np.arange(minhash.REGISTERS, dtype=np.uint32)
    rows = [(p, i, r, (sig + (i == 3)).astype(np.uint32).tobytes(), b.tobytes()) for i, r, b in ((1, 1, full), (2, 2, near), (3, 3, far)) for p in (False, True)]
    assert [tuple(sorted(x)) for x in minhash.links_between(rows, {})] == [(1, 2)]
