import hashlib
import random

import numpy as np
import pyarrow as pa

from quayside.llm import fingerprints as f
from quayside.llm.common import byte_rows
from tests.llm.conftest import rows


def test_pairs_match_brute_force(messy):
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in f.fingerprint_pairs(messy).collect()))
    docs = sorted(((r[0] is not None, r[0] or 0, r[1] or "") for r in rows()))
    want = []
    for k, (some, i, text) in enumerate(docs):
        nxt = docs[(k + 1) % len(docs)][2]
        half = len(text) // 2
        want.append((some, i, len(text), hashlib.sha256((text[: len(text) - half] + nxt[:half]).encode()).hexdigest()))
    assert got == sorted(want)


def test_fingerprints_follow_content(messy, no_docs):
    got = f.fingerprint_pairs(messy).toPandas()
    same = got[got["doc_id"].isin([1, 55])]
    assert same["fingerprint"].nunique() == 1
    assert ((got["near_edited"] >= 0) & (got["near_edited"] <= 1) & (got["near_next"] >= 0) & (got["near_next"] <= 1)).all()
    assert (got["fingerprint"].str.len() == 4 * f.SLOTS).all()
    assert f.fingerprint_pairs(no_docs).count() == 0


def test_equal_substrings_share_interior_names():
    rng = np.random.default_rng(3)
    inner = rng.integers(97, 123, 4000).astype(np.uint8)
    names = []
    for shift in (0, 1, 7, 123):
        s = np.concatenate([rng.integers(97, 123, shift).astype(np.uint8), inner, rng.integers(97, 123, 50).astype(np.uint8)])
        for _ in range(3):
            s, _ = f.parse_level(s, np.array([0, len(s)]))
        names.append(set(s.tolist()))
    assert all(len(names[0] & n) / len(names[0]) > 0.9 for n in names)


def test_likeness_of_halves_and_runs():
    rng = np.random.default_rng(4)
    a, b, c = ("".join(map(chr, rng.integers(97, 123, 3000))) for _ in range(3))
    s = f.sketch_texts([a + b, a + c, c + c[::-1], "", "", "a" * 100_000, "z"])
    assert 0.35 < f.likeness(s[:1], s[1:2])[0] < 0.65
    assert f.likeness(s[:1], s[2:3])[0] < 0.1 and f.likeness(s[3:4], s[4:5])[0] == 1
    assert len(f.as_text(s)) == 7
    assert pa.array(f.as_text(s)).null_count == 0


def phrase_names(text):
    """The names of all phrases of a text, from ``FIRST_LEVEL`` on, as a set."""
    data, off = byte_rows(pa.array([text]))
    out, level = set(), 0
    while len(data):
        data, off = f.parse_level(data, off)
        level += 1
        if level >= f.FIRST_LEVEL:
            out |= set(data.tolist())
        if len(data) <= 1:
            break
    return out


def test_likeness_is_that_of_the_phrase_sets():
    """Sketches against the exact 2J / (1 + J) of the sets of phrase names, for texts sharing parts at any offset."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    errors = []
    for share in [0, 0.1, 0.3, 0.5, 0.7, 0.9, 1] * 6:
        common = some(int(600 * share) + 1)
        a, b = some(int(300 * (1 - share))) + " " + common, common + " " + some(int(400 * (1 - share)))
        x, y = phrase_names(a), phrase_names(b)
        j = len(x & y) / len(x | y)
        s = f.sketch_texts([a, b])
        errors.append(float(f.likeness(s[:1], s[1:])[0]) - 2 * j / (1 + j))
    assert np.abs(errors).mean() < 0.06 and np.abs(errors).max() < 0.25 and abs(np.mean(errors)) < 0.04
