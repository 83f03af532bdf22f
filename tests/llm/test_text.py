import re

import numpy as np
import pyarrow as pa

from quayside.llm.common import byte_rows, row_sums, slices, span_hashes, word_spans


def test_words_and_hashes_match_plain_python():
    texts = ["a bb  ccc\n", None, "", "bb\tΩmega a", " x", "y"]
    data, off = byte_rows(pa.array(texts))
    starts, ends, counts = word_spans(data, off)
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    words = [data[s:e].tobytes().decode() for s, e in zip(starts, ends, strict=True)]
    assert words == [w for ws in want for w in ws]
    h = span_hashes(data, starts, ends)
    by = {}
    for w, x in zip(words, h.tolist(), strict=True):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)


def test_slices_cover_all_rows_and_keep_long_texts_whole():
    data, off = byte_rows(pa.array(["a" * 50, "b" * 500, "", "c" * 10]))
    parts = list(slices(data, off, 100))
    assert [(i, j) for i, j, _, _ in parts][0] == (0, 1) and parts[-1][1] == 4
    assert b"".join(d.tobytes() for _, _, d, _ in parts) == data.tobytes()
    sliced = byte_rows(pa.array(["zz", "ab", "c"]).slice(1))
    assert sliced[0].tobytes() == b"abc" and sliced[1].tolist() == [0, 2, 3]


def test_row_sums_of_empty_runs():
    assert row_sums(np.array([1, 2, 3]), np.array([0, 2, 0, 1, 0])).tolist() == [0, 3, 0, 3, 0]
