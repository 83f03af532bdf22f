import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quayside.llm import langid
from quayside.llm.common import table
from tests.conftest import SF_SMALL


def test_codewords_differ():
    for n in (2, 3, 4, 5, 12):
        m = langid.code_matrix(n)
        gap = min((m[i] != m[j]).sum() for i in range(n) for j in range(i))
        assert gap >= max(1, m.shape[1] // 4) and not (np.abs(m.sum(0)) == n).any()


def test_held_out_accuracy(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = langid.identify(docs).toPandas().set_index("doc_id")
    truth = docs.select("doc_id", "lang").toPandas().set_index("doc_id")["lang"]
    held = got[got["held_out"]]
    assert len(held) > 20 and (held["lang_pred"] == truth[held.index]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_undetermined_and_odd_rows(messy, no_docs):
    got = langid.identify(messy).toPandas()
    assert len(got) == messy.count()
    by = got.dropna(subset=["doc_id"]).drop_duplicates("doc_id").set_index("doc_id")
    for k in (50, 51, 52, 53):
        assert by.loc[k, "lang_pred"] == "und" and by.loc[k, "score"] == 0
    assert by.loc[57, "lang_pred"] in ("en", "fr") and by.loc[1, "lang_pred"] == "en" and by.loc[25, "lang_pred"] == "fr"
    kept = langid.kept(messy)
    assert kept.columns == messy.columns and kept.count() == len(got) - 4
    assert langid.identify(no_docs).count() == 0
    assert {r["lang_pred"] for r in langid.identify(messy.withColumn("lang", messy["lang"].substr(1, 0)).na.replace("", None, "lang")).collect()} == {"und"}


def test_kept_without_labels(spark, messy):
    """Without a label outside the held-out fold nothing is learned: rows with a letter stay as they are."""
    docs = messy.withColumn("lang", F.lit(None).cast("string"))
    some = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "en"))
    for df in (docs, some):
        want = [(r["doc_id"], r["text"], r["lang"]) for r in df.collect() if any(c.isalpha() for c in r["text"] or "")]
        got = [(r["doc_id"], r["text"], r["lang"]) for r in langid.kept(df).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == messy.count() - 4


def test_decoding_matches_the_plain_sums():
    """Loss-weighted decoding, written out bit by bit, and ambiguity: a lead below ``LEAD``."""
    rng = np.random.default_rng(3)
    langs = ["aa", "bb", "cc", "dd"]
    code = langid.code_matrix(4)
    bits = code.shape[1]
    trust = rng.uniform(0.5, 1.5, code.shape)
    trust /= trust.sum(1, keepdims=True)
    scale = rng.uniform(0.5, 2, bits)
    model = langid.CodeModel(langs, code, rng.normal(0, 1, (1 << langid.HASH_BITS, bits)).astype(np.float32), scale, trust)
    margins = rng.normal(0, 1, (50, bits))
    p = model.decode(margins)
    for row, got in zip(margins, p, strict=True):
        d = [-bits * sum(trust[k, b] * np.log1p(np.exp(-code[k, b] * row[b] * scale[b])) for b in range(bits)) for k in range(4)]
        want = np.exp(d) / np.exp(d).sum()
        assert np.allclose(got, want)
    texts = pa.array([f"some text {k} of {'xyz' * (k % 5)}" for k in range(60)] + ["", None, "123"])
    lang, score, unclear = model.label(texts)
    sure = model.decode(langid._margins(texts.slice(0, 60), model.weights))
    top = np.sort(sure, 1)
    assert lang[:60].tolist() == [langs[k] for k in sure.argmax(1)] and lang[60:].tolist() == ["und"] * 3
    assert np.allclose(score[:60], top[:, -1]) and unclear[60:].all()
    assert unclear[:60].tolist() == (top[:, -1] - top[:, -2] < langid.LEAD).tolist()
    flat = langid.CodeModel(langs, code, np.zeros_like(model.weights), scale, np.full(code.shape, 1 / bits))
    assert flat.label(texts)[2].all()  # no bit says anything: every text is ambiguous
