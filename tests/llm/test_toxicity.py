import numpy as np

from quayside.llm import toxicity


def labelled(spark, n=120):
    bad = ["vile", "rotten", "beastly"]
    docs, labels = [], []
    for k in range(n):
        words = [f"w{(k * 31 + j * 17) % 60}" for j in range(30)]
        toxic = k % 3 == 0
        if toxic:
            words[5:5] = [bad[k % 3]] if k % 2 else [*bad, *bad]
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_words_are_learned_and_graded(spark):
    docs, labels = labelled(spark)
    more = spark.createDataFrame([(900, "w1 w2 vile rotten beastly vile w3"), (901, "w1 w2 w3"), (902, None), (903, ""), (904, "vile " * 50)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs.union(more), labels.union(spark.createDataFrame([(None, 1), (5, None), (7, 0), (7, 0)], labels.schema))).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert all(got[k]["toxic"] == bool(t) for k, t in truth.items())
    assert got[900]["toxic"] and not got[901]["toxic"] and not got[902]["toxic"] and got[903]["grade"] == 0
    assert 0 <= got[901]["expected_severity"] < got[900]["expected_severity"] <= got[904]["expected_severity"] <= 2


def test_without_labels_nothing_is_toxic(spark, messy, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(messy, none).collect()
    assert len(got) == messy.count() and not any(r["toxic"] for r in got) and {r["grade"] for r in got} == {0}
    assert toxicity.toxicity(no_docs, none).count() == 0


def test_cumulative_links_recover_weights_and_order():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (4000, 3))
    w, theta = np.array([2.0, -1.0, 0.0]), np.array([-0.5, 1.5])
    z = x @ w + rng.logistic(0, 1, 4000)
    y = (z[:, None] > theta).sum(1)
    got_w, got_theta = toxicity.fit_ordinal(x, y, np.ones(4000), steps=800)
    assert np.allclose(got_w, w, atol=0.25) and np.allclose(got_theta, theta, atol=0.25)
