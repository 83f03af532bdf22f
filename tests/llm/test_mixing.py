import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import mixing
from quayside.llm.common import table
from tests.conftest import SF_SMALL


def water_fill(sizes):
    """Targets by raising the level until no source may take more; sources in code-point order, null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while True:
        full = {s for s in open_ if left * weight[s] / max(1e-9, sum(weight[x] for x in open_)) >= 2 * sizes[s]}
        if not full:
            break
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
        if not open_:
            break
    for s in open_:
        out[s] = left * weight[s] / sum(weight[x] for x in open_)
    return out


def check(got, docs):
    sizes = got.fillna({"source": "~null"}).groupby("source")["size"].sum()
    want = water_fill({None if s == "~null" else s: int(n) for s, n in sizes.items()})
    for source, own in got.fillna({"source": "~null"}).groupby("source"):
        target = want[None if source == "~null" else source]
        assert (own["source_size"] == own["size"].sum()).all()
        assert np.allclose(own["target"], target)
        assert abs(own["taken"].sum() - target) <= own["size"].max() / 2 + 1
        assert (own["taken"] <= 2 * own["size"]).all() and (own["taken"] == own["copies"] * own["size"]).all()
        assert (own["shards"].map(len) == own["copies"]).all()


def test_plan_matches_brute_force_and_reruns_agree(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = mixing.plan_mix(docs, n_shards=8).toPandas()
    assert len(got) == docs.count()
    check(got, docs)
    again = mixing.plan_mix(docs.repartition(7), n_shards=8).toPandas()
    a, b = (x.sort_values("doc_id").reset_index(drop=True) for x in (got, again))
    assert (a["taken"] == b["taken"]).all() and (a["shards"].map(list) == b["shards"].map(list)).all()


def test_odd_rows(messy, no_docs):
    got = mixing.plan_mix(messy, n_shards=4).toPandas()
    assert len(got) == messy.count()
    check(got, messy)
    out = mixing.mix_documents(messy, n_shards=4)
    assert out.columns == messy.columns and out.count() == got[got["taken"] > 0]["copies"].sum()
    assert mixing.plan_mix(no_docs).count() == 0 and mixing.mix_documents(no_docs).count() == 0


def test_equal_ids_take_no_more_than_planned(spark):
    """Many rows of one id, with different and with equal texts: the mix has the rows of the plan."""
    rows = [(1, f"w{k} " * (1 + k % 30), "a", k) for k in range(400)] + [(2, "same text here", "a", k) for k in range(400)] + [(None, f"x{k} y", "b", k) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, own long").repartition(6)
    got = mixing.plan_mix(docs, n_shards=4).toPandas()
    check(got, docs)
    out = mixing.mix_documents(docs, n_shards=4).withColumn("size", mixing.word_count(F.col("text"))).toPandas()
    for source, own in got.groupby("source"):
        assert out[out["source"] == source]["size"].sum() == own["taken"].sum()
    assert out.groupby("own").size().max() <= 3 * mixing.MAX_REPEAT and (out[out["doc_id"] == 2].groupby("own").size() <= mixing.MAX_REPEAT).all()
    equal = got[got["doc_id"] == 2]["copies"]
    assert len(out[out["doc_id"] == 2]) == equal.sum()


@pytest.mark.parametrize("total,good,draws", [(200, 60, 100), (10, 3, 7), (2000, 1990, 1000), (5, 0, 3), (6, 6, 2), (4, 2, 4)])
def test_hypergeometric(spark, total, good, draws):
    n = 4000
    u = spark.range(n).withColumn("u", (F.col("id") + 0.5) / n)
    got = np.array([r[0] for r in u.select(mixing.hypergeometric(F.lit(total), F.lit(good), F.lit(draws), F.col("u")).alias("h")).collect()])
    p = good / total
    sd = (draws * p * (1 - p) * (total - draws) / max(1, total - 1)) ** 0.5
    assert got.min() >= max(0, draws - (total - good)) and got.max() <= min(good, draws)
    assert abs(got.mean() - draws * p) < 0.02 * max(1, sd) and abs(got.std() - sd) < 0.03 * max(1, sd)
    assert (np.diff(got) >= 0).all()


def test_quotas_are_split_exactly(spark):
    quotas = spark.createDataFrame([(1, 700), (2, 3), (3, 0), (4, 120)], "source_no int, quota long")
    got = mixing.split_quotas(quotas, 4, 7).toPandas()
    assert got.groupby("source_no")["blocks"].sum().to_dict() == {1: 700, 2: 3, 3: 0, 4: 120}
    assert got["shard"].nunique() == 16 and (got["blocks"] >= 0).all()
    per = got.groupby("shard")["blocks"].sum()
    assert per.max() - per.min() <= 4


def test_no_python_in_the_plan(spark, messy):
    for df in (mixing.plan_mix(messy, n_shards=4), mixing.mix_documents(messy, n_shards=4)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
