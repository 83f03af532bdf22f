import corpus_pipeline
from quayside.llm import langid, minhash, mixing, packing, pii
from quayside.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_minhash import classes


def test_stages_follow_their_operators(spark, messy):
    docs = messy
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, out = docs.collect(), stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        after = docs.collect()
        if name == "language_id":
            letters = [r for r in before if any(c.isalpha() for c in r["text"] or "")]
            assert sorted(str(r["text"]) for r in letters) == sorted(str(r["text"]) for r in after)
        elif name == "near_dedup":
            roots = classes([(r["doc_id"], r["text"]) for r in before if r["doc_id"] is not None])
            assert sorted(r["doc_id"] for r in after if r["doc_id"] is not None) == sorted(set(roots.values()))
        elif name == "personal_data":
            assert sorted(r["text"] for r in after) == sorted(pii.mask(r["text"], ",".join(f"{k}:{s}:{e}" for k, x in zip(pii.KINDS, pii.base_spans(r["text"]), strict=True) for s, e in x)) for r in before)
        else:
            plan = mixing.plan_mix(spark.createDataFrame(before, docs.schema)).filter("taken > 0").collect()
            assert sorted(str(r["doc_id"]) for r in after) == sorted(str(r["doc_id"]) for r in plan for _ in range(r["copies"]))
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF_SMALL).count() == docs.count()


def test_stages_take_an_empty_table(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF_SMALL).count() == 0


def test_registered():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "personal_data", "mix_sources", "length_packing"]
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14)) and set(ORACLE) <= set(QUERIES)
    assert all(m.__doc__ for m in (langid, minhash, mixing, packing, pii))
