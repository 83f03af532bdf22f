import pytest

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Columns that operators use for themselves.
CLASH = ("score", "size", "block", "_shard", "_copy", "text_key", "class_id", "d", "_id", "spans", "_range", "n_tokens", "k1", "p")

LOREM = "the quick brown fox jumps over the lazy dog while many small birds sing in the old green garden near our quiet river"
FRENCH = "le petit chat dort sur la grande table rouge pendant que les enfants jouent dans le jardin avec leurs amis"


def rows():
    base = [(k, f"{LOREM} number{k} ends here {k * 7919 % 1000} {LOREM[k:]}", "en", f"s{k % 3}", 1) for k in range(1, 21)]
    base += [(k, f"{FRENCH} fin{k} {FRENCH[k:]}", "fr", "s1" if k % 2 else None, 1) for k in range(21, 41)]
    odd = [
        (50, None, "en", "s0", None), (51, "", None, None, 0), (52, "   \n\t ", "en", "s0", 6), (53, "12345 !!!", "fr", "s2", 9),
        (54, "x" * 5000, "en", "s2", 5000), (55, base[0][1], "en", "s0", 1), (55, base[0][1], "en", "s0", 1), (None, "no id at all here", "en", "s1", 17),
        (56, " ".join(f"w{k % 977}" for k in range(20000)), "en", "s1", 1), (57, "é", "fr", "s1", 1), (58, "\U0001f600 你好", None, "s2", 4),
    ]
    return base + odd


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, empty and long texts, repeated rows and clashing extra columns."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows(), DOCS)
    return df.withColumns({c: F.lit("other") for c in CLASH}).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
