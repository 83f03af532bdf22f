import hashlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from quayside.llm import lines, runs
from quayside.llm.common import table
from quayside.llm.queries import op12_line_dedup
from tests.conftest import SF_SMALL

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows):
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    first = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= 10:
                first[k] = min(first.get(k, (True, 0)), (doc is None, doc or 0))
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(key(x)) < 10 or first[key(x)] == (doc is None, doc or 0)]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    out = lines.drop_lines(df).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256))
    return sorted((tuple(r) for r in out.collect()), key=str)


def sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return sorted(con.execute(lines.SQL).fetchall(), key=str)


MESSY = [
    (5, "A common line here\nonly five\n\n  another Common line \t"), (2, "another common LINE\nshort\nshort\n"), (9, "a COMMON line here \nA common line here\nown text of nine"),
    (3, None), (4, ""), (None, "another common line\nof no id at all"), (None, "of no id at all\nA common line here"), (11, "ÄÖÜäöüßéèê\n0123456789"), (12, "äÖÜäöüßéèê\nÄÖÜäöüßéèê\r\n012345678"),
    (13, "of no id at all\n  0123456789"), (2, "A common line here"), (5, "A common line here\nonly five\n\n  another Common line \t"), (14, "\n\n\n"), (15, "x" * 300_000 + "\n" + "y\n" * 50_000 + "a common line here"),
    (-7, "0123456789"), (16, "İİİİİİİİİİ\nİİİİİİİİİ"), (17, "i̇i̇i̇i̇i̇\nİİİİİİİİİİ"),
]


def test_messy_rows(spark):
    df = spark.createDataFrame(MESSY, "doc_id long, text string").withColumns({c: F.lit("z") for c in ("k1", "line", "n_lines", "keep", "text_key", "_lead", "_id")}).repartition(3)
    assert got(df) == brute(MESSY)
    assert sql(MESSY) == brute(MESSY)
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []
    text_ids = spark.createDataFrame([("b", "0123456789"), ("a", "0123456789")], "doc_id string, text string")
    assert [r[2] for r in got(text_ids)] == [0, 1]


def test_a_line_of_very_many_documents_spreads_over_ranges(spark):
    """Every document has the hot line, many twice: it fills several ranges, and the first document
    alone keeps it."""
    rows = [(i, f"the hot line of all\nline number {i} of this\n" + ("the hot line of all" if i % 2 else f"pair {i // 2} of lines")) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(df) == brute(rows)
    hashes = lines.hashed_lines(df.withColumn("text_key", F.xxhash64("text")))
    dealt = hashes.repartitionByRange(8, "k1", "k2", "doc_id", "text_key", "line").withColumn("p", F.spark_partition_id())
    sizes = [r["n"] for r in dealt.groupBy("p").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 3 * sum(sizes) / 8


def test_bitmaps(spark):
    keep = np.array([1, 0, 0, 1, 1, 0, 1, 1, 0, 1], bool)
    assert (lines.unpack(lines.pack(keep), 10) == keep).all() and len(lines.pack(np.ones(1_000_000, bool))) < 1000
    df = spark.createDataFrame(MESSY, "doc_id long, text string")
    maps = {(r["doc_id"], r["n_lines"]): lines.unpack(r["keep"], r["n_lines"]).tolist() for r in lines.keep_bitmaps(df).collect()}
    assert maps[(9, 3)] == [False, False, True] and (4, 1) not in maps


def test_runs_mark_first_rows(spark):
    rows = [(k % 3, 0, k // 3, k) for k in range(600)]
    df = spark.createDataFrame(rows, "k1 long, k2 long, at long, other long")
    marked = runs.mark_runs(df, "at", F.asc("at"), name="t").collect()
    assert len(marked) == 600 and all(r["_lead"] == 0 and r["_first"] == (r["at"] == 0) for r in marked)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    rows = [tuple(r) for r in op12_line_dedup(spark, SF_SMALL).collect()]
    assert sorted(rows, key=str) == sorted(con.execute(lines.SQL).fetchall(), key=str)
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect()]
    assert sorted(rows, key=str) == brute(docs)
