"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from quayside.plans.registry import ORACLE, QUERIES

from .conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) and set(QUERIES) <= set(E.queries())
    assert len(QUERIES) >= 41


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert cols == sorted(ocols)
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    want = Counter(tuple(norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def test_hot_month_is_landed_by_several_tasks(spark, tmp):
    """A month holding most rows is split over tasks by range bounds, not sent to one."""
    from pyspark.sql import functions as F

    from quayside.plans.derive import land_csv_by_month

    df = spark.range(0, 200_000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") < 180_000, F.lit("2024-03-15")).otherwise(F.lit("2024-04-02")).cast("timestamp").alias("d"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    prev = spark.conf.get(key)
    spark.conf.set(key, "64k")  # a small target size stands for a month far above it
    try:
        land_csv_by_month(df, "d", {"k": "K"}, f"{tmp}/land")
    finally:
        spark.conf.set(key, prev)
    hot = spark.read.option("header", True).csv(f"{tmp}/land/year=2024/month=03")
    files = hot.select(F.input_file_name().alias("f")).distinct().count()
    assert files >= 4
    assert hot.count() == 180_000
    assert spark.read.option("header", True).csv(f"{tmp}/land").count() == 200_000


def test_queries_run_from_another_folder(tmp):
    """Executor-side package code is importable whatever folder the driver starts in."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(repo, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("members", E.queries()["archive_members"](spark, {SF_SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "members 200" in out.stdout, out.stderr[-3000:]
