import json

from pyspark.sql import functions as F

from quayside.operators.lookup import lookup_dataset
from quayside.operators.tasks import (
    backfill_periods,
    expected_files,
    incremental_periods,
    skipped_templates,
    task_counts,
    task_sample,
)
from quayside.sources.catalog import read_catalog


def catalog_file(tmp, extra=()):
    maps = []
    for i in range(17):
        maps.append(dict(url_pattern=f"https://h/m{i}-{{month_name}}-{{year}}.zip", table_name=f"m{i}",
                         parameters=["month_name", "year"], landing_path=f"m{i}", comment="c"))
    for i in range(5):
        maps.append(dict(url_pattern=f"https://h/y{i}-{{year}}.zip", table_name=f"y{i}", parameters=["year"],
                         landing_path=f"y{i}", comment="c"))
    maps.append(dict(url_pattern="https://h/q-{year}-{quarter}.zip", table_name="q", parameters=["year", "quarter"],
                     landing_path="q", comment="Benefits' data"))
    for i in range(2):
        maps.append(dict(url_pattern=f"https://h/s{i}.zip", table_name=f"s{i}", parameters=[], landing_path=f"s{i}",
                         comment="c"))
    maps.extend(extra)
    path = f"{tmp}/catalog.json"
    with open(path, "w") as f:
        json.dump({"mappings": maps}, f, indent=2)
    return path


def test_reference_counts(spark, tmp):
    cat = read_catalog(spark, catalog_file(tmp))
    assert cat.count() == 25
    assert expected_files(cat, backfill_periods(2020, 2024), per_period=True).count() == 1382
    distinct = expected_files(cat, backfill_periods(2020, 2024))
    assert distinct.count() == 1067 == distinct.select("url").distinct().count()
    monthly = expected_files(cat, incremental_periods(F.lit("2024-06-15").cast("date")), per_period=True)
    assert monthly.count() == 25
    assert task_counts(distinct).first().asDict() == {"tasks": 1067, "tables": 25}


def test_granularity_of_distinct_tasks(spark, tmp):
    cat = read_catalog(spark, catalog_file(tmp))
    t = expected_files(cat, backfill_periods(2024, 2024))
    q = t.where("table_name = 'q'").orderBy("month").collect()
    assert [(r.month, r.quarter, r.url) for r in q] == [
        (1, "q1", "https://h/q-2024-q1.zip"), (4, "q2", "https://h/q-2024-q2.zip"),
        (7, "q3", "https://h/q-2024-q3.zip"), (10, "q4", "https://h/q-2024-q4.zip")]
    y = t.where("table_name = 'y0'").collect()
    assert [(r.year, r.month, r.quarter) for r in y] == [(2024, None, None)]
    s = t.where("table_name = 's0'").collect()
    assert [(r.year, r.month, r.url) for r in s] == [(None, None, "https://h/s0.zip")]


def test_incremental_is_previous_month(spark, tmp):
    cat = read_catalog(spark, catalog_file(tmp))
    t = expected_files(cat, incremental_periods(F.lit("2024-01-10").cast("date")))
    r = t.where("table_name = 'm0'").first()
    assert (r.year, r.month, r.url) == (2023, 12, "https://h/m0-december-2023.zip")


def test_unknown_parameter_gives_no_task(spark, tmp):
    extra = [dict(url_pattern="https://h/x-{region}.zip", table_name="x", parameters=["region"], landing_path="x",
                  comment=""),
             dict(url_pattern="https://h/d-{year}.zip", table_name="d", parameters=["year", "year"],
                  landing_path="d", comment="")]
    cat = read_catalog(spark, catalog_file(tmp, extra))
    t = expected_files(cat, backfill_periods(2024, 2024))
    assert t.where("table_name in ('x', 'd')").count() == 0
    assert sorted(r.table_name for r in skipped_templates(cat).collect()) == ["d", "x"]


def test_task_sample_is_ordered_top_k(spark, tmp):
    cat = read_catalog(spark, catalog_file(tmp))
    s = task_sample(expected_files(cat, backfill_periods(2020, 2024)), 3, prefix=12).collect()
    assert [r.url_prefix for r in s] == ["https://h/m0"] * 3
    assert [r.month for r in s] == [1, 2, 3]


def test_lookup_first_match_and_default(spark, tmp):
    extra = [dict(url_pattern="https://h/dup.zip", table_name="second", parameters=[], landing_path="m0",
                  comment="it's second")]
    cat = read_catalog(spark, catalog_file(tmp, extra))
    keys = spark.createDataFrame([("m0",), ("q",), ("nowhere",)], ["landing_path"])
    got = {r.landing_path: (r.table_name, r.comment) for r in lookup_dataset(keys, cat).collect()}
    assert got == {"m0": ("m0", "c"), "q": ("q", "Benefits' data"), "nowhere": ("nowhere", "")}
