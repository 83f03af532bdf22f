"""Registered queries: one per operator key of the survey, each over the whole tables.

Every query reads the driver's tables (or files Spark derives from them) and
returns a DataFrame; ``ORACLE`` holds the equivalent DuckDB SQL where one exists.
Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.calendar import month_name, period_columns, periods_between, previous_period, quarter_label
from quayside.functions.names import snake_case_col
from quayside.functions.paths import default_checkpoint, expand_template, full_table_name, int_or_null, partition_path
from quayside.functions.records import from_json_rows, to_json_rows
from quayside.operators import audit as A
from quayside.operators.columns import snake_columns
from quayside.operators.land import land_archive_members, landed_keys
from quayside.operators.lookup import lookup_dataset
from quayside.operators.tasks import backfill_periods, expected_files, task_counts, task_sample
from quayside.plans import derive as D
from quayside.plans.run import run_load
from quayside.session import scratch_dir
from quayside.sources.archives import archive_members, decode_members, is_csv, scan_archives
from quayside.sources.catalog import read_catalog, read_csv_strings, read_json_array, write_catalog
from quayside.sources.landing import landing_manifest
from quayside.sources.zip_source import zip_members
from quayside.streaming import batch_log, schema_log
from quayside.streaming.ingest import RESULT_SCHEMA, IngestOptions, ingest_table, read_table
from quayside.streaming.tables import register_loaded_table

AS_OF = "2024-06-01 00:00:00"
AUDIT_AS_OF = "2024-01-30 23:59:59"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def reg(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle.strip()
        return fn
    return reg


# =========================================================================== scalar functions

@query("calendar_columns", """
SELECT o_orderkey,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month,
       lower(monthname(o_orderdate)) AS month_name,
       'q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter
FROM orders
""")
def calendar_columns(spark, sf):
    o = D.table(spark, sf, "orders")
    m = F.month("o_orderdate")
    return o.select("o_orderkey", F.year("o_orderdate").alias("year"), m.alias("month"),
                    month_name(m).alias("month_name"), quarter_label(m).alias("quarter"))


@query("previous_period", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS previous_period
FROM orders
""")
def previous_period_q(spark, sf):
    o = D.table(spark, sf, "orders")
    return o.select("o_orderkey", previous_period(F.col("o_orderdate").cast("date")).alias("previous_period"))


TEMPLATE = "https://files.example/{year}/{month_name}/{quarter}/{unknown}/o-{year}.zip"


@query("expand_template", f"""
SELECT o_orderkey,
       replace(replace(replace('{TEMPLATE}', '{{year}}', CAST(year(o_orderdate) AS VARCHAR)),
                       '{{month_name}}', lower(monthname(o_orderdate))),
               '{{quarter}}', 'q' || CAST(quarter(o_orderdate) AS VARCHAR)) AS url
FROM orders
""")
def expand_template_q(spark, sf):
    o = D.table(spark, sf, "orders")
    m = F.month("o_orderdate")
    url = expand_template(F.lit(TEMPLATE), {"year": F.year("o_orderdate"), "month_name": month_name(m),
                                            "quarter": quarter_label(m)})
    return o.select("o_orderkey", url.alias("url"))


@query("landing_path", """
WITH p AS (
  SELECT o_orderkey, o_orderpriority,
         TRY_CAST(NULLIF(CASE WHEN o_orderstatus = 'O' THEN '' ELSE CAST(year(o_orderdate) AS VARCHAR) END, '') AS INTEGER) AS year,
         TRY_CAST(NULLIF(CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(month(o_orderdate) AS VARCHAR) END, '') AS INTEGER) AS month,
         CASE WHEN o_orderstatus = 'F' THEN '/ck/custom' ELSE '' END AS given_ckpt
  FROM orders)
SELECT o_orderkey, year, month,
       CASE WHEN year IS NOT NULL AND year <> 0 AND month IS NOT NULL AND month <> 0
              THEN '/landing/' || o_orderpriority || '/year=' || CAST(year AS VARCHAR) || '/month=' || lpad(CAST(month AS VARCHAR), 2, '0')
            WHEN year IS NOT NULL AND year <> 0 THEN '/landing/' || o_orderpriority || '/year=' || CAST(year AS VARCHAR)
            ELSE '/landing/' || o_orderpriority END AS target_path,
       'main.raw.' || trim(lower(regexp_replace(o_orderpriority, '[^a-zA-Z0-9]+', '_', 'g')), '_') AS full_name,
       coalesce(NULLIF(given_ckpt, ''), '/vol/main/raw/checkpoints/' || trim(lower(regexp_replace(o_orderpriority, '[^a-zA-Z0-9]+', '_', 'g')), '_')) AS checkpoint_path
FROM p
""")
def landing_path_q(spark, sf):
    o = D.table(spark, sf, "orders")
    st = F.col("o_orderstatus")
    p = o.select(
        "o_orderkey", "o_orderpriority",
        int_or_null(F.when(st == "O", F.lit("")).otherwise(F.year("o_orderdate").cast("string"))).alias("year"),
        int_or_null(F.when(st == "P", F.lit("")).otherwise(F.month("o_orderdate").cast("string"))).alias("month"),
        F.when(st == "F", F.lit("/ck/custom")).otherwise(F.lit("")).alias("given_ckpt"),
    )
    tbl = snake_case_col("o_orderpriority")
    return p.select(
        "o_orderkey", "year", "month",
        partition_path(F.concat(F.lit("/landing/"), F.col("o_orderpriority")), "year", "month").alias("target_path"),
        full_table_name(F.lit("main"), F.lit("raw"), tbl).alias("full_name"),
        default_checkpoint("given_ckpt", F.lit("/vol"), F.lit("main"), F.lit("raw"), tbl).alias("checkpoint_path"),
    )


@query("period_grid", """
WITH r AS (SELECT o_custkey, min(year(o_orderdate)) AS s, max(year(o_orderdate)) AS e FROM orders GROUP BY o_custkey),
g AS (SELECT o_custkey, unnest(generate_series(make_date(s, 1, 1), make_date(e, 12, 1), INTERVAL 1 MONTH)) AS p FROM r)
SELECT o_custkey, CAST(year(p) AS INTEGER) AS year, CAST(month(p) AS INTEGER) AS month,
       lower(monthname(p)) AS month_name, 'q' || CAST(quarter(p) AS VARCHAR) AS quarter
FROM g
""")
def period_grid_q(spark, sf):
    o = D.table(spark, sf, "orders")
    r = o.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("s"), F.max(F.year("o_orderdate")).alias("e"))
    g = r.select("o_custkey", F.explode(periods_between("s", "e")).alias("p"))
    return g.select("o_custkey", *period_columns("p"))


@query("snake_values", """
SELECT doc_id, trim(lower(regexp_replace(text, '[^a-zA-Z0-9]+', '_', 'g')), '_') AS snake_text FROM documents
""")
def snake_values(spark, sf):
    return D.table(spark, sf, "documents").select("doc_id", snake_case_col("text").alias("snake_text"))


@query("snake_columns", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def snake_columns_q(spark, sf):
    p = D.table(spark, sf, "part")
    unfriendly = p.select(*[F.col(k).alias(v) for k, v in D.PART_HEADERS.items()])
    return snake_columns(unfriendly)


# =========================================================================== catalog and tasks

SUPPLIER_SLUG_SQL = "trim(lower(regexp_replace(s_name, '[^a-zA-Z0-9]+', '_', 'g')), '_')"

CATALOG_SQL = f"""
sup AS (SELECT s_suppkey, s_name, s_nationkey, CAST(s_suppkey % 5 AS INTEGER) AS ptype,
               {SUPPLIER_SLUG_SQL} AS slug FROM supplier),
cat AS (
  SELECT s_suppkey, ptype,
         CAST(row_number() OVER (PARTITION BY s_suppkey // 100 ORDER BY s_suppkey) - 1 AS INTEGER) AS position,
         'https://files.example/' || slug ||
           CASE ptype WHEN 0 THEN '/latest.zip' WHEN 1 THEN '/{{year}}.zip' WHEN 2 THEN '/{{year}}-{{quarter}}.zip'
                      WHEN 3 THEN '/{{month_name}}-{{year}}.zip' ELSE '/{{region}}/{{month_name}}-{{year}}.zip' END AS url_pattern,
         slug AS table_name,
         CASE ptype WHEN 0 THEN '' WHEN 1 THEN 'year' WHEN 2 THEN 'year,quarter'
                    WHEN 3 THEN 'month_name,year' ELSE 'month_name,year,region' END AS parameter_list,
         'region_' || CAST(s_nationkey % 5 AS VARCHAR) AS landing_path,
         s_name || '''s files' AS comment,
         CASE ptype WHEN 1 THEN 'amount:double,code:string' ELSE '' END AS types
  FROM sup)"""


def _supplier_catalog(spark, sf) -> DataFrame:
    path = scratch_dir(spark, "catalog")
    D.write_supplier_catalog(D.table(spark, sf, "supplier"), path)
    return read_catalog(spark, path)


@query("catalog_load", f"""
WITH {CATALOG_SQL}
SELECT position, url_pattern, table_name, parameter_list, landing_path, comment, types FROM cat
""")
def catalog_load(spark, sf):
    c = _supplier_catalog(spark, sf)
    return c.select("position", "url_pattern", "table_name",
                    F.array_join("parameters", ",").alias("parameter_list"), "landing_path", "comment",
                    F.array_join(F.sort_array(F.transform(F.map_entries("types"), lambda e: F.concat_ws(":", e["key"], e["value"]))), ",").alias("types"))


@query("catalog_lookup", f"""
WITH {CATALOG_SQL},
first AS (SELECT landing_path, table_name, comment FROM (
            SELECT *, row_number() OVER (PARTITION BY landing_path ORDER BY s_suppkey) AS rn FROM cat) WHERE rn = 1),
keys AS (SELECT 'customer' AS kind, c_custkey AS id, 'region_' || CAST(c_nationkey % 7 AS VARCHAR) AS landing_path FROM customer
         UNION ALL
         SELECT 'supplier' AS kind, s_suppkey AS id, 'region_' || CAST(s_nationkey % 7 AS VARCHAR) AS landing_path FROM supplier)
SELECT k.kind, k.id, k.landing_path, coalesce(f.table_name, k.landing_path) AS table_name, coalesce(f.comment, '') AS comment
FROM keys k LEFT JOIN first f ON k.landing_path = f.landing_path
""")
def catalog_lookup(spark, sf):
    c = _supplier_catalog(spark, sf)
    cust = D.table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"),
        F.concat(F.lit("region_"), F.pmod("c_nationkey", F.lit(7)).cast("string")).alias("landing_path"))
    supp = D.table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"),
        F.concat(F.lit("region_"), F.pmod("s_nationkey", F.lit(7)).cast("string")).alias("landing_path"))
    return lookup_dataset(cust.unionByName(supp), c)


def _order_years(spark, sf) -> tuple[int, int]:
    r = D.table(spark, sf, "orders").agg(F.min(F.year("o_orderdate")).alias("s"),
                                         F.max(F.year("o_orderdate")).alias("e")).collect()[0]
    return int(r.s), int(r.e)


def _tasks(spark, sf) -> DataFrame:
    s, e = _order_years(spark, sf)
    return expected_files(_supplier_catalog(spark, sf), backfill_periods(s, e))


TASKS_SQL = f"""
WITH {CATALOG_SQL},
yrs AS (SELECT min(year(o_orderdate)) AS s, max(year(o_orderdate)) AS e FROM orders),
months AS (SELECT unnest(generate_series(make_date(s, 1, 1), make_date(e, 12, 1), INTERVAL 1 MONTH)) AS p FROM yrs),
tasks AS (
  SELECT position, table_name, landing_path, url_pattern AS url,
         CAST(NULL AS INTEGER) AS year, CAST(NULL AS INTEGER) AS month, CAST(NULL AS VARCHAR) AS quarter
  FROM cat WHERE ptype = 0
  UNION ALL
  SELECT DISTINCT position, table_name, landing_path, replace(url_pattern, '{{year}}', CAST(year(p) AS VARCHAR)),
         CAST(year(p) AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR)
  FROM cat, months WHERE ptype = 1
  UNION ALL
  SELECT DISTINCT position, table_name, landing_path,
         replace(replace(url_pattern, '{{year}}', CAST(year(p) AS VARCHAR)), '{{quarter}}', 'q' || CAST(quarter(p) AS VARCHAR)),
         CAST(year(p) AS INTEGER), CAST(quarter(p) * 3 - 2 AS INTEGER), 'q' || CAST(quarter(p) AS VARCHAR)
  FROM cat, months WHERE ptype = 2
  UNION ALL
  SELECT position, table_name, landing_path,
         replace(replace(url_pattern, '{{year}}', CAST(year(p) AS VARCHAR)), '{{month_name}}', lower(monthname(p))),
         CAST(year(p) AS INTEGER), CAST(month(p) AS INTEGER), 'q' || CAST(quarter(p) AS VARCHAR)
  FROM cat, months WHERE ptype = 3)"""


@query("expected_files", TASKS_SQL + "\nSELECT position, table_name, landing_path, url, year, month, quarter FROM tasks")
def expected_files_q(spark, sf):
    return _tasks(spark, sf)


@query("tasks_json", TASKS_SQL + "\nSELECT position, table_name, landing_path, url, year, month, quarter FROM tasks")
def tasks_json(spark, sf):
    """The task list as JSON rows and back."""
    tasks = _tasks(spark, sf)
    return from_json_rows(to_json_rows(tasks), tasks.schema)


@query("task_counts", TASKS_SQL + "\nSELECT count(*) AS tasks, count(DISTINCT table_name) AS tables FROM tasks")
def task_counts_q(spark, sf):
    return task_counts(_tasks(spark, sf))


@query("task_sample", TASKS_SQL + """
SELECT position, table_name, substring(url, 1, 80) AS url_prefix, year, month FROM tasks
ORDER BY position, year NULLS FIRST, month NULLS FIRST, url LIMIT 3""")
def task_sample_q(spark, sf):
    return task_sample(_tasks(spark, sf), 3)


# =========================================================================== ingest

ORDERS_OUT_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def _orders_cols(t: DataFrame) -> list:
    return [F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"),
            "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"), "o_orderpriority"]


def _ingest_orders(spark, sf, runs=1, split=None, max_files=100):
    """Land orders as monthly CSV files, ingest; returns (table DataFrame, checkpoint, results)."""
    root = scratch_dir(spark, "ingest-orders")
    land, tbl, ck = f"{root}/landing/orders", f"{root}/tables/orders", f"{root}/checkpoints/orders"
    orders = D.table(spark, sf, "orders")
    opts = IngestOptions(as_of=AS_OF, max_files_per_trigger=max_files)
    results = []
    if split is not None:
        D.land_orders(orders, land, split)
        results.append(ingest_table(spark, land, tbl, ck, "orders", opts).collect()[0])
        D.land_orders(orders, land, ~split)
    else:
        D.land_orders(orders, land)
    for _ in range(runs):
        results.append(ingest_table(spark, land, tbl, ck, "orders", opts).collect()[0])
    for r in results:
        if r.status != "success":
            raise RuntimeError(f"ingest failed: {r.message}")
    return read_table(spark, tbl, ck), ck, results


@query("ingest_csv", ORDERS_OUT_SQL)
def ingest_csv(spark, sf):
    t, _, _ = _ingest_orders(spark, sf)
    return t.select(*_orders_cols(t))


@query("ingest_rerun", ORDERS_OUT_SQL)
def ingest_rerun(spark, sf):
    t, _, _ = _ingest_orders(spark, sf, runs=2)
    return t.select(*_orders_cols(t))


@query("ingest_incremental", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END AS BIGINT) AS load_run
FROM orders""")
def ingest_incremental(spark, sf):
    t, _, _ = _ingest_orders(spark, sf, split=F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    # One batch per run at this file count: the batch id numbers the runs.
    return t.select(*_orders_cols(t), F.col("_batch_id").alias("load_run"))


@query("ingest_batched", ORDERS_OUT_SQL.replace(" FROM", ", true AS full_batches, true AS bounded_batches FROM"))
def ingest_batched(spark, sf):
    """Rows as in ``ingest_csv``, and whether the load took as few micro-batches of at most 10
    files as its files need, and none held more."""
    t, _, results = _ingest_orders(spark, sf, max_files=10)
    per_batch = t.groupBy("_batch_id").agg(F.countDistinct("_source_file").alias("n"))
    load = per_batch.agg(F.sum("n").alias("files"), F.max("n").alias("most")).select(
        (F.ceil(F.col("files") / 10) == results[-1].batches).alias("full_batches"), (F.col("most") <= 10).alias("bounded_batches"))
    return t.select(*_orders_cols(t)).crossJoin(load)  # one row


@query("ingest_by_bytes", ORDERS_OUT_SQL.replace(" FROM", ", true AS bounded_batches, true AS differ_in_files FROM"))
def ingest_by_bytes(spark, sf):
    """Rows as in ``ingest_csv``, and whether every micro-batch stays below the byte bound (twice the largest
    file) and the number of files of a batch differs."""
    root = scratch_dir(spark, "ingest-bytes")
    land, tbl, ck = f"{root}/landing/orders", f"{root}/tables/orders", f"{root}/checkpoints/orders"
    D.land_orders_unevenly(D.table(spark, sf, "orders"), land)
    name = lambda c: F.regexp_extract(c, "year=[^/]+/month=[^/]+/[^/]+$", 0).alias("file")
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(land).select(name("path"), "length")
    bound = 2 * sizes.agg(F.max("length")).first()[0]
    r = ingest_table(spark, land, tbl, ck, "orders", IngestOptions(as_of=AS_OF, max_bytes_per_trigger=bound)).collect()[0]
    if r.status != "success":
        raise RuntimeError(f"ingest failed: {r.message}")
    t = read_table(spark, tbl, ck)
    batches = t.select("_batch_id", name("_source_file")).distinct().join(sizes, "file").groupBy("_batch_id").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    load = batches.agg((F.max("bytes") <= bound).alias("bounded_batches"), (F.countDistinct("files") > 1).alias("differ_in_files"))
    return t.select(*_orders_cols(t)).crossJoin(load)  # one row


@query("ingest_result_json", """
SELECT 'success' AS status, 'orders' AS table_name, count(*) AS total_rows, count(*) AS rows_added, '2024-06-01 00:00:00.000000' AS latest_load_timestamp,
       CAST(0 AS BIGINT) AS corrupt_rows, CAST(0 AS BIGINT) AS empty_files, true AS has_checkpoint FROM orders""")
def ingest_result_json(spark, sf):
    """The result row of a load as JSON text and back."""
    _, ck, results = _ingest_orders(spark, sf)
    row = spark.createDataFrame(results[-1:], RESULT_SCHEMA)
    back = from_json_rows(to_json_rows(row), RESULT_SCHEMA)
    return back.select("status", "table_name", "total_rows", "rows_added", "latest_load_timestamp", "corrupt_rows", "empty_files",
                       (F.col("checkpoint_path") == ck).alias("has_checkpoint"))


@query("load_statistics", """
SELECT 'o_custkey' AS column_name, count(*) AS rows, true AS files_match, true AS within_error FROM orders
UNION ALL SELECT '_source_file' AS column_name, count(*) AS rows, true AS files_match, true AS within_error FROM orders""")
def load_statistics_q(spark, sf):
    """Rows, files and distinct values of a loaded table from the sketches of its batch log, against exact counts
    of the input table and of the landing tree."""
    root = scratch_dir(spark, "ingest-sketches")
    land, tbl, ck = f"{root}/landing/orders", f"{root}/tables/orders", f"{root}/checkpoints/orders"
    orders = D.table(spark, sf, "orders")
    D.land_orders(orders, land)
    ingest_table(spark, land, tbl, ck, "orders", IngestOptions(as_of=AS_OF, max_files_per_trigger=20, sketch_columns=("o_custkey",))).collect()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(land).select("path").count()
    exact = orders.select(F.lit("o_custkey").alias("column_name"), F.col("o_custkey").alias("v")).groupBy("column_name").agg(F.countDistinct("v").alias("exact"))
    exact = exact.unionAll(spark.createDataFrame([("_source_file", files)], exact.schema))
    near = F.abs(F.col("distinct_estimate") - F.col("exact")) <= batch_log.SKETCH_ERROR * F.col("exact")
    return batch_log.load_statistics(spark, f"{ck}/batches").join(exact, "column_name").select(
        "column_name", "rows", (F.col("files") == files).alias("files_match"), near.alias("within_error"))


@query("ingest_messy", ORDERS_OUT_SQL.replace(" FROM", ", CAST(0 AS BIGINT) AS corrupt_rows, CAST(1 AS BIGINT) AS empty_files FROM"))
def ingest_messy(spark, sf):
    """Blank first lines, CR line ends, newlines in quoted headers and a file without a record."""
    root = scratch_dir(spark, "ingest-messy")
    land, tbl, ck = f"{root}/landing/orders", f"{root}/tables/orders", f"{root}/checkpoints/orders"
    D.land_messy_orders(D.table(spark, sf, "orders"), land)
    r = ingest_table(spark, land, tbl, ck, "orders", IngestOptions(as_of=AS_OF, multi_line=True)).collect()[0]
    if r.status != "success":
        raise RuntimeError(f"ingest failed: {r.message}")
    t = read_table(spark, tbl, ck)
    return t.select(*_orders_cols(t), F.lit(r.corrupt_rows).alias("corrupt_rows"), F.lit(r.empty_files).alias("empty_files"))


def _run_orders(spark, sf, runs: int):
    root = scratch_dir(spark, "run-orders")
    orders = D.table(spark, sf, "orders")
    write_catalog(D.order_catalog(orders), f"{root}/catalog", group_col="doc", order_col="priority")
    D.build_order_archives(orders, f"{root}/archives").write.format("noop").mode("overwrite").save()
    years = orders.agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b")).first()
    for _ in range(runs):  # the same time each: only the run id tells the runs apart
        out = run_load(spark, f"{root}/catalog", f"{root}/archives", f"{root}/load", start_year=years.a, end_year=years.b, as_of=AS_OF)
    return root, out


@query("run_load", """
SELECT 'orders_' || CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) % 2 AS VARCHAR) AS table_name, o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS _year, CAST(month(o_orderdate) AS INTEGER) AS _month FROM orders""")
def run_load_q(spark, sf):
    """All rows of the tables that a whole run loads."""
    root, out = _run_orders(spark, sf, 1)
    names = [r.table_name for r in out["results"].orderBy("table_name").collect()]
    tables = [read_table(spark, f"{root}/load/tables/{n}", f"{root}/load/checkpoints/{n}") for n in names]
    rows = [t.select(F.lit(n).alias("table_name"), F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_custkey",  # text by the catalog's types
                     F.col("o_totalprice").cast("double").alias("o_totalprice"), "_year", "_month") for n, t in zip(names, tables, strict=True)]
    return reduce(DataFrame.unionAll, rows)


@query("run_load_rerun", """
WITH m AS (
  SELECT substr(o_orderpriority, 1, 1) || '/b' || CAST(o_orderkey // 1000000 AS VARCHAR) AS k, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders GROUP BY ALL),
y AS (SELECT range AS year FROM range((SELECT min(year) FROM m), (SELECT max(year) + 1 FROM m))),
p AS (SELECT DISTINCT k FROM m)
SELECT 'https://files.example/p' || p.k || '/orders-' || lower(monthname(make_date(y.year, n.range, 1))) || '-' || CAST(y.year AS VARCHAR) || '.zip' AS url,
       CASE WHEN m.k IS NULL THEN 'not_found' ELSE 'success' END AS download_status,
       CASE WHEN m.k IS NULL THEN '' ELSE 'data.csv|readme.txt' END AS files_in_zip,
       CAST(CASE WHEN m.k IS NULL THEN 0 ELSE 1 END AS INTEGER) AS csv_count,
       CAST(CASE WHEN m.k IS NULL THEN 0 ELSE 1 END AS INTEGER) AS success_count,
       (SELECT count(*) FROM orders) AS total_rows, CAST(0 AS BIGINT) AS rows_added
FROM p CROSS JOIN y CROSS JOIN range(1, 13) n LEFT JOIN m ON m.k = p.k AND m.year = y.year AND m.month = n.range""")
def run_load_rerun(spark, sf):
    """The audit of a second run at the same time, and what its loads added."""
    _, out = _run_orders(spark, sf, 2)
    total = out["results"].agg(F.sum("total_rows").alias("total_rows"), F.sum("rows_added").alias("rows_added"))
    return out["audit"].select("url", "download_status", F.array_join("files_in_zip", "|").alias("files_in_zip"),
                               F.col("csv_count").cast("int").alias("csv_count"), F.col("success_count").cast("int").alias("success_count")).crossJoin(total)


@query("lineage_columns", """
SELECT o_orderkey, '2024-06-01 00:00:00.000000' AS load_timestamp, '2024-06-01' AS _processing_date,
       'year=' || CAST(year(o_orderdate) AS VARCHAR) || '/month=' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS source_partition,
       true AS source_is_csv
FROM orders""")
def lineage_columns(spark, sf):
    t, _, _ = _ingest_orders(spark, sf)
    return t.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.date_format("_load_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("load_timestamp"),
        "_processing_date",
        F.regexp_extract("_source_file", r"year=[0-9]+/month=[0-9]+", 0).alias("source_partition"),
        F.col("_source_file").endswith(".csv").alias("source_is_csv"),
    )


@query("partition_columns", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS _year, CAST(month(o_orderdate) AS INTEGER) AS _month FROM orders""")
def partition_columns(spark, sf):
    t, _, _ = _ingest_orders(spark, sf)
    return t.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "_year", "_month")


@query("schema_infer", """
SELECT * FROM (VALUES
  (0, 'o_orderkey', (SELECT CASE WHEN max(o_orderkey) > 2147483647 THEN 'bigint' ELSE 'int' END FROM orders)),
  (1, 'o_custkey', (SELECT CASE WHEN max(o_custkey) > 2147483647 THEN 'bigint' ELSE 'int' END FROM orders)),
  (2, 'o_orderstatus', 'string'), (3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp'),
  (5, 'o_orderpriority', 'string')) AS t(position, column_name, data_type)""")
def schema_infer(spark, sf):
    _, ck, _ = _ingest_orders(spark, sf)
    log = schema_log.read_log(spark, f"{ck}/schema")
    newest = log.agg(F.max("version").alias("v"))
    return log.join(newest, log["version"] == newest["v"]).select(
        F.col("position").cast("int").alias("position"), "column_name", "data_type")


def _ingest_customer_two_runs(spark, sf):
    root = scratch_dir(spark, "evolve-customer")
    land, tbl, ck = f"{root}/landing/customer", f"{root}/tables/customer", f"{root}/checkpoints/customer"
    c = D.table(spark, sf, "customer")
    first = F.col("c_nationkey") < 12
    opts = IngestOptions(as_of=AS_OF)
    # Run 1: files without c_mktsegment; run 2: files with it (a new column).
    c.where(first).drop("c_mktsegment").write.option("header", True).csv(f"{land}/year=2024/month=01")
    r1 = ingest_table(spark, land, tbl, ck, "customer", opts).collect()[0]
    c.where(~first).write.option("header", True).csv(f"{land}/year=2024/month=02")
    r2 = ingest_table(spark, land, tbl, ck, "customer", opts).collect()[0]
    for r in (r1, r2):
        if r.status != "success":
            raise RuntimeError(f"ingest failed: {r.message}")
    return tbl, ck


@query("schema_log", """
SELECT * FROM (VALUES
  (CAST(0 AS BIGINT), 0, 'c_custkey', 'int'), (CAST(0 AS BIGINT), 1, 'c_name', 'string'),
  (CAST(0 AS BIGINT), 2, 'c_nationkey', 'int'), (CAST(0 AS BIGINT), 3, 'c_acctbal', 'double'),
  (CAST(1 AS BIGINT), 0, 'c_custkey', 'int'), (CAST(1 AS BIGINT), 1, 'c_name', 'string'),
  (CAST(1 AS BIGINT), 2, 'c_nationkey', 'int'), (CAST(1 AS BIGINT), 3, 'c_acctbal', 'double'),
  (CAST(1 AS BIGINT), 4, 'c_mktsegment', 'string')) AS t(version, position, column_name, data_type)""")
def schema_log_q(spark, sf):
    _, ck = _ingest_customer_two_runs(spark, sf)
    log = schema_log.read_log(spark, f"{ck}/schema")
    return log.select("version", F.col("position").cast("int").alias("position"), "column_name", "data_type")


@query("schema_evolve", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_nationkey < 12 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def schema_evolve(spark, sf):
    tbl, ck = _ingest_customer_two_runs(spark, sf)
    t = read_table(spark, tbl, ck)
    return t.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
                    F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_acctbal", "c_mktsegment")


@query("corrupt_rows", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS l_quantity,
       l_linenumber = 3 AS is_corrupt, CASE WHEN l_linenumber = 3 THEN 'n/a ' || CAST(l_orderkey AS VARCHAR) END AS rescued_quantity,
       CASE WHEN l_linenumber = 3 THEN '{"l_quantity":"n/a ' || CAST(l_orderkey AS VARCHAR) || '"}' END AS rescued
FROM lineitem""")
def corrupt_rows(spark, sf):
    root = scratch_dir(spark, "corrupt-lineitem")
    land, tbl, ck = f"{root}/landing/lineitem", f"{root}/tables/lineitem", f"{root}/checkpoints/lineitem"
    li = D.table(spark, sf, "lineitem")
    damaged = li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 3, F.concat(F.lit("n/a "), F.col("l_orderkey").cast("string"))).otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        "l_shipdate")
    D.land_csv_by_month(damaged, "l_shipdate", {"l_orderkey": "L OrderKey", "l_linenumber": "L LineNumber",
                                                "l_quantity": "L Quantity"}, land)
    opts = IngestOptions(as_of=AS_OF, type_overrides={"l_quantity": "double"})
    r = ingest_table(spark, land, tbl, ck, "lineitem", opts).collect()[0]
    if r.status != "success":
        raise RuntimeError(f"ingest failed: {r.message}")
    t = read_table(spark, tbl, ck)
    return t.select(F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
                    F.col("l_linenumber").cast("int").alias("l_linenumber"),
                    "l_quantity", F.col("_corrupt_record").isNotNull().alias("is_corrupt"),
                    F.variant_get("_rescued", "$.l_quantity", "string").alias("rescued_quantity"), F.to_json("_rescued").alias("rescued"))


# =========================================================================== archives

ARCHIVE_SQL = "source || '-' || lpad(CAST(doc_id // 1000 AS VARCHAR), 5, '0') || '.zip'"
MEMBER_SQL = "lang || '/' || CAST(doc_id AS VARCHAR) || CASE WHEN lang = 'de' THEN '.txt' ELSE '.csv' END"


def _document_archives(spark, sf) -> str:
    out = scratch_dir(spark, "archives")
    D.build_document_archives(D.table(spark, sf, "documents"), out).count()
    return out


def _members(spark, sf, with_content=False):
    scan = scan_archives(spark, _document_archives(spark, sf), with_md5=False)
    return archive_members(scan, with_content=with_content).withColumn("archive", F.regexp_extract("archive_path", r"[^/]*$", 0))


@query("archive_scan", f"""
SELECT {ARCHIVE_SQL} AS archive, true AS md5_equal, true AS size_equal, {MEMBER_SQL} AS member,
       CAST(octet_length(encode(text)) AS BIGINT) AS member_bytes, md5(text) AS member_md5
FROM documents""")
def archive_scan(spark, sf):
    """Size and MD5 of every archive, hashed in pieces, against those of its bytes read whole, and
    size and MD5 of the content of its members."""
    path = _document_archives(spark, sf)
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select(
        F.col("path").alias("archive_path"), F.md5("content").alias("whole_md5"), F.octet_length("content").alias("whole_bytes"))
    archives = scan_archives(spark, path).join(whole, "archive_path").select(
        "archive", (F.col("md5") == F.col("whole_md5")).alias("md5_equal"), (F.col("size_bytes") == F.col("whole_bytes")).alias("size_equal"))
    members = zip_members(spark, path, digest=True).select(
        F.regexp_extract("archive_path", r"[^/]*$", 0).alias("archive"), "member", F.col("size_bytes").alias("member_bytes"), F.col("md5").alias("member_md5"))
    return archives.join(members, "archive")


@query("zip_source", f"""
SELECT {ARCHIVE_SQL} AS archive, {MEMBER_SQL} AS member, 'csv' AS extension, CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes,
       md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS n_chars
FROM documents WHERE lang <> 'de' AND octet_length(encode(text)) >= 100""")
def zip_source(spark, sf):
    """CSV members of at least 100 bytes by the ``zip_members`` format; both filters are pushed down."""
    wanted = (F.col("extension") == "csv") & (F.col("size_bytes") >= 100)
    m = zip_members(spark, _document_archives(spark, sf), wanted, content=True)
    text = F.col("content").cast("string")
    return m.select(F.regexp_extract("archive_path", r"[^/]*$", 0).alias("archive"), "member", "extension", "size_bytes",
                    F.md5(text).alias("text_md5"), F.char_length(text).alias("n_chars"))


@query("archive_members", f"""
SELECT {ARCHIVE_SQL} AS archive, {MEMBER_SQL} AS member,
       CAST(doc_id AS VARCHAR) || CASE WHEN lang = 'de' THEN '.txt' ELSE '.csv' END AS basename,
       CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes
FROM documents""")
def archive_members_q(spark, sf):
    m = _members(spark, sf)
    return m.where(F.col("error").isNull()).select("archive", "member", "basename", "size_bytes")


@query("csv_members", f"""
SELECT {ARCHIVE_SQL} AS archive, {MEMBER_SQL} AS member, CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes
FROM documents WHERE lang <> 'de'""")
def csv_members(spark, sf):
    m = _members(spark, sf)
    return m.where(is_csv("member")).select("archive", "member", "size_bytes")


@query("decode_members", """
SELECT doc_id, true AS is_valid, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS n_chars
FROM documents WHERE lang <> 'de'""")
def decode_members_q(spark, sf):
    m = decode_members(_members(spark, sf, with_content=True).where(is_csv("member")))
    return m.select(F.regexp_extract("basename", r"^([0-9]+)", 1).cast("bigint").alias("doc_id"), "is_valid",
                    F.md5("text").alias("text_md5"), F.char_length("text").alias("n_chars"))


def _land_documents(spark, sf) -> str:
    root = scratch_dir(spark, "landing")
    archives = _document_archives(spark, sf)
    chunk = F.regexp_extract("archive", r"-([0-9]+)\.zip$", 1).cast("int")
    dataset = F.regexp_extract("archive", r"^(.*)-[0-9]+\.zip$", 1)
    month = F.pmod(chunk, F.lit(12)) + 1
    # The partition folders come from archive names (a listing, no content read).
    touched = [(r.dataset, 2024, r.month) for r in scan_archives(spark, archives, with_md5=False)
               .select(dataset.alias("dataset"), month.alias("month")).distinct().collect()]
    for _ in range(2):  # the second landing finds every member landed and reads no content
        listed = (archive_members(scan_archives(spark, archives, with_md5=False))
                  .withColumn("archive", F.regexp_extract("archive_path", r"[^/]*$", 0))
                  .where(F.col("error").isNull() & is_csv("member")))
        land_archive_members(spark, listed.select("archive_path", "archive", "member", "size_bytes",
                                                  dataset.alias("dataset"),
                                                  F.lit(2024).alias("year"), month.alias("month")),
                             root, partitions=touched)
    return root


@query("land_members", f"""
SELECT source AS dataset, 2024 AS year, CAST((doc_id // 1000) % 12 + 1 AS INTEGER) AS month, {ARCHIVE_SQL} AS archive,
       lang || '/' || CAST(doc_id AS VARCHAR) || '.csv' AS member,
       CAST(octet_length(encode(text)) + 1 AS BIGINT) AS landed_bytes
FROM documents WHERE lang <> 'de'""")
def land_members_q(spark, sf):
    return landed_keys(spark, _land_documents(spark, sf))


@query("land_multi_line", """
SELECT doc_id, md5(translate(coalesce(text, ''), chr(34) || chr(92) || chr(13), chr(39) || '/')) AS text_md5,
       true AS landed_in_parts, CAST(0 AS BIGINT) AS corrupt_rows
FROM documents""")
def land_multi_line(spark, sf):
    """CSV members whose quoted cells hold line ends, landed in parts of 64 KB cut at record ends, and loaded."""
    root = scratch_dir(spark, "land-parts")
    D.build_document_csv_archives(D.table(spark, sf, "documents"), f"{root}/archives").write.format("noop").mode("overwrite").save()
    listed = archive_members(scan_archives(spark, f"{root}/archives", with_md5=False)).select(
        "archive_path", "member", "size_bytes", F.lit("docs").alias("dataset"), F.lit(2024).alias("year"), F.lit(1).alias("month"))
    land_archive_members(spark, listed, f"{root}/landing", multi_line=True, part_bytes=64 << 10).count()
    in_parts = landing_manifest(spark, f"{root}/landing").agg((F.max("part") > 0).alias("landed_in_parts"))
    tbl, ck = f"{root}/tables/docs", f"{root}/checkpoints/docs"
    opts = IngestOptions(as_of=AS_OF, multi_line=True, max_files_per_trigger=1000, type_overrides={"text": "string"})
    r = ingest_table(spark, f"{root}/landing", tbl, ck, "docs", opts).collect()[0]
    if r.status != "success":
        raise RuntimeError(f"ingest failed: {r.message}")
    t = read_table(spark, tbl, ck)
    return t.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"),
                    F.lit(r.corrupt_rows).alias("corrupt_rows")).crossJoin(in_parts)  # one row


@query("landing_manifest", """
SELECT source AS dataset, count(*) AS files, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS total_bytes
FROM documents WHERE lang <> 'de' GROUP BY source""")
def landing_manifest_q(spark, sf):
    man = landing_manifest(spark, _land_documents(spark, sf))
    return man.groupBy("dataset").agg(F.count(F.lit(1)).alias("files"), F.sum("length").cast("bigint").alias("total_bytes"))


# =========================================================================== audit

EVENT_CODE_SQL = "CAST(CASE event_type WHEN 'click' THEN 404 WHEN 'error' THEN 500 + CAST(floor(value) AS BIGINT) % 4 WHEN 'signup' THEN 302 ELSE 200 END AS INTEGER)"
EVENT_ERROR_SQL = "CASE WHEN event_type = 'signup' AND value < 5 THEN 'timeout ' || props END"


@query("fetch_status", f"""
SELECT event_id, {EVENT_CODE_SQL} AS http_code, {EVENT_ERROR_SQL} AS fetch_error,
       CASE WHEN {EVENT_ERROR_SQL} IS NOT NULL THEN 'error: ' || {EVENT_ERROR_SQL}
            WHEN {EVENT_CODE_SQL} < 400 THEN 'success'
            WHEN {EVENT_CODE_SQL} = 404 THEN 'not_found'
            ELSE 'http_error_' || CAST({EVENT_CODE_SQL} AS VARCHAR) END AS status
FROM events""")
def fetch_status_q(spark, sf):
    from quayside.operators.status import fetch_status

    e = D.table(spark, sf, "events").select("event_id", D.event_http_code().alias("http_code"),
                                            D.event_fetch_error().alias("fetch_error"))
    return e.select("*", fetch_status("http_code", "fetch_error").alias("status"))


AUDIT_SQL = f"""
audit AS (
  SELECT 'run-' || CAST(event_id AS VARCHAR) AS run_id, ts AS run_timestamp,
         'https://files.example/u' || CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d') || '.zip' AS url,
         'ds_' || CAST(user_id AS VARCHAR) AS landing_path, 'main' AS catalog, 'raw' AS schema,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CASE WHEN {EVENT_ERROR_SQL} IS NOT NULL THEN 'error: ' || {EVENT_ERROR_SQL}
              WHEN event_type = 'click' THEN 'not_found'
              WHEN event_type = 'error' THEN 'http_error_' || CAST({EVENT_CODE_SQL} AS VARCHAR)
              WHEN event_type = 'signup' THEN 'no_csv_found'
              WHEN event_type = 'purchase' THEN 'success'
              WHEN CAST(floor(value) AS BIGINT) % 2 = 1 THEN 'partial_success'
              ELSE 'write_failed' END AS download_status,
         event_type, event_id, value
  FROM events)"""


@query("audit_append", "WITH " + AUDIT_SQL.strip() + """
SELECT run_id, strftime(run_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS run_ts, url, landing_path, catalog, schema, year, month,
       download_status,
       CASE WHEN download_status = 'success' THEN NULL
            WHEN download_status = 'no_csv_found' THEN 'No CSV files found in zip archive'
            WHEN download_status = 'partial_success' THEN 'Only 1/2 files written successfully'
            WHEN download_status = 'write_failed' THEN 'Only 0/2 files written successfully'
            ELSE download_status END AS download_error_msg,
       CASE WHEN event_type = 'purchase' THEN 'p_' || CAST(event_id AS VARCHAR) || '.csv|readme.txt'
            WHEN event_type = 'view' THEN 'v_' || CAST(event_id AS VARCHAR) || '_a.csv|v_' || CAST(event_id AS VARCHAR) || '_b.csv'
            WHEN download_status = 'no_csv_found' THEN 'notes.txt'
            ELSE '' END AS files_in_zip,
       CASE WHEN event_type = 'purchase' THEN 'p_' || CAST(event_id AS VARCHAR) || '.csv:' || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR)
            WHEN download_status = 'partial_success' THEN 'v_' || CAST(event_id AS VARCHAR) || '_a.csv:' || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR)
            ELSE '' END AS files_written,
       CAST(CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'view' THEN 2 ELSE 0 END AS INTEGER) AS csv_count,
       CAST(CASE WHEN event_type = 'purchase' THEN 1 WHEN download_status = 'partial_success' THEN 1 ELSE 0 END AS INTEGER) AS success_count
FROM audit""")
def audit_append(spark, sf):
    path = scratch_dir(spark, "audit")
    rows = D.events_as_audit(D.table(spark, sf, "events"))
    half = F.col("run_timestamp") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    A.append_audit(rows.where(half), path)     # two appends: the table is their bag union
    A.append_audit(rows.where(~half), path)
    a = A.read_audit(spark, path)
    return a.select(
        "run_id", F.date_format("run_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("run_ts"), "url", "landing_path",
        "catalog", "schema", "year", "month", "download_status", "download_error_msg",
        F.array_join("files_in_zip", "|").alias("files_in_zip"),
        F.array_join(F.transform("files_written", lambda w: F.concat(w["filename"], F.lit(":"), w["size_bytes"].cast("string"))),
                     "|").alias("files_written"),
        "csv_count", "success_count")


@query("audit_rollup", """
WITH m AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id // 1000 AS VARCHAR) AS archive,
         event_type || '_' || CAST(event_id AS VARCHAR) || CASE WHEN event_type = 'view' THEN '.txt' ELSE '.csv' END AS member,
         CAST(floor(value * 100) AS BIGINT) AS size_bytes, event_type <> 'view' AS is_csv, event_type <> 'error' AS written
  FROM events)
SELECT archive,
       CAST(count(*) FILTER (WHERE is_csv) AS INTEGER) AS csv_count,
       CAST(count(*) AS INTEGER) AS member_count,
       CAST(count(*) FILTER (WHERE is_csv AND written) AS INTEGER) AS success_count,
       CAST(coalesce(sum(CASE WHEN is_csv AND written THEN size_bytes ELSE 0 END), 0) AS BIGINT) AS bytes_written,
       string_agg(member, '|' ORDER BY member) AS files_in_zip,
       coalesce(string_agg(CASE WHEN is_csv AND written THEN member || ':' || CAST(size_bytes AS VARCHAR) END, '|'
                           ORDER BY member, size_bytes), '') AS files_written
FROM m GROUP BY archive""")
def audit_rollup(spark, sf):
    r = A.audit_rollup(D.events_as_members(D.table(spark, sf, "events")), ["archive"])
    return r.select(
        "archive", "csv_count", "member_count", "success_count", "bytes_written",
        F.array_join("files_in_zip", "|").alias("files_in_zip"),
        F.array_join(F.transform("files_written", lambda w: F.concat(w["filename"], F.lit(":"), w["size_bytes"].cast("string"))),
                     "|").alias("files_written"))


@query("recent_success", "WITH " + AUDIT_SQL.strip() + f"""
SELECT DISTINCT landing_path, catalog, schema FROM audit
WHERE download_status = 'success' AND run_timestamp >= TIMESTAMP '{AUDIT_AS_OF}' - INTERVAL 1 DAY
ORDER BY landing_path""")
def recent_success(spark, sf):
    path = scratch_dir(spark, "audit")
    A.append_audit(D.events_as_audit(D.table(spark, sf, "events")), path)
    return A.recent_success(A.read_audit(spark, path), AUDIT_AS_OF)


@query("load_stats", """
SELECT event_type AS table_name, count(*) AS total_rows,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS latest_load_timestamp
FROM events GROUP BY event_type""")
def load_stats_q(spark, sf):
    """A table loaded in two runs, registered after each and read by its full name."""
    root = scratch_dir(spark, "load-events")
    land, tbl, ck = f"{root}/landing/events", f"{root}/tables/events", f"{root}/checkpoints/events"
    events = D.table(spark, sf, "events")
    name = "default.quayside_events_" + root.rsplit("-", 1)[-1]
    half = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (half, ~half):
        D.land_events(events, land, part)
        r = ingest_table(spark, land, tbl, ck, "events", IngestOptions(as_of=AS_OF)).collect()[0]
        if r.status != "success":
            raise RuntimeError(f"ingest failed: {r.message}")
        register_loaded_table(spark, name, tbl, ck, "Events")
    # Each event type plays one loaded table: per-table stats in one grouped aggregate.
    return A.load_stats(spark.table(name), "ts", [F.col("event_type").alias("table_name")])


LOAD_RESULTS_SQL = """
res AS (
  SELECT event_type,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'no_source_data' ELSE 'success' END AS status,
         CASE WHEN event_type = 'signup' THEN 0 ELSE count(*) END AS total_rows,
         CASE WHEN event_type = 'signup' THEN 0 ELSE count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') END AS rows_added
  FROM events GROUP BY event_type)"""


@query("load_summary", "WITH " + LOAD_RESULTS_SQL.strip() + """,
agg AS (
  SELECT count(*) AS tables_processed,
         count(*) FILTER (WHERE status IN ('success', 'no_source_data')) AS successful,
         count(*) FILTER (WHERE status NOT IN ('success', 'no_source_data')) AS failed,
         CAST(coalesce(sum(total_rows) FILTER (WHERE status IN ('success', 'no_source_data')), 0) AS BIGINT) AS total_rows_loaded,
         CAST(coalesce(sum(rows_added) FILTER (WHERE status IN ('success', 'no_source_data')), 0) AS BIGINT) AS rows_added
  FROM res)
SELECT 'backfill' AS mode, '2024-01-31T00:00:00' AS timestamp, tables_processed, successful, failed, total_rows_loaded,
       rows_added,
       '{"mode":"backfill","timestamp":"2024-01-31T00:00:00","processing":{"tables_processed":' || CAST(tables_processed AS VARCHAR)
       || ',"successful":' || CAST(successful AS VARCHAR) || ',"failed":' || CAST(failed AS VARCHAR)
       || ',"total_rows_loaded":' || CAST(total_rows_loaded AS VARCHAR)
       || '},"configuration":{"catalog":"main","schema":"raw"}}' AS summary_json
FROM agg""")
def load_summary_q(spark, sf):
    e = D.table(spark, sf, "events")
    t = F.col("event_type")
    res = e.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).alias("n_new"),
    ).select(
        F.when(t == "error", "failed").when(t == "signup", "no_source_data").otherwise("success").alias("status"),
        F.when(t == "signup", F.lit(0)).otherwise(F.col("n")).cast("long").alias("total_rows"),
        F.when(t == "signup", F.lit(0)).otherwise(F.col("n_new")).cast("long").alias("rows_added"),
    )
    s = A.load_summary(res, "backfill", "2024-01-31 00:00:00", "main", "raw")
    return s.select("mode", "timestamp", "processing.tables_processed", "processing.successful", "processing.failed",
                    "processing.total_rows_loaded", "rows_added", "summary_json")


@query("load_gaps", """
SELECT DISTINCT 'https://files.example/u' || CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d') || '.zip' AS url
FROM events
EXCEPT
SELECT 'https://files.example/u' || CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d') || '.zip' AS url
FROM events WHERE event_type = 'purchase'""")
def load_gaps_q(spark, sf):
    e = D.table(spark, sf, "events")
    expected = e.select(D.event_url().alias("url")).distinct()
    path = scratch_dir(spark, "audit")
    A.append_audit(D.events_as_audit(e), path)
    return A.load_gaps(expected, A.read_audit(spark, path))


def _order_months(orders: DataFrame) -> DataFrame:
    """Every customer's months from the first to the last year of its orders, one expected file each."""
    years = orders.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("s"), F.max(F.year("o_orderdate")).alias("e"))
    months = years.select(F.col("o_custkey").alias("dataset"), F.explode(periods_between("s", "e")).alias("period"))
    return months.withColumn("url", D.order_month_url("dataset", "period"))


@query("gap_ranges", """
WITH r AS (SELECT o_custkey, min(year(o_orderdate)) AS s, max(year(o_orderdate)) AS e FROM orders GROUP BY o_custkey),
g AS (SELECT o_custkey AS dataset, CAST(unnest(generate_series(make_date(s, 1, 1), make_date(e, 12, 1), INTERVAL 1 MONTH)) AS DATE) AS period FROM r),
m AS (
  SELECT g.dataset, g.period, row_number() OVER (PARTITION BY g.dataset ORDER BY g.period) AS n
  FROM g LEFT JOIN (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period FROM orders WHERE o_orderstatus <> 'P') o
    ON o.o_custkey = g.dataset AND o.period = g.period
  WHERE o.period IS NULL),
i AS (SELECT dataset, period, CAST(date_diff('month', DATE '1970-01-01', period) AS BIGINT) - n AS island FROM m)
SELECT dataset, min(period) AS first, max(period) AS last, count(*) AS periods, count(*) AS files FROM i GROUP BY dataset, island""")
def gap_ranges_q(spark, sf):
    """Months without a successful file, as ranges per customer."""
    orders = D.table(spark, sf, "orders")
    path = scratch_dir(spark, "audit")
    A.append_audit(D.orders_as_audit(orders, AS_OF), path)
    return A.gap_ranges(_order_months(orders), A.read_audit(spark, path))


STREAK_SQL = "WITH " + AUDIT_SQL.strip() + """,
a AS (SELECT regexp_extract(url, '^.*/u[0-9]+') || '.zip' AS url, run_timestamp, run_id, download_status AS status FROM audit),
c AS (
  SELECT *, CASE WHEN row_number() OVER w = 1 OR lag(status) OVER w IS DISTINCT FROM status THEN 1 ELSE 0 END AS new
  FROM a WINDOW w AS (PARTITION BY url ORDER BY run_timestamp, run_id)),
n AS (SELECT *, sum(new) OVER (PARTITION BY url ORDER BY run_timestamp, run_id ROWS UNBOUNDED PRECEDING) AS run FROM c),
runs AS (
  SELECT url, CAST(run AS BIGINT) AS run, any_value(status) AS status, count(*) AS attempts, min(run_timestamp) AS since, max(run_timestamp) AS until
  FROM n GROUP BY url, run)"""


def _event_audit_by_user(spark, sf) -> DataFrame:
    path = scratch_dir(spark, "audit")
    rows = D.events_as_audit(D.table(spark, sf, "events"))
    A.append_audit(rows.withColumn("url", F.concat(F.regexp_extract("url", "^.*/u[0-9]+", 0), F.lit(".zip"))), path)
    return A.read_audit(spark, path)


def _stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


@query("status_runs", STREAK_SQL + """
SELECT url, run, status, attempts, strftime(since, '%Y-%m-%d %H:%M:%S.%f') AS since, strftime(until, '%Y-%m-%d %H:%M:%S.%f') AS until FROM runs""")
def status_runs_q(spark, sf):
    return A.status_runs(_event_audit_by_user(spark, sf)).select("url", "run", "status", "attempts", _stamp("since"), _stamp("until"))


@query("failure_streaks", STREAK_SQL + """,
k AS (SELECT url, max(run) AS last_run, max(CASE WHEN status = 'success' THEN run END) AS ok_run FROM runs GROUP BY url)
SELECT url, sum(r.attempts)::BIGINT AS attempts, max(CASE WHEN run = last_run THEN status END) AS current_status,
       max(CASE WHEN run = last_run THEN r.attempts END) AS streak,
       strftime(max(CASE WHEN run = last_run THEN since END), '%Y-%m-%d %H:%M:%S.%f') AS streak_since,
       strftime(max(CASE WHEN status = 'success' THEN until END), '%Y-%m-%d %H:%M:%S.%f') AS last_success,
       coalesce(sum(CASE WHEN run > coalesce(ok_run, 0) THEN r.attempts END), 0)::BIGINT AS failed_since
FROM runs r JOIN k USING (url) GROUP BY url""")
def failure_streaks_q(spark, sf):
    s = A.failure_streaks(_event_audit_by_user(spark, sf))
    return s.select("url", "attempts", "current_status", "streak", _stamp("streak_since"), _stamp("last_success"), "failed_since")


@query("audit_members", """
SELECT 'run' AS run_id, 'https://files.example/u' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id // 1000 AS VARCHAR) || '.zip' AS url,
       event_type || '_' || CAST(event_id AS VARCHAR) || CASE WHEN event_type = 'view' THEN '.txt' ELSE '.csv' END AS member_path,
       CAST(floor(value * 100) AS BIGINT) AS size_bytes, event_type <> 'view' AS is_csv, event_type <> 'error' AS written
FROM events""")
def audit_members_q(spark, sf):
    """The members behind the lists of the audit, a row each."""
    m = D.events_as_members(D.table(spark, sf, "events"))
    path = scratch_dir(spark, "audit-members")
    url = F.concat(F.lit("https://files.example/"), F.col("archive"), F.lit(".zip"))
    A.append_audit_members(m.select(F.lit("run").alias("run_id"), F.lit(AS_OF).cast("timestamp").alias("run_timestamp"), F.col("archive").alias("task_id"), url.alias("url"),
                                    F.col("member").alias("member_path"), F.col("member").alias("filename"), "size_bytes", "is_csv", "written"), path)
    return A.read_audit_members(spark, path).select("run_id", "url", "member_path", "size_bytes", "is_csv", "written")


# =========================================================================== tables and readers

@query("table_comment", "SELECT c_custkey, c_name, 'Customer''s reference data' AS table_comment FROM customer")
def table_comment(spark, sf):
    from quayside.streaming.tables import ensure_table, table_comment as read_comment

    path = scratch_dir(spark, "table-comment")
    customer = D.table(spark, sf, "customer")
    customer.write.parquet(path)
    name = "quayside_customer_" + path.rsplit("-", 1)[-1]
    ensure_table(spark, name, path, customer.schema, "Customer's reference data")
    comment = read_comment(spark, name)
    return spark.table(name).select("c_custkey", "c_name", F.lit(comment).alias("table_comment"))


# Rows per JSON-array document: customer keys are unique, so a document is bounded.
ROWS_PER_JSON_DOCUMENT = 1000


@query("read_json_array", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def read_json_array_q(spark, sf):
    path = scratch_dir(spark, "json-array")
    c = D.table(spark, sf, "customer")
    # The table as many JSON-array documents (one file each) of at most 1,000 objects.
    doc = F.floor(F.col("c_custkey") / ROWS_PER_JSON_DOCUMENT).alias("_doc")
    (c.groupBy(doc).agg(F.to_json(F.collect_list(F.struct(*c.columns))).alias("value"))
     .write.partitionBy("_doc").text(path))
    j = read_json_array(spark, path)
    return j.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
                    F.col("c_nationkey").cast("int").alias("c_nationkey"),
                    F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment")


@query("read_csv_strings", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
FROM customer""")
def read_csv_strings_q(spark, sf):
    path = scratch_dir(spark, "csv-strings")
    D.table(spark, sf, "customer").write.option("header", True).csv(path)
    return read_csv_strings(spark, path).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
