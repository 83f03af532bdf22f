"""Inputs for the registered queries, derived by Spark from the driver's tables.

Everything here is written below the shared checkpoint folder (``scratch_dir``),
never next to the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.calendar import month_name, quarter_label
from quayside.functions.names import snake_case_col
from quayside.operators.status import fetch_status, landing_message, landing_outcome
from quayside.sources.catalog import write_catalog


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------- catalog

# Templates per catalog document: supplier keys are unique, so a document is bounded.
TEMPLATES_PER_DOCUMENT = 100


def supplier_catalog_rows(supplier: DataFrame) -> DataFrame:
    """One template per supplier; ``s_suppkey % 5`` decides its parameters:
    0 none, 1 year, 2 year+quarter, 3 month_name+year, 4 an unknown parameter.
    Documents hold at most 100 templates (``doc``, zero-padded so file order is key
    order); the landing path is ``region_{s_nationkey % 5}``, shared by many templates."""
    rk = F.pmod(F.col("s_suppkey"), F.lit(5))
    slug = snake_case_col("s_name")
    suffix = (F.when(rk == 0, F.lit("/latest.zip"))
              .when(rk == 1, F.lit("/{year}.zip"))
              .when(rk == 2, F.lit("/{year}-{quarter}.zip"))
              .when(rk == 3, F.lit("/{month_name}-{year}.zip"))
              .otherwise(F.lit("/{region}/{month_name}-{year}.zip")))
    params = (F.when(rk == 0, F.array().cast("array<string>"))
              .when(rk == 1, F.array(F.lit("year")))
              .when(rk == 2, F.array(F.lit("year"), F.lit("quarter")))
              .when(rk == 3, F.array(F.lit("month_name"), F.lit("year")))
              .otherwise(F.array(F.lit("month_name"), F.lit("year"), F.lit("region"))))
    doc = F.lpad(F.floor(F.col("s_suppkey") / TEMPLATES_PER_DOCUMENT).cast("string"), 8, "0")
    return supplier.select(
        "s_suppkey", doc.alias("doc"),
        F.concat(F.lit("https://files.example/"), slug, suffix).alias("url_pattern"),
        slug.alias("table_name"),
        params.alias("parameters"),
        F.concat(F.lit("region_"), F.pmod(F.col("s_nationkey"), F.lit(5)).cast("string")).alias("landing_path"),
        F.concat(F.col("s_name"), F.lit("'s files")).alias("comment"),
        F.when(rk == 1, F.create_map(F.lit("code"), F.lit("string"), F.lit("amount"), F.lit("double"))).alias("types"),
    )


def write_supplier_catalog(supplier: DataFrame, path: str) -> None:
    """Catalog documents of at most 100 templates each, entries in supplier-key order."""
    write_catalog(supplier_catalog_rows(supplier), path, group_col="doc", order_col="s_suppkey")


# --------------------------------------------------------------------------- CSV landings

# Unfriendly headers whose snake-case form is the table's column name.
ORDERS_HEADERS = {
    "o_orderkey": "O OrderKey",
    "o_custkey": "o-custkey",
    "o_orderstatus": "O.OrderStatus",
    "o_totalprice": "o totalprice ($)",
    "o_orderdate": "O_OrderDate",
    "o_orderpriority": "(o_orderpriority)",
}
PART_HEADERS = {
    "p_partkey": "P PartKey",
    "p_name": "P-Name",
    "p_brand": "p.brand",
    "p_type": "P_TYPE ",
    "p_size": "(p size)",
    "p_retailprice": "P RetailPrice ($)",
}

# Rows per landed CSV file; a month with more rows is split into several files.
ROWS_PER_FILE = 200_000


def land_csv_by_month(df: DataFrame, date_col: str, headers: dict[str, str], path: str) -> None:
    """Write ``df`` as CSV files with the given headers under year=Y/month=MM."""
    out = df.select(
        *[F.col(k).alias(v) for k, v in headers.items()],
        F.year(date_col).alias("year"),
        F.lpad(F.month(date_col).cast("string"), 2, "0").alias("month"),
    )
    # Rebalance by (year, month): hash-partitioned so a task holds few months (few
    # files), while AQE coalesces small partitions and splits a hot month by size
    # over several tasks. No sampling pass over the input (a range repartition would
    # scan it once more).
    (out.hint("rebalance", "year", "month")
     .write.mode("append").option("header", True)
     .option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy("year", "month").csv(path))


def land_orders(orders: DataFrame, path: str, where: Column | None = None) -> None:
    land_csv_by_month(orders if where is None else orders.where(where), "o_orderdate", ORDERS_HEADERS, path)


def land_orders_unevenly(orders: DataFrame, path: str) -> None:
    """Orders before 1998 in monthly files, later ones in yearly files, some twelve times as big."""
    day = F.when(F.year("o_orderdate") < 1998, F.col("o_orderdate")).otherwise(F.date_trunc("year", "o_orderdate"))
    land_csv_by_month(orders.withColumn("_day", day), "_day", ORDERS_HEADERS, path)


EVENT_HEADERS = {"event_id": "Event ID", "ts_text": "TS", "user_id": "User-ID", "event_type": "Event Type", "value": "Value", "props": "Props"}


def land_events(events: DataFrame, path: str, where: Column) -> None:
    """Events as CSV files by month, times with microseconds."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    land_csv_by_month(events.where(where).withColumn("ts_text", text), "ts", EVENT_HEADERS, path)


# --------------------------------------------------------------------------- archives

# Documents per archive: doc ids are unique, so an archive holds at most this many
# members whatever the skew of ``source``.
DOCS_PER_ARCHIVE = 1000


def document_archive_name() -> Column:
    chunk = F.floor(F.col("doc_id") / DOCS_PER_ARCHIVE)
    return F.concat(F.col("source"), F.lit("-"), F.lpad(chunk.cast("string"), 5, "0"), F.lit(".zip"))


def document_member_name() -> Column:
    ext = F.when(F.col("lang") == "de", F.lit(".txt")).otherwise(F.lit(".csv"))
    return F.concat(F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), ext)


def build_document_archives(documents: DataFrame, out_dir: str) -> DataFrame:
    """Zip archives written by the executors, one per (source, doc_id block).

    Members are ``{lang}/{doc_id}.csv`` holding the document text (``.txt`` for
    German), plus an empty ``meta/`` folder entry. Returns (archive, members).
    """
    from quayside.session import ship_package

    ship_package(documents.sparkSession)
    base = out_dir.rstrip("/")
    src = documents.select(document_archive_name().alias("archive"), document_member_name().alias("member"), "text")

    def build(pdf):
        import io
        import zipfile

        import pandas as pd

        from quayside.plans.derive import _write_bytes

        name = pdf["archive"].iloc[0]
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr(zipfile.ZipInfo("meta/"), b"")
            for member, text in sorted(zip(pdf["member"], pdf["text"])):
                zf.writestr(member, text.encode("utf-8"))
        _write_bytes(f"{base}/{name}", buf.getvalue())
        return pd.DataFrame({"archive": [name], "members": [len(pdf)]})

    return src.groupBy("archive").applyInPandas(build, "archive string, members long")


# Documents per archive of one CSV member.
DOCS_PER_CSV = 200


def quotable(text: Column) -> Column:
    """Text without the bytes that CSV quoting changes: quotes, backslashes and carriage returns."""
    for sign, other in (('"', "'"), ("\\", "/"), ("\r", "")):  # as whole strings; translate goes by the code point
        text = F.replace(text, F.lit(sign), F.lit(other))
    return F.coalesce(text, F.lit(""))


def build_document_csv_archives(documents: DataFrame, out_dir: str) -> DataFrame:
    """Zip archives of one member ``docs.csv`` each, whose quoted texts hold line ends, for blocks of
    ``DOCS_PER_CSV`` document ids."""
    from quayside.session import ship_package

    ship_package(documents.sparkSession)
    base = out_dir.rstrip("/")
    block = F.floor(F.col("doc_id") / DOCS_PER_CSV)
    line = F.concat(F.col("doc_id").cast("string"), F.lit(',"'), quotable(F.col("text")), F.lit('"'))
    rows = documents.select(F.concat(F.lit("docs-"), block.cast("string"), F.lit(".zip")).alias("archive"), line.alias("line"))

    def build(pdf):
        import io
        import zipfile

        import pandas as pd

        from quayside.plans.derive import _write_bytes

        buf, name = io.BytesIO(), pdf["archive"].iloc[0]
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as zf:
            zf.writestr("docs.csv", "Doc ID,Text\n" + "\n".join(sorted(pdf["line"])))
        _write_bytes(f"{base}/{name}", buf.getvalue())
        return pd.DataFrame({"archive": [name], "members": [1]})

    return rows.groupBy("archive").applyInPandas(build, "archive string, members long")


def _write_bytes(path: str, data: bytes) -> None:
    """Write a whole file from a task (staging name, then moved: retries never interleave)."""
    from quayside.streaming.fsutil import write_file

    write_file(path, [data])


# --------------------------------------------------------------------------- events as fetches

def event_http_code() -> Column:
    t = F.col("event_type")
    return (F.when(t == "click", F.lit(404))
            .when(t == "error", F.lit(500) + F.pmod(F.floor("value"), F.lit(4)))
            .when(t == "signup", F.lit(302))
            .otherwise(F.lit(200))).cast("int")


def event_fetch_error() -> Column:
    return F.when((F.col("event_type") == "signup") & (F.col("value") < 5),
                  F.concat(F.lit("timeout "), F.col("props")))


def event_url() -> Column:
    return F.concat(F.lit("https://files.example/u"), F.col("user_id").cast("string"), F.lit("/"),
                    F.date_format("ts", "yyyy-MM-dd"), F.lit(".zip"))


def events_as_audit(events: DataFrame) -> DataFrame:
    """Each event is one archive fetch; its type decides what the archive held."""
    t = F.col("event_type")
    eid = F.col("event_id").cast("string")
    size = F.floor(F.col("value") * 100).cast("long")
    state = fetch_status("http_code", "fetch_error")
    csv_count = F.when(t == "purchase", 1).when(t == "view", 2).otherwise(0)
    success_count = (F.when(t == "purchase", 1).when(t == "view", F.pmod(F.floor("value"), F.lit(2)))
                     .otherwise(0))
    in_zip = (F.when(t == "purchase", F.array(F.concat(F.lit("p_"), eid, F.lit(".csv")), F.lit("readme.txt")))
              .when(t == "view", F.array(F.concat(F.lit("v_"), eid, F.lit("_a.csv")),
                                         F.concat(F.lit("v_"), eid, F.lit("_b.csv"))))
              .when(t == "signup", F.array(F.lit("notes.txt"))))
    wf = lambda name: F.array(F.struct(name.alias("filename"), size.alias("size_bytes")))
    written = (F.when(t == "purchase", wf(F.concat(F.lit("p_"), eid, F.lit(".csv"))))
               .when((t == "view") & (F.pmod(F.floor("value"), F.lit(2)) == 1),
                     wf(F.concat(F.lit("v_"), eid, F.lit("_a.csv")))))
    base = events.select(
        "*", event_http_code().alias("http_code"), event_fetch_error().alias("fetch_error"))
    staged = base.select(
        "*",
        state.alias("fetch_state"),
        csv_count.cast("int").alias("csv_count"),
        success_count.cast("int").alias("success_count"),
    )
    status = landing_outcome(F.col("fetch_state") == "success", F.lit(True), "csv_count", "success_count", "fetch_state")
    with_status = staged.withColumn("download_status", status)
    return with_status.select(
        F.concat(F.lit("run-"), eid).alias("run_id"),
        F.col("ts").cast("timestamp").alias("run_timestamp"),
        event_url().alias("url"),
        F.concat(F.lit("ds_"), F.col("user_id").cast("string")).alias("landing_path"),
        F.lit("main").alias("catalog"),
        F.lit("raw").alias("schema"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        "download_status",
        landing_message("download_status", "csv_count", "success_count").alias("download_error_msg"),
        F.when(F.col("fetch_state") == "success", in_zip).alias("files_in_zip"),
        F.when(F.col("fetch_state") == "success", written).alias("files_written"),
        F.when(F.col("fetch_state") == "success", F.col("csv_count")).otherwise(0).alias("csv_count"),
        F.when(F.col("fetch_state") == "success", F.col("success_count")).otherwise(0).alias("success_count"),
    )


def order_month_url(dataset: Column | str, period: Column | str) -> Column:
    return F.concat(F.lit("https://files.example/c"), F.col(dataset).cast("string"), F.lit("/"), F.date_format(period, "yyyy-MM"), F.lit(".zip"))


def orders_as_audit(orders: DataFrame, at: str) -> DataFrame:
    """Each order is the fetch of its customer's file of its month; pending orders stand for files not found."""
    rows = orders.select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("dataset"), F.trunc("o_orderdate", "month").alias("period"))
    return rows.select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"), F.lit(at).cast("timestamp").alias("run_timestamp"),
        order_month_url("dataset", "period").alias("url"), F.col("dataset").cast("string").alias("landing_path"),
        F.year("period").alias("year"), F.month("period").alias("month"),
        F.when(F.col("o_orderstatus") == "P", "not_found").otherwise("success").alias("download_status"))


# Events per archive: ids are unique, so an archive holds at most this many members
# whatever the skew of ``user_id`` (a zip's member list is one audit row).
EVENTS_PER_ARCHIVE = 1000


def events_as_members(events: DataFrame) -> DataFrame:
    """Each event is one member of an archive of its user: ``u{user}-{event_id block}``."""
    t = F.col("event_type")
    member = F.concat(t, F.lit("_"), F.col("event_id").cast("string"),
                      F.when(t == "view", F.lit(".txt")).otherwise(F.lit(".csv")))
    block = F.floor(F.col("event_id") / EVENTS_PER_ARCHIVE).cast("string")
    return events.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), block).alias("archive"),
        member.alias("member"),
        F.floor(F.col("value") * 100).cast("long").alias("size_bytes"),
        F.lower(member).endswith(".csv").alias("is_csv"),
        (t != "error").alias("written"),
    )


# --------------------------------------------------------------------------- unfriendly CSV files

# Keys per block of the messy landing, a file of some 1 MB for each kind.
MESSY_KEYS = 50_000


def land_messy_orders(orders: DataFrame, path: str) -> None:
    """Orders as CSV files of four kinds, by key: plain, after blank lines, with CR line ends,
    and with a newline inside a quoted header; and one file of blank lines. A file holds the rows
    of one kind and block of ``MESSY_KEYS`` keys, built as one text value."""
    kind, block = F.pmod("o_orderkey", F.lit(4)), F.floor(F.col("o_orderkey") / MESSY_KEYS)
    cells = [F.col(c).cast("string") for c in ORDERS_HEADERS if c != "o_orderdate"]
    cells.insert(4, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    header = ",".join(ORDERS_HEADERS.values())
    quoted = ",".join(f'"{h.replace(" ", chr(10))}"' for h in ORDERS_HEADERS.values())
    lead = F.when(kind == 1, F.lit("\n\n" + header)).when(kind == 3, F.lit(quoted)).otherwise(F.lit(header))
    line = orders.select(kind.alias("kind"), block.alias("block"), lead.alias("lead"), F.concat_ws(",", *cells).alias("line"))
    text = line.groupBy("kind", "block", "lead").agg(F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("rows"))
    text = text.select("kind", "block", F.concat("lead", F.lit("\n"), "rows").alias("value"))
    # A CR file: its header holds no newline, so all newlines are line ends.
    text = text.withColumn("value", F.when(F.col("kind") == 2, F.replace("value", F.lit("\n"), F.lit("\r"))).otherwise(F.col("value")))
    blank = orders.sparkSession.createDataFrame([(4, 0, "\n\n")], "kind int, block long, value string")
    text.unionByName(blank).write.partitionBy("kind", "block").text(path)


# --------------------------------------------------------------------------- a whole run from orders


# Order keys per archive of a month: an archive holds a bounded number of rows however many a priority has.
ORDER_KEYS_PER_BLOCK = 1_000_000


def _order_block() -> Column:
    return F.floor(F.col("o_orderkey") / ORDER_KEYS_PER_BLOCK).cast("string")


def order_catalog(orders: DataFrame) -> DataFrame:
    """One monthly template per order priority and block of order keys; priorities share two landing
    paths. Keys of customers are text, whatever they look like."""
    dataset = F.concat(F.lit("orders_"), F.pmod(F.col("priority").cast("int"), F.lit(2)).cast("string"))
    return orders.select(F.substring("o_orderpriority", 1, 1).alias("priority"), _order_block().alias("block")).distinct().select(
        F.concat(F.lit("block"), F.col("block")).alias("doc"), "priority",
        F.concat(F.lit("https://files.example/p"), F.col("priority"), F.lit("/b"), F.col("block"), F.lit("/orders-{month_name}-{year}.zip")).alias("url_pattern"),
        dataset.alias("table_name"), F.array(F.lit("month_name"), F.lit("year")).alias("parameters"), dataset.alias("landing_path"),
        F.lit("Orders' files").alias("comment"), F.create_map(F.lit("o_custkey"), F.lit("string")).alias("types"),
    )


def build_order_archives(orders: DataFrame, out_dir: str) -> DataFrame:
    """A zip archive per priority, block of order keys and month, ``p{k}/b{block}/orders-{month_name}-{year}.zip``:
    base names repeat over the priorities and every archive's only CSV member is ``data.csv``."""
    from quayside.session import ship_package

    ship_package(orders.sparkSession)
    base = out_dir.rstrip("/")
    name = F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1), F.lit("/b"), _order_block(), F.lit("/orders-"), month_name(F.month("o_orderdate")),
                    F.lit("-"), F.year("o_orderdate").cast("string"), F.lit(".zip"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("string"))

    def build(pdf):
        import io
        import zipfile

        import pandas as pd

        from quayside.plans.derive import _write_bytes

        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("readme.txt", "monthly orders")
            zf.writestr("data.csv", "O OrderKey,O-CustKey,O TotalPrice ($)\n" + "\n".join(sorted(pdf["line"])) + "\n")
        archive = pdf["archive"].iloc[0]
        _write_bytes(f"{base}/{archive}", buf.getvalue())
        return pd.DataFrame({"archive": [archive], "rows": [len(pdf)]})

    return orders.select(name.alias("archive"), line.alias("line")).groupBy("archive").applyInPandas(build, "archive string, rows long")
