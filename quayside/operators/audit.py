"""Audit table: one row per archive fetch, and the queries over it.

The table is a Parquet folder with a fixed schema, partitioned by run date; appends never infer
types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from quayside.streaming import fsutil

# Partition column of both audit tables, beside the fixed columns.
RUN_DATE = "run_date"

WRITTEN_FILE = StructType([StructField("filename", StringType()), StructField("size_bytes", LongType())])

# The audit table's columns.
AUDIT_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("run_timestamp", TimestampType()),
    StructField("url", StringType()),
    StructField("landing_path", StringType()),
    StructField("catalog", StringType()),
    StructField("schema", StringType()),
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("download_status", StringType()),
    StructField("download_error_msg", StringType()),
    StructField("files_in_zip", ArrayType(StringType())),
    StructField("files_written", ArrayType(WRITTEN_FILE)),
    StructField("csv_count", IntegerType()),
    StructField("success_count", IntegerType()),
])


# One row per archive member of a fetch: the exact, unbounded detail behind the
# per-archive lists of the audit row.
AUDIT_MEMBER_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("run_timestamp", TimestampType()),
    StructField("task_id", StringType()),
    StructField("url", StringType()),
    StructField("member_path", StringType()),
    StructField("filename", StringType()),
    StructField("size_bytes", LongType()),
    StructField("is_csv", BooleanType()),
    StructField("written", BooleanType()),
])


def conform_audit(df: DataFrame) -> DataFrame:
    """Select and cast to the audit schema (missing lists become empty)."""
    cols = []
    for f in AUDIT_SCHEMA.fields:
        if f.name in df.columns:
            c = F.col(f.name).cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, ArrayType):
            c = F.coalesce(c, F.array().cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _append_by_date(df: DataFrame, path: str) -> None:
    """Few files a date; a date with most rows is split over tasks by size."""
    dated = df.withColumn(RUN_DATE, F.to_date("run_timestamp")).hint("rebalance", RUN_DATE)
    dated.write.mode("append").partitionBy(RUN_DATE).parquet(path)


def _read_by_date(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table with its partition column; empty and typed before the first append."""
    whole = StructType([*schema.fields, StructField(RUN_DATE, DateType())])
    if not fsutil.has_entries(spark, path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path)


def append_audit(df: DataFrame, path: str) -> None:
    """Append audit rows (conformed to the schema) to the audit folder, partitioned by run date."""
    _append_by_date(conform_audit(df), path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return _read_by_date(spark, path, AUDIT_SCHEMA)


def append_audit_members(df: DataFrame, path: str) -> None:
    _append_by_date(df.select(*[F.col(f.name).cast(f.dataType) for f in AUDIT_MEMBER_SCHEMA.fields]), path)


def read_audit_members(spark: SparkSession, path: str) -> DataFrame:
    return _read_by_date(spark, path, AUDIT_MEMBER_SCHEMA)


def audit_rollup(members: DataFrame, keys: list[str]) -> DataFrame:
    """Per archive: csv_count, member_count, success_count, bytes_written and the
    sorted member and written-file lists.

    ``members`` has the ``keys``, ``member`` (basename), ``size_bytes``, ``is_csv``,
    ``written``. An archive with no member rows does not appear.
    """
    written = F.col("written") & F.col("is_csv")
    return members.groupBy(*keys).agg(
        F.count_if(F.col("is_csv")).cast("int").alias("csv_count"),
        F.count(F.col("member")).cast("int").alias("member_count"),
        F.count_if(written).cast("int").alias("success_count"),
        F.sum(F.when(written, F.col("size_bytes")).otherwise(F.lit(0))).cast("long").alias("bytes_written"),
        F.sort_array(F.collect_list("member")).alias("files_in_zip"),
        F.sort_array(F.collect_list(F.when(written, F.struct(
            F.col("member").alias("filename"), F.col("size_bytes").cast("long").alias("size_bytes"))))).alias("files_written"),
    )


def recent_success(audit: DataFrame, as_of, window: str = "1 DAY",
                   statuses: tuple[str, ...] = ("success",)) -> DataFrame:
    """Distinct (landing_path, catalog, schema) with a status in ``statuses`` at or after
    ``as_of - window``, ordered by landing_path."""
    since = F.lit(str(as_of)).cast("timestamp") - F.expr(f"INTERVAL {window}")
    if RUN_DATE in audit.columns:  # reads the partitions of the window only
        audit = audit.where(F.col(RUN_DATE) >= since.cast("date"))
    return (
        audit.where(F.col("download_status").isin(*statuses) & (F.col("run_timestamp") >= since))
        .select("landing_path", "catalog", "schema")
        .distinct()
        .orderBy("landing_path")
    )


def load_stats(table: DataFrame, ts_col: str = "_load_timestamp", group_by: list | None = None) -> DataFrame:
    """total_rows and latest_load_timestamp (string, NULL when empty) in one aggregate,
    optionally per group (several tables stacked in one frame)."""
    target = table.groupBy(*group_by) if group_by else table
    return target.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.date_format(F.max(ts_col), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("latest_load_timestamp"),
    )


def load_summary(results: DataFrame, mode: str, as_of, catalog: str, schema: str) -> DataFrame:
    """Run summary from per-table results (status, total_rows, rows_added).

    Tables with status 'success' or 'no_source_data' count as successful; the row
    sum is over table totals, as in the reference, with ``rows_added`` beside it.
    """
    ok = F.col("status").isin("success", "no_source_data")
    agg = results.agg(
        F.count(F.lit(1)).alias("tables_processed"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(ok, F.col("total_rows"))), F.lit(0)).cast("long").alias("total_rows_loaded"),
        F.coalesce(F.sum(F.when(ok, F.col("rows_added"))), F.lit(0)).cast("long").alias("rows_added"),
    )
    out = agg.select(
        F.lit(mode).alias("mode"),
        F.date_format(F.lit(str(as_of)).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.struct("tables_processed", "successful", "failed", "total_rows_loaded").alias("processing"),
        F.struct(F.lit(catalog).alias("catalog"), F.lit(schema).alias("schema")).alias("configuration"),
        "rows_added",
    )
    return out.withColumn("summary_json", F.to_json(F.struct("mode", "timestamp", "processing", "configuration")))


def load_gaps(expected: DataFrame, audit: DataFrame, statuses: tuple[str, ...] = ("success",)) -> DataFrame:
    """Expected files without an audit row in ``statuses`` (anti join on url)."""
    done = audit.where(F.col("download_status").isin(*statuses)).select("url")
    return expected.join(done, "url", "left_anti")


def gap_ranges(expected: DataFrame, audit: DataFrame, statuses: tuple[str, ...] = ("success",)) -> DataFrame:
    """Runs of missing periods per dataset: (dataset, first, last, periods, files).

    ``expected``: (dataset, period, url), any number of files a period; a period is missing when one of
    its files has no audit row in ``statuses``. Neighbours are neighbouring *expected* periods, so a
    quarterly dataset has runs of quarters. Files without a period (static ones) are a run of their own,
    first and last NULL. A dataset's window holds its periods, not its files.

    Of the join's rows only the files that arrived go on, counted by period. These counts and those of the
    expected files (computed again, which costs less than to shuffle them) meet by dataset, once: sum,
    window and islands take place there."""
    done = audit.where(F.col("download_status").isin(*statuses)).select("url").distinct()
    arrived = expected.join(done, "url", "left_semi").groupBy("dataset", "period").agg((-F.count("*")).alias("n"))
    counts = expected.groupBy("dataset", "period").agg(F.count("*").alias("n")).unionAll(arrived)
    periods = counts.repartition("dataset").groupBy("dataset", "period").agg(F.sum("n").alias("files"))
    present = F.col("files") == 0
    order = Window.partitionBy("dataset").orderBy("period")
    # all periods of one run of missing ones have seen equally many present ones; no period, no neighbour
    island = F.when(F.col("period").isNotNull(), F.count_if(present).over(order))
    return (periods.withColumn("_island", island).where(~present).groupBy("dataset", "_island")
            .agg(F.min("period").alias("first"), F.max("period").alias("last"), F.count("*").alias("periods"), F.sum("files").alias("files"))
            .drop("_island"))


def _runs(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Neighbouring rows of equal status as one: attempts added, first and last time, numbered by ``run``."""
    by = Window.partitionBy(*key).orderBy(*order)
    changed = ~F.col("status").eqNullSafe(F.lag("status").over(by)) | (F.row_number().over(by) == 1)
    # the running count of changes numbers the runs
    numbered = rows.withColumn("_new", changed.cast("int")).withColumn("run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*key, "run").agg(F.first("status").alias("status"), F.sum("attempts").alias("attempts"),
                                             F.min("since").alias("since"), F.max("until").alias("until"))


def status_runs(audit: DataFrame, key: str = "url") -> DataFrame:
    """Runs of attempts with one status, per ``key``, in time: (key, run, status, attempts, since, until).

    Runs are made within each day first (the audit's partitions), then neighbouring runs of equal status are
    joined, so the second window has a few rows a day, however often a URL was tried."""
    day = F.col(RUN_DATE) if RUN_DATE in audit.columns else F.to_date("run_timestamp")
    rows = audit.select(key, day.alias("_day"), "run_id", F.col("download_status").alias("status"), F.lit(1).cast("long").alias("attempts"),
                        F.col("run_timestamp").alias("since"), F.col("run_timestamp").alias("until"))
    daily = _runs(rows, [key, "_day"], ["since", "run_id"]).withColumnRenamed("run", "_part")
    return _runs(daily, [key], ["_day", "_part"]).select(key, F.col("run").cast("long").alias("run"), "status", "attempts", "since", "until")


def failure_streaks(audit: DataFrame, key: str = "url", statuses: tuple[str, ...] = ("success",)) -> DataFrame:
    """Per ``key``: attempts, the current status with its streak (attempts and since when), the last success,
    and the attempts that failed since."""
    runs = status_runs(audit, key)
    ok = F.col("status").isin(*statuses)
    last_ok = F.max(F.when(ok, F.col("run"))).over(Window.partitionBy(key))
    now = F.max_by(F.struct("status", "attempts", "since"), "run").alias("_now")
    return runs.withColumn("_ok", F.coalesce(last_ok, F.lit(0))).groupBy(key).agg(
        F.sum("attempts").alias("attempts"), now, F.max(F.when(ok, F.col("until"))).alias("last_success"),
        F.coalesce(F.sum(F.when(F.col("run") > F.col("_ok"), F.col("attempts"))), F.lit(0)).alias("failed_since"),
    ).select(key, "attempts", F.col("_now.status").alias("current_status"), F.col("_now.attempts").alias("streak"),
             F.col("_now.since").alias("streak_since"), "last_success", "failed_since")
