"""Per-batch load log: rows written and latest load time of each micro-batch.

Filled from an ``Observation`` on the batch's own write (no extra pass over the
data) and written over the batch's folder, so a replayed batch replaces its entry. Table totals and the latest load time are sums and maxima over this
small log instead of scans of the whole table; distinct counts are estimates from
sketches, one a batch and column, which are merged (``load_statistics``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, MapType, StringType, StructField, StructType, TimestampType

from quayside.streaming import fsutil

BATCH_LOG_SCHEMA = StructType([
    StructField("rows", LongType()),
    StructField("latest_load_timestamp", TimestampType()),
    StructField("files", LongType()),
    StructField("corrupt_rows", LongType()),
    StructField("empty_files", LongType()),
    StructField("sketches", MapType(StringType(), BinaryType())),
    StructField("batch_id", LongType()),
])

# 2 ** 12 registers: a standard error of about 1.6 %.
SKETCH_BITS = 12
# An estimate is expected within this share of the exact count (three standard errors).
SKETCH_ERROR = 0.05


def sketch(column: str) -> Column:
    """A mergeable sketch of the column's distinct values."""
    return F.hll_sketch_agg(F.col(column).cast("string"), SKETCH_BITS)


def write_entry(spark: SparkSession, log_path: str, batch_id: int, rows: int, latest: _dt.datetime | None,
                files: int, corrupt_rows: int = 0, empty_files: int = 0, sketches: dict[str, bytes] | None = None) -> None:
    # One row of constants, written straight into its folder: the cost of every batch, however small.
    pairs = [F.lit(x) for pair in (sketches or {}).items() for x in pair]
    values = [F.lit(int(rows)), F.lit(latest), F.lit(int(files)), F.lit(int(corrupt_rows)), F.lit(int(empty_files)), F.create_map(*pairs)]
    entry = spark.range(0, 1, 1, 1).select(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, BATCH_LOG_SCHEMA[:-1], strict=True)])
    entry.write.mode("overwrite").parquet(f"{log_path}/batch_id={int(batch_id)}")


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    if not fsutil.has_entries(spark, log_path):
        return spark.createDataFrame([], BATCH_LOG_SCHEMA)
    return spark.read.schema(BATCH_LOG_SCHEMA).parquet(log_path)


def totals(spark: SparkSession, log_path: str, after_batch: int | None = None) -> Row:
    """Row (total, latest, added, corrupt, empty, batches, max_batch): all rows and their latest
    load time as a string; rows, corrupt rows, files without a record and batches after
    ``after_batch``."""
    log = read_log(spark, log_path)
    later = F.col("batch_id") > F.lit(-1 if after_batch is None else after_batch)
    since = lambda c: F.coalesce(F.sum(F.when(later, F.col(c))), F.lit(0)).cast("long")
    return log.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("total"),
        F.date_format(F.max("latest_load_timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("latest"),
        since("rows").alias("added"), since("corrupt_rows").alias("corrupt"), since("empty_files").alias("empty"),
        F.count_if(later).alias("batches"),
        F.max("batch_id").alias("max_batch"),
    ).first()


def load_statistics(spark: SparkSession, log_path: str) -> DataFrame:
    """A row per sketched column of a table: column_name, distinct_estimate (within ``SKETCH_ERROR`` as
    a rule), and the table's rows, files, batches and latest load time. Reads the log alone."""
    log = read_log(spark, log_path)
    whole = log.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum("files"), F.lit(0)).cast("long").alias("files"),
        F.count("*").alias("batches"),
        F.date_format(F.max("latest_load_timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("latest_load_timestamp"),
    )
    columns = log.select(F.explode("sketches").alias("column_name", "sketch")).groupBy("column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))
    return columns.crossJoin(whole)  # one row
