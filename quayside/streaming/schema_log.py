"""Schema log of a table: one row per (version, column), versions keyed by batch id.

Written with dynamic partition overwrite, so a replayed batch rewrites its own
version only. The latest version before a batch is what that batch starts from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType, _parse_datatype_string

from quayside.streaming import fsutil

LOG_SCHEMA = StructType([
    StructField("position", LongType()),
    StructField("column_name", StringType()),
    StructField("data_type", StringType()),
    StructField("version", LongType()),
])

# Type changes a column may take between batches. Any other change keeps the logged type.
WIDENINGS = {("int", "bigint"): "bigint", ("int", "double"): "double", ("bigint", "double"): "double",
             ("date", "timestamp"): "timestamp"}
# Of these, the ones a Parquet scan cannot read from old files: read as written, then cast.
CAST_ON_READ = {("bigint", "double"), ("date", "timestamp")}


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    if not fsutil.has_entries(spark, log_path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(log_path)


def latest_columns(spark: SparkSession, log_path: str, before: int | None = None) -> list[tuple[str, str]]:
    """(column, type) of the newest version, optionally older than ``before``."""
    log = read_log(spark, log_path)
    if before is not None:
        log = log.where(F.col("version") < before)
    newest = log.agg(F.max("version").alias("v"))
    rows = (log.join(newest, log["version"] == newest["v"])
            .orderBy("position").select("column_name", "data_type").collect())
    return [(r.column_name, r.data_type) for r in rows]


def versions(spark: SparkSession, log_path: str) -> list[tuple[int, list[tuple[str, str]]]]:
    """(first batch, columns) of every version, oldest first. One row per column and version
    that changed the schema: bounded by the table's schema history."""
    out: dict[int, list[tuple[str, str]]] = {}
    for r in read_log(spark, log_path).orderBy("version", "position").collect():
        out.setdefault(r.version, []).append((r.column_name, r.data_type))
    return sorted(out.items())


def write_version(spark: SparkSession, log_path: str, version: int, columns: list[tuple[str, str]]) -> None:
    rows = [(i, n, t, version) for i, (n, t) in enumerate(columns)]
    (spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(log_path))


def widen(logged: str, new: str) -> str:
    return WIDENINGS.get((logged, new), logged)


def to_type(name: str) -> DataType:
    return _parse_datatype_string(name)
