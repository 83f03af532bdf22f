"""Lookup of a dataset's table name and comment by landing path.

First catalog entry wins (by file, then position); an unknown path keeps the path
itself as table name and an empty comment. The first entry per key is a
``min_by`` aggregate (partial aggregation, no window over a possibly hot key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_landing_path(catalog: DataFrame) -> DataFrame:
    order = F.struct("catalog_file", "position")
    if "types" not in catalog.columns:
        catalog = catalog.withColumn("types", F.lit(None).cast("map<string,string>"))
    return catalog.groupBy("landing_path").agg(
        F.min_by(F.struct("table_name", "comment", "types"), order).alias("_first")
    ).select("landing_path", F.col("_first.table_name").alias("_table_name"), F.col("_first.comment").alias("_comment"),
             F.col("_first.types").alias("_types"))


def lookup_dataset(df: DataFrame, catalog: DataFrame, key: str = "landing_path") -> DataFrame:
    """Adds ``table_name`` and ``comment`` to ``df`` by its ``key`` column."""
    first = first_by_landing_path(catalog).withColumnRenamed("landing_path", "_lk")
    joined = df.join(first, df[key] == first["_lk"], "left")
    return joined.select(
        *[df[c] for c in df.columns],
        F.coalesce(F.col("_table_name"), df[key]).alias("table_name"),
        F.coalesce(F.col("_comment"), F.lit("")).alias("comment"),
    )
