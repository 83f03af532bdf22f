"""Catalog of dataset templates and the two plain readers (JSON array, all-strings CSV).

A catalog document is ``{"mappings": [{url_pattern, table_name, parameters[],
landing_path, comment, types{}}, ...]}``; ``types`` (optional) gives columns of the table a type
whatever their values look like. A folder may hold several documents; the order of
entries is (file path, position in the document), which the first-match lookup uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

MAPPING_SCHEMA = StructType([
    StructField("url_pattern", StringType()),
    StructField("table_name", StringType()),
    StructField("parameters", ArrayType(StringType())),
    StructField("landing_path", StringType()),
    StructField("comment", StringType()),
    StructField("types", MapType(StringType(), StringType())),
])
CATALOG_SCHEMA = StructType([StructField("mappings", ArrayType(MAPPING_SCHEMA))])


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row per template: catalog_file, position, url_pattern, table_name, parameters,
    landing_path, comment, types. A missing ``parameters`` list or ``types`` map reads as empty."""
    raw = spark.read.schema(CATALOG_SCHEMA).option("multiLine", True).json(path)
    rows = raw.select(
        F.col("_metadata.file_path").alias("catalog_file"),
        F.posexplode("mappings").alias("position", "m"),
    )
    return rows.select(
        "catalog_file",
        "position",
        F.col("m.url_pattern").alias("url_pattern"),
        F.col("m.table_name").alias("table_name"),
        F.coalesce(F.col("m.parameters"), F.array().cast("array<string>")).alias("parameters"),
        F.col("m.landing_path").alias("landing_path"),
        F.col("m.comment").alias("comment"),
        F.coalesce(F.col("m.types"), F.create_map().cast("map<string,string>")).alias("types"),
    )


def _mapping(m: Column, typed: bool) -> Column:
    return m.withField("types", F.map_from_entries(m["types"])) if typed else m


def write_catalog(df: DataFrame, path: str, group_col: str, order_col: str) -> None:
    """Write mapping rows as catalog documents, one document per ``group_col`` value.

    Each document is built by one aggregate row; ``order_col`` fixes entry order.
    """
    key = F.col(group_col)
    fields = [F.col(f.name) for f in MAPPING_SCHEMA.fields if f.name != "types"]
    if "types" in df.columns:  # as entries: a map has no order to sort by
        fields.append(F.map_entries("types").alias("types"))
    entry = F.struct(F.col(order_col).alias("_o"), F.struct(*fields).alias("m"))
    docs = (
        df.groupBy(key.alias("_doc"))
        .agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
        .select("_doc", F.to_json(F.struct(F.transform("_entries", lambda e: _mapping(e["m"], "types" in df.columns)).alias("mappings"))).alias("value"))
    )
    docs.write.mode("overwrite").partitionBy("_doc").text(path)


def read_json_array(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A file holding one JSON array of objects -> one row per object."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string (no inference)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)
