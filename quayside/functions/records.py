"""Rows as JSON and back (task lists, ingest results, run summaries).

One JSON document per row (JSON Lines), so a task list of any length stays
distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def to_json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON object string."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(name))


def from_json_rows(df: DataFrame, schema: StructType, col: str = "json") -> DataFrame:
    """JSON object strings back to typed columns."""
    return df.select(F.from_json(F.col(col), schema).alias("_r")).select("_r.*")
