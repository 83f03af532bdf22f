"""Column naming, lineage and path-derived partition columns."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.names import unique_snake_names

# Lineage columns added to every loaded row.
LINEAGE_COLUMNS = ["_load_timestamp", "_source_file", "_processing_date"]
CORRUPT_COLUMN = "_corrupt_record"
RESCUED_COLUMN = "_rescued"
PATH_COLUMNS = ["_year", "_month"]
RESERVED = tuple(LINEAGE_COLUMNS + [CORRUPT_COLUMN, RESCUED_COLUMN] + PATH_COLUMNS + ["_batch_id"])


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename every column by the snake-case rule in one projection (collisions get
    ``_2``, ``_3``; empty names ``col_{position}``)."""
    return df.toDF(*unique_snake_names(df.columns, reserved=RESERVED))


def load_timestamp(as_of: str | _dt.datetime | None = None) -> Column:
    """``current_timestamp()`` (fixed once per micro-batch) or a given instant."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(str(as_of)).cast("timestamp")


def processing_date(as_of: str | _dt.datetime | _dt.date | None = None) -> Column:
    """'YYYY-MM-DD' of ``as_of``, or of the driver's clock when the plan is built."""
    if as_of is None:
        return F.lit(_dt.datetime.now().strftime("%Y-%m-%d"))
    return F.date_format(F.lit(str(as_of)).cast("timestamp"), "yyyy-MM-dd")


def add_lineage(df: DataFrame, as_of=None, source_file: Column | None = None) -> DataFrame:
    """Adds ``_load_timestamp``, ``_source_file`` (the scanned file's path) and
    ``_processing_date``. ``df`` must still be over a file scan unless ``source_file``
    is given."""
    src = source_file if source_file is not None else F.col("_metadata.file_path")
    return df.withColumns({
        "_load_timestamp": load_timestamp(as_of),
        "_source_file": src,
        "_processing_date": processing_date(as_of),
    })


def path_partition(path: Column | str, name: str) -> Column:
    """Integer value of a ``name=value`` directory in a path; NULL when absent or not a
    number (Hive's default partition reads as NULL)."""
    p = F.col(path) if isinstance(path, str) else path
    return F.nullif(F.regexp_extract(p, f"/{name}=([^/]*)/", 1), F.lit("")).try_cast("int")


def add_path_partitions(df: DataFrame, path: Column | str = "_source_file") -> DataFrame:
    """``_year``, ``_month`` from the file path. Data columns named year/month are kept
    as they are (partition discovery would replace them silently)."""
    return df.withColumns({"_year": path_partition(path, "year"), "_month": path_partition(path, "month")})
