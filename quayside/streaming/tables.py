"""Catalog registration of loaded tables.

The Parquet folder is the table; registering it in the session catalog adds a
name and a comment. The comment is escaped, so any text is safe in the DDL, and
like the reference it is set when the table is first created.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DEFAULT_COMMENT = "Data loaded from landed CSV files"
# Table properties: the last batch registered, and the checkpoint it belongs to.
LAST_BATCH = "quayside.last_batch"
CHECKPOINT = "quayside.checkpoint"
PARTITIONS_PER_STATEMENT = 500


def sql_string(text: str) -> str:
    """A Spark SQL string literal holding ``text`` exactly."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_table(spark: SparkSession, name: str, path: str, schema: StructType, comment: str | None = None,
                 partition_cols: tuple[str, ...] = ()) -> None:
    """CREATE TABLE IF NOT EXISTS over ``path`` with ``schema`` and a comment. Partitions are not looked
    for: ``register_batches`` adds them."""
    if spark.catalog.tableExists(name):
        return
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING parquet {parts} "
        f"LOCATION {sql_string(path)} COMMENT {sql_string(comment or DEFAULT_COMMENT)}"
    )


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def register_batches(spark: SparkSession, name: str, checkpoint_path: str) -> list[int]:
    """ADD PARTITION for the batches loaded since the last registration, from the batch log; the entry
    remembers the last one, so neither the table's folder nor its partitions are listed.
    Returns the batches added (a bounded number of log rows a run)."""
    from quayside.streaming import batch_log

    after = int(_properties(spark, name).get(LAST_BATCH, -1))
    log = batch_log.read_log(spark, f"{checkpoint_path}/batches").where((F.col("batch_id") > after) & (F.col("rows") > 0))
    new = sorted(r.batch_id for r in log.select("batch_id").collect())
    for k in range(0, len(new), PARTITIONS_PER_STATEMENT):
        parts = " ".join(f"PARTITION (`_batch_id` = {b})" for b in new[k : k + PARTITIONS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    if new:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{LAST_BATCH}' = '{new[-1]}', '{CHECKPOINT}' = {sql_string(checkpoint_path)})")
    return new


def register_loaded_table(spark: SparkSession, name: str, table_path: str, checkpoint_path: str,
                          comment: str | None = None) -> None:
    """Register an ingested table, or bring its entry up to date: ADD COLUMNS for columns new in the schema
    log, ADD PARTITION for batches new in the batch log.

    A parquet entry cannot change a column's type or be turned to another checkpoint; only then is
    it dropped (external: data stays) and created again with the comment it had. A table with batches
    that must be cast on reading cannot be a plain Parquet entry: this raises, and ``read_table`` reads it.
    """
    from quayside.streaming import batch_log, schema_log
    from quayside.streaming.ingest import table_schema

    versions = schema_log.versions(spark, f"{checkpoint_path}/schema")
    latest = versions[-1][1] if versions else []
    changed = sorted({n for _, cols in versions for n, t in cols if (t, dict(latest).get(n)) in schema_log.CAST_ON_READ})
    if changed:
        raise ValueError(f"{name}: columns {changed} changed type between batches; read the table with read_table")
    schema = table_schema(latest)
    if spark.catalog.tableExists(name):
        known = {f.name: f.dataType for f in spark.table(name).schema.fields}
        own = _properties(spark, name)
        last = batch_log.totals(spark, f"{checkpoint_path}/batches").max_batch
        same = own.get(CHECKPOINT, checkpoint_path) == checkpoint_path and int(own.get(LAST_BATCH, -1)) <= (-1 if last is None else last)
        if not same or any(known.get(f.name, f.dataType) != f.dataType for f in schema.fields):
            comment = table_comment(spark, name) or comment
            spark.sql(f"DROP TABLE {name}")
        else:
            new = StructType([f for f in schema.fields if f.name not in known])
            if new.fields:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(new)})")
    ensure_table(spark, name, table_path, schema, comment, partition_cols=("_batch_id",))
    register_batches(spark, name, checkpoint_path)


def set_comment(spark: SparkSession, name: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {name} IS {sql_string(comment)}")


def table_comment(spark: SparkSession, name: str) -> str | None:
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Comment'").select("data_type").first()
    return row[0] if row else None
