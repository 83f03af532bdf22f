"""Incremental, exactly-once load of a landing tree of CSV files into a table.

The stream carries file *paths* only (``binaryFile`` with ``content`` pruned); each
micro-batch is loaded by ``foreachBatch`` with the batch reader, which lets a batch
hold files with different headers:

1. the first records of all new files are read by one job of Spark's own CSV reader
   (blank lines skipped, any line ends, quoted newlines with ``multi_line``, no length
   limit), and files are grouped by that header; a file that cannot be read fails the
   batch, which is then not committed and tried again by the next run; a file without a
   record is counted and loads no row;
2. per header group the column types are taken from the schema log and inferred for
   new columns, and for date columns, which would cut off times without a trace; a
   batch whose values do not fit is inferred afterwards and, when a column widens
   (int -> bigint -> double, date -> timestamp), rewritten under the wider type, so a
   batch without dates or type drift reads its files once;
3. each group is read with its positional schema plus ``_corrupt_record``
   (PERMISSIVE: a value that does not fit becomes NULL and the raw line is kept), and the
   cells that did not fit are kept by column name in ``_rescued`` (VARIANT);
4. names are normalised, lineage and path columns added, groups unioned by name
   and written to ``_batch_id=N`` with dynamic partition overwrite: a replayed
   batch replaces its own output, so rows are loaded exactly once.

The table is a Parquet folder; read it with ``read_table`` (logged schema, so old
files without a newer column read as NULL, and batches written before a widening are
read under the type they have and cast).
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType, TimestampType, VariantType

from quayside.functions.names import unique_snake_names
from quayside.operators.columns import (
    CORRUPT_COLUMN,
    LINEAGE_COLUMNS,
    RESCUED_COLUMN,
    RESERVED,
    add_lineage,
    add_path_partitions,
)
from quayside.session import scratch_dir
from quayside.streaming import batch_log, fsutil, schema_log

BINARY_FILE_SCHEMA = StructType([
    StructField("path", StringType()),
    StructField("modificationTime", TimestampType()),
    StructField("length", LongType()),
    StructField("content", BinaryType()),
])

RESULT_SCHEMA = StructType([
    StructField("status", StringType()),
    StructField("table_name", StringType()),
    StructField("total_rows", LongType()),
    StructField("rows_added", LongType()),
    StructField("latest_load_timestamp", StringType()),
    StructField("checkpoint_path", StringType()),
    StructField("batches", IntegerType()),
    StructField("message", StringType()),
    # Of the rows added: those with a value that did not fit its column (the value is NULL,
    # the raw line kept). Of the files: those without any record.
    StructField("corrupt_rows", LongType()),
    StructField("empty_files", LongType()),
])

# A file up to this size is read whole for its header, cheaper than a Python task of its own.
SMALL_FILE = 8 << 20
# The first record of a small file in one of these encodings is its first line where that is plain: within so
# many bytes, printable ASCII, no blank in front, no quote or escape. Compressed files are told by their names.
PLAIN_HEAD = 4096
_PLAIN_LINE = r"^([!#-\[\]-~][ !#-\[\]-~]*)[\r\n]"
_PLAIN_NAME = re.compile(r"\.csv(@[0-9]+)?$", re.IGNORECASE)
_PLAIN_ENCODINGS = {"UTF-8", "UTF8", "US-ASCII", "ISO-8859-1"}
# No file is cut and none shares a task while headers of big files are read.
WHOLE_FILES = {
    "spark.sql.files.maxPartitionBytes": str(1 << 45),
    "spark.sql.files.openCostInBytes": str(1 << 45),
    "spark.sql.files.maxPartitionNum": str((1 << 31) - 1),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
}


@dataclass
class IngestOptions:
    max_files_per_trigger: int = 100
    # A micro-batch of about so many bytes instead (at least one file): Spark's file source bounds
    # a batch by files or by bytes, not by both.
    max_bytes_per_trigger: int | None = None
    # Files older than this (against the newest seen) are skipped by the file source;
    # a thousand years: copied or epoch-dated files are never dropped silently.
    max_file_age: str = "365000d"
    multi_line: bool = False
    encoding: str = "UTF-8"
    as_of: object = None
    type_overrides: dict[str, str] = field(default_factory=dict)
    # Columns, beside ``_source_file``, whose distinct values each batch sketches into the batch log.
    sketch_columns: tuple[str, ...] = ()
    # Seconds after which a load is stopped between batches (None: no limit).
    timeout_s: float | None = None
    # When the checkpoint is new but the table has data, batch ids would restart at
    # 0 and overwrite old batches: stop, or start the table anew ("truncate").
    on_new_checkpoint: str = "stop"


_GLOB_CHARS = "\\{}[]*?"


def literal_paths(paths: list[str]) -> list[str]:
    """Paths as literal names for the file readers, which would expand glob characters."""
    return ["".join("\\" + c if c in _GLOB_CHARS else c for c in p) for p in paths]


def _first_records(stop: bool):
    """Task body: the first record of every file; with ``stop`` a task ends after its first row."""
    def run(batches):
        file = None
        for b in batches:
            files = b.column("file").to_pylist()
            at = [i for i, f in enumerate(files) if f != (files[i - 1] if i else file)]
            if at:
                yield b.take(at)
            if files and stop:
                return
            file = files[-1] if files else file

    return run


def _same_file(uri: str) -> str:
    """One spelling of a path: ``_metadata.file_path`` is percent-encoded, a listing's path is not."""
    return re.sub("^file:/+", "file:/", uri if uri.startswith("file:") or "://" in uri else f"file:{uri}")


def _cells(spark: SparkSession, records: list[str]) -> list[tuple[str, ...]]:
    """The cells of raw CSV records, by Spark's parser. Constants only, so no job runs."""
    if not records:
        return []
    one = spark.sql("SELECT * FROM VALUES (1) AS one(n)")  # a local relation
    kinds = one.select(*[F.schema_of_csv(F.lit(r)).alias(f"r{i}") for i, r in enumerate(records)]).first()
    names = [", ".join(f"c{k} string" for k in range(len(schema_log.to_type(t).fields))) for t in kinds]
    cells = one.select(*[F.from_csv(F.lit(r), n).alias(f"r{i}") for i, (r, n) in enumerate(zip(records, names))]).first()
    return [tuple(c or "" for c in row) for row in cells]


def read_headers(spark: SparkSession, paths: list[str], opts: IngestOptions,
                 lengths: dict[str, int] | None = None) -> dict[str, tuple[str, ...]]:
    """Path → cells of the file's first record, by Spark's CSV reader; () for a file without
    one. A file that cannot be read raises.

    Of files up to ``SMALL_FILE`` bytes (by ``lengths``) a first line that is plain is the record as it
    stands (``PLAIN_HEAD``), so these are not parsed; the rest of them is read by one job, many a task; the
    first records of the others by another, a file a task, which ends there. Read under a schema of one
    column, a record of more cells is kept raw; the few different raw records are then split into
    cells on the driver. Files without a result are read once more, to their end, so that none
    counts as empty because of settings this session does not control."""
    session = spark.newSession()
    for k, v in WHOLE_FILES.items():
        session.conf.set(k, v)

    whole = spark.newSession()  # one job: no shuffle is run ahead of the rest
    for k in (fsutil.LISTING_TASKS, "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        whole.conf.set(k, spark.conf.get(k))
    whole.conf.set("spark.sql.adaptive.enabled", False)
    whole.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)

    def lines(within: SparkSession, files: list[str]) -> DataFrame:
        rows = (within.read.schema("cell string, record string").option("header", False)
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "record")
                .option("multiLine", opts.multi_line).option("encoding", opts.encoding).csv(literal_paths(files)))
        start = F.col("_metadata.file_block_start") == 0
        return rows.where(start).select(F.col("_metadata.file_path").alias("file"), "cell", "record")

    def plain(files: list[str]) -> list:
        head = F.decode(F.substring("content", 1, PLAIN_HEAD), "ISO-8859-1")
        line = F.regexp_extract(head, _PLAIN_LINE, 1).alias("record")
        rows = spark.read.format("binaryFile").load(literal_paths(files)).select("path", line).where("record <> ''")
        return rows.select(F.col("path").alias("file"), F.lit(None).cast("string").alias("cell"), "record").collect()

    def small(files: list[str]) -> list:
        rows = lines(whole, files).withColumn("at", F.monotonically_increasing_id())
        first = F.min_by(F.struct("cell", "record"), "at").alias("first")
        return rows.groupBy("file").agg(first).select("file", "first.cell", "first.record").collect()

    def big(files: list[str], stop: bool) -> list:
        return lines(session, files).mapInArrow(_first_records(stop), "file string, cell string, record string").collect()

    found: dict[str, tuple[str | None, str | None]] = {}
    known = lengths or {}
    if opts.encoding.upper() in _PLAIN_ENCODINGS:
        heads = [p for p in paths if known.get(p, SMALL_FILE + 1) <= SMALL_FILE and _PLAIN_NAME.search(p)]
        if heads:
            found |= {_same_file(r.file): (r.cell, r.record) for r in plain(heads)}
    steps = [(small, lambda p: known.get(p, SMALL_FILE + 1) <= SMALL_FILE),
             (lambda files: big(files, True), lambda p: known.get(p, SMALL_FILE + 1) > SMALL_FILE),
             (lambda files: big(files, False), lambda p: known.get(p, SMALL_FILE + 1) > SMALL_FILE)]
    for read, wanted in steps:
        left = [p for p in paths if wanted(p) and _same_file(p) not in found]
        if left:
            found |= {_same_file(unquote(r.file)): (r.cell, r.record) for r in read(left)}
    records = sorted({r for _, r in found.values() if r is not None})
    cells = dict(zip(records, _cells(spark, records)))

    def header(path: str) -> tuple[str, ...]:
        if _same_file(path) not in found:
            return ()
        cell, record = found[_same_file(path)]
        return (cell or "",) if record is None else cells[record]

    return {p: header(p) for p in paths}


def rescue(df: DataFrame, names: list[str]) -> DataFrame:
    """Adds ``_rescued``: of a row with a raw line, the cells that did not fit their column, by column
    name, as a VARIANT object; NULL where every cell fits. The line is split again, as strings, for
    such rows only."""
    raw = F.col(CORRUPT_COLUMN)
    cells = F.when(raw.isNotNull(), F.from_csv(raw, ", ".join(f"`{n}` string" for n in names)))
    misfits = F.to_json(F.struct(*[F.when(F.col(n).isNull(), F.col("_cells")[n]).alias(n) for n in names]))
    kept = F.when(raw.isNotNull(), F.parse_json(F.nullif(misfits, F.lit("{}"))))
    return df.withColumn("_cells", cells).withColumn(RESCUED_COLUMN, kept).drop("_cells")


def _read_group(spark: SparkSession, paths: list[str], schema: StructType, opts: IngestOptions) -> DataFrame:
    paths = literal_paths(paths)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("multiLine", opts.multi_line)
        .option("encoding", opts.encoding)
        .csv(paths)
    )


# For inference: line ends become a control character, which parsers of numbers and times trim as they do line
# ends, and what CSV quotes or escapes becomes a sign that no number or time has.
_CELL_SIGNS, _FLAT_SIGNS = '\n\r",\\', "\x01\x01\xa4\xa4\xa4"


def _infer_types(spark: SparkSession, paths: list[str], names: list[str], opts: IngestOptions) -> list[str]:
    """The type of every column of files with one header; of overridden columns the override.

    Spark infers from multi-line files in few tasks, each of many files. So their cells are read
    as strings by a plain scan first, and the types inferred from a copy with a record a line."""
    width = len(names)
    if opts.multi_line:
        wanted = [n for n in names if n not in opts.type_overrides]
        types = dict(opts.type_overrides)
        if wanted:
            rows = _read_group(spark, paths, StructType([StructField(n, StringType()) for n in names]), opts)
            flat = scratch_dir(spark, "infer")
            cells = [F.translate(F.col(n), _CELL_SIGNS, _FLAT_SIGNS).alias(f"c{k}") for k, n in enumerate(wanted)]
            rows = rows.select(F.lit("0").alias("row"), *cells)  # no line is blank
            rows.write.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(flat)
            inferred = spark.read.option("inferSchema", True).csv(flat).schema.fields[1:]
            fsutil.delete(spark, flat)
            types |= dict(zip(wanted, [f.dataType.simpleString() for f in inferred] + ["string"] * width))
        return [types[n] for n in names]
    paths = literal_paths(paths)
    inferred = (
        spark.read.option("header", True).option("inferSchema", True)
        .option("encoding", opts.encoding).csv(paths).schema
    )
    types = [f.dataType.simpleString() for f in inferred.fields]
    return (types + ["string"] * width)[:width]


def make_batch_function(spark: SparkSession, table_path: str, log_path: str, opts: IngestOptions,
                        batches_path: str | None = None):
    widenable = {old for old, _ in schema_log.WIDENINGS}
    # Types whose reader drops part of a wider value without marking the row.
    truncating = {"date"}
    # Schema written by the previous batch of this query run; batches run in order,
    # so it is the log's latest version. A new process reads the log instead.
    last: dict = {}

    def merge_types(logged: dict, order: list, names: list[str], types: list[str]) -> None:
        for n, t in zip(names, types):
            if n not in logged:
                logged[n] = opts.type_overrides.get(n, t)
                order.append(n)
            elif n not in opts.type_overrides:
                logged[n] = schema_log.widen(logged[n], t)

    def write_batch(batch_id: int, plans, logged: dict, order: list, base: list) -> dict:
        columns = [(n, logged[n]) for n in order]
        # The log version comes first: table files never hold a type the log lacks. A
        # batch that changes nothing writes no version (readers take the latest one
        # older than their batch, which is then the same schema).
        if columns != base:
            schema_log.write_version(spark, log_path, batch_id, columns)
        frames = []
        for paths, names in plans:
            read_schema = StructType(
                [StructField(n, schema_log.to_type(logged[n])) for n in names]
                + [StructField(CORRUPT_COLUMN, StringType())]
            )
            df = add_lineage(_read_group(spark, paths, read_schema, opts), opts.as_of)
            frames.append(rescue(add_path_partitions(df), names))
        out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        out = out.select(
            *[(F.col(n) if n in out.columns else F.lit(None)).cast(t).alias(n) for n, t in columns],
            *LINEAGE_COLUMNS, CORRUPT_COLUMN, RESCUED_COLUMN, "_year", "_month",
            F.lit(batch_id).cast("long").alias("_batch_id"),
        )
        # Unique name: streams of several tables may run the same batch id at once.
        obs = Observation(f"batch_{batch_id}_{uuid.uuid4().hex}")
        sketched = ["_source_file", *(c for c in opts.sketch_columns if c in logged)]
        out = out.observe(obs, F.count(F.lit(1)).alias("rows"), F.max("_load_timestamp").alias("latest"),
                          F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("corrupt"),
                          *[batch_log.sketch(c).alias(f"distinct {c}") for c in sketched])
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_batch_id").parquet(table_path))
        stats = obs.get
        return stats | {"sketches": {c: bytes(stats[f"distinct {c}"]) for c in sketched}}

    def process(batch: DataFrame, batch_id: int) -> None:
        # At most max_files_per_trigger paths: bounded metadata, grouped on the driver.
        files = {r.path: r.length for r in batch.select("path", "length").collect()}
        found = read_headers(spark, list(files), opts, files)
        by_header: dict[tuple[str, ...], list[str]] = {}
        for path, header in found.items():
            if header:
                by_header.setdefault(header, []).append(path)
        empty = sum(not h for h in found.values())
        groups = [(h, sorted(ps)) for h, ps in sorted(by_header.items())]
        if not groups:
            if empty and batches_path is not None:
                batch_log.write_entry(spark, batches_path, batch_id, 0, None, empty, 0, empty)
            return
        if last.get("batch") is not None and last["batch"] < batch_id:
            logged = dict(last["columns"])
        else:
            logged = dict(schema_log.latest_columns(spark, log_path, before=batch_id))
        order = list(logged)
        base = [(n, logged[n]) for n in order]
        plans, unchecked = [], []
        for header, paths in groups:
            names = unique_snake_names(list(header), reserved=RESERVED)
            if any(n not in logged or (logged[n] in truncating and n not in opts.type_overrides) for n in names):
                # New columns: their types come from inference over the group's files.
                merge_types(logged, order, names, _infer_types(spark, paths, names, opts))
            elif any(logged[n] in widenable and n not in opts.type_overrides for n in names):
                unchecked.append(len(plans))
            plans.append((paths, names))
        stats = write_batch(batch_id, plans, logged, order, base)
        if stats.get("corrupt") and unchecked:
            # Values that did not fit: infer the groups not inferred yet; when a column
            # widens, rewrite this batch (its own partition) under the wider type.
            before = dict(logged)
            for i in unchecked:
                paths, names = plans[i]
                merge_types(logged, order, names, _infer_types(spark, paths, names, opts))
            if logged != before:
                stats = write_batch(batch_id, plans, logged, order, base)
        if batches_path is not None:
            batch_log.write_entry(spark, batches_path, batch_id, stats.get("rows", 0), stats.get("latest"),
                                  len(found), stats.get("corrupt", 0), empty, stats["sketches"])
        last.update(batch=batch_id, columns=[(n, logged[n]) for n in order])

    return process


def table_schema(columns: list[tuple[str, str]]) -> StructType:
    return StructType(
        [StructField(n, schema_log.to_type(t)) for n, t in columns]
        + [StructField("_load_timestamp", TimestampType()), StructField("_source_file", StringType()),
           StructField("_processing_date", StringType()), StructField(CORRUPT_COLUMN, StringType()),
           StructField(RESCUED_COLUMN, VariantType()),
           StructField("_year", IntegerType()), StructField("_month", IntegerType()),
           StructField("_batch_id", LongType())]
    )


def read_table(spark: SparkSession, table_path: str, checkpoint_path: str) -> DataFrame:
    """The table under its latest logged schema (columns added later read as NULL).

    Batches of an earlier version whose types Parquet readers cannot widen are read under
    that version's types and cast; without such a change it is one plain scan."""
    versions = schema_log.versions(spark, f"{checkpoint_path}/schema")
    columns = versions[-1][1] if versions else []
    schema = table_schema(columns)
    if not fsutil.has_entries(spark, table_path):
        return spark.createDataFrame([], schema)
    latest = dict(columns)
    spans: list[tuple[int, list[tuple[str, str]]]] = []  # first batch, columns to read with
    for first, cols in versions:
        # types that differ from the latest ones and stay as they are in the files
        kept = [(n, t if (t, latest[n]) in schema_log.CAST_ON_READ else latest[n]) for n, t in cols]
        kept += [(n, t) for n, t in columns if n not in dict(cols)]
        if not spans or dict(spans[-1][1]) != dict(kept):
            spans.append((first, kept))
    parts = []
    for k, (first, cols) in enumerate(spans):
        df = spark.read.schema(table_schema(cols)).parquet(table_path)
        if k:
            df = df.where(F.col("_batch_id") >= first)
        if k + 1 < len(spans):
            df = df.where(F.col("_batch_id") < spans[k + 1][0])
        parts.append(df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]))
    return reduce(DataFrame.unionAll, parts) if len(parts) > 1 else spark.read.schema(schema).parquet(table_path)


def ingest_table(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    checkpoint_path: str,
    table_name: str | None = None,
    options: IngestOptions | None = None,
) -> DataFrame:
    """Load every file under ``source_path`` not loaded before; returns one result row
    (status, table_name, total_rows, rows_added, latest_load_timestamp, checkpoint_path,
    batches, message, corrupt_rows, empty_files). A failed or stopped load returns the row too,
    status ``failed``, with what its committed batches hold."""
    from quayside.session import ship_package

    ship_package(spark)  # the batch function runs package code in Python tasks
    fsutil.bound_listing(spark)
    opts = options or IngestOptions()
    name = table_name or table_path.rstrip("/").rsplit("/", 1)[-1]

    def result(status, total, added, ts, batches, msg=None, corrupt=0, empty=0):
        return spark.createDataFrame([(status, name, total, added, ts, checkpoint_path, batches, msg, corrupt, empty)],
                                     RESULT_SCHEMA)

    if not fsutil.has_entries(spark, source_path):
        return result("no_source_data", 0, 0, None, 0, f"Source path {source_path} does not exist or is empty")

    stream_ckpt = f"{checkpoint_path}/stream"
    if not fsutil.exists(spark, f"{stream_ckpt}/offsets") and fsutil.has_entries(spark, table_path):
        if opts.on_new_checkpoint != "truncate":
            return result("failed", None, None, None, 0, "checkpoint missing for a table with data", None, None)
        fsutil.delete(spark, table_path)
        fsutil.delete(spark, f"{checkpoint_path}/schema")
        fsutil.delete(spark, f"{checkpoint_path}/batches")

    batches_path = f"{checkpoint_path}/batches"
    last_batch = batch_log.totals(spark, batches_path).max_batch
    admission = ("maxFilesPerTrigger", int(opts.max_files_per_trigger))
    if opts.max_bytes_per_trigger is not None:
        admission = ("maxBytesPerTrigger", int(opts.max_bytes_per_trigger))
    paths = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option(*admission)
        .option("maxFileAge", opts.max_file_age)
        .load(source_path)
        .select("path", "length")
    )
    fn = make_batch_function(spark, table_path, f"{checkpoint_path}/schema", opts, batches_path)
    query = (
        paths.writeStream.foreachBatch(fn)
        .option("checkpointLocation", stream_ckpt)
        .trigger(availableNow=True)
        .start()
    )
    started, message = time.time(), None
    try:
        if opts.timeout_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(opts.timeout_s):
            query.stop()
            message = f"timeout after {time.time() - started:.0f} s"
    except StreamingQueryException as err:  # the batch is not committed; the next run tries it again
        message = str(err)
    t = batch_log.totals(spark, batches_path, last_batch)
    return result("failed" if message else "success", t.total, t.added, t.latest, t.batches, message, t.corrupt, t.empty)
