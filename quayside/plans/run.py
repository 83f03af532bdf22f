"""A whole load run: catalog -> expected files -> archives -> landing -> audit ->
recent successes -> per-table ingest -> summary.

Archives are taken from a folder (no network client): a task's archive is the file whose
path below the folder is the longest that ends the task's URL (host and path). Every step is a
Spark plan; the driver only loops over the datasets to ingest (bounded by the
catalog) and runs independent tables concurrently.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import audit as A
from quayside.operators.land import changed_members, land_archive_members, landed_keys
from quayside.operators.lookup import first_by_landing_path
from quayside.operators.status import fetch_status, landing_message, landing_outcome
from quayside.operators.tasks import backfill_periods, expected_files, incremental_periods
from quayside.sources.archives import archive_members, decode_members, is_csv, read_members, scan_archives
from quayside.session import checkpoint_root, scratch_dir
from quayside.sources.catalog import read_catalog
from quayside.sources.landing import KEYS as LAND_KEYS, dataset_path, escape_partition_value
from quayside.streaming import fsutil
from quayside.streaming.ingest import RESULT_SCHEMA, IngestOptions, ingest_table

@dataclass
class RunLayout:
    """Folders of one deployment (all below a shared file system)."""
    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def tables(self) -> str:
        return f"{self.root}/tables"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}/checkpoints"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"

    @property
    def audit_members(self) -> str:
        return f"{self.root}/audit_members"


def plan_tasks(spark: SparkSession, catalog: DataFrame, mode: str, start_year: int | None = None,
               end_year: int | None = None, as_of=None) -> DataFrame:
    if mode == "incremental":
        at = F.lit(str(as_of)).cast("timestamp") if as_of is not None else F.current_timestamp()
        periods = incremental_periods(at)
    else:
        periods = backfill_periods(int(start_year), int(end_year))
    return expected_files(catalog, periods)


def archives_below(spark: SparkSession, archive_dir: str) -> DataFrame:
    """archive_path and ``archive``, its path below the folder, of every archive."""
    fs, p = fsutil._hadoop_path(spark, archive_dir)
    base = fs.makeQualified(p).toString().rstrip("/") + "/"
    # Listing only: the MD5 would read every archive's bytes.
    found = scan_archives(spark, archive_dir, with_md5=False)
    at = F.locate(base, F.col("archive_path"))
    return found.select("archive_path", F.when(at > 0, F.substr("archive_path", at + F.lit(len(base)))).otherwise(F.col("archive")).alias("archive"))


def match_archives(tasks: DataFrame, archives: DataFrame) -> DataFrame:
    """``tasks`` with the archive whose path below the folder is the longest that ends the
    task's URL. Each task looks up the endings of its own URL: an equality join, no comparison
    of all tasks with all archives."""
    parts = F.split(F.regexp_replace("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://", ""), "/")
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(k.alias("n"), F.array_join(F.slice(parts, -k, k), "/").alias("archive")))
    looked = tasks.select("task_id", F.explode(ends).alias("e")).select("task_id", "e.n", "e.archive").join(archives, "archive")
    best = looked.groupBy("task_id").agg(F.max_by(F.struct("archive_path", "archive"), "n").alias("b"))
    return tasks.join(best.select("task_id", "b.archive_path", "b.archive"), "task_id", "left")


def fetch_and_land(spark: SparkSession, tasks: DataFrame, archive_dir: str, layout: RunLayout,
                   catalog_name: str, schema_name: str, run_ts: str, fetch_log: DataFrame | None = None,
                   report_changes: bool = False, charset: str = "UTF-8",
                   multi_line: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Match tasks to archives, land their CSV members, return this run's audit rows.

    ``fetch_log`` (url, http_code, error), when given, records how each download
    went; a task without a log row counts as fetched when its archive is present
    and as 'not_found' otherwise. With ``report_changes`` the members already landed
    with different content are returned too (this reads their landed files).
    """
    run_uuid = uuid.uuid4().hex
    # A row's run id is made of its run and url, so equal times never mix two runs.
    run_id = F.md5(F.concat(F.lit(run_uuid), F.col("url")))
    this_run = (F.col(A.RUN_DATE) == F.lit(run_ts).cast("timestamp").cast("date")) & (F.col("run_timestamp") == F.lit(run_ts).cast("timestamp")) & (F.col("run_id") == run_id)
    task_id = F.md5(F.concat_ws("|", "url", "landing_path", F.coalesce(F.col("year").cast("string"), F.lit("")),
                                F.coalesce(F.col("month").cast("string"), F.lit(""))))
    t = tasks.withColumn("task_id", task_id)
    matched = match_archives(t, archives_below(spark, archive_dir))
    fetched = matched.where(F.col("archive_path").isNotNull())
    keyed = fetched.select("task_id", "archive_path", "archive", F.col("landing_path").alias("dataset"), "year", "month")
    archive_paths = fetched.select("archive_path").distinct()
    # Folders this run can touch: bounded by the task list, not by the tree's history.
    touched = [(r.dataset, r.year, r.month) for r in keyed.select("dataset", "year", "month").distinct().collect()]

    # CSV members with their landing keys, from the central directories only. The
    # landed check runs on these rows; only members still to land are read.
    # Written once: landing, audit and the list of bad archives read it from there.
    listed_at = scratch_dir(spark, "listing")
    archive_members(archive_paths, with_content=False).drop("content").write.parquet(listed_at)
    listing = spark.read.parquet(listed_at)
    csv_listed = (listing.where(F.col("error").isNull() & is_csv("member"))
                  .join(keyed, "archive_path").select("archive_path", "member", "read_chunk", "size_bytes",
                                                         "archive", "dataset", "year", "month"))
    changed = None
    if report_changes:
        # Checked before landing and materialised: after landing the comparison would
        # see the new files, and recomputing it would list the folders again. Only
        # members landed before are read here (a semi join on metadata); landing then
        # reads the others, so each fetched member's content is read once (opt-in).
        checkpoint_root(spark)  # the shared spark.checkpoint.dir (set only where unset)
        before = landed_keys(spark, layout.landing, touched).select(*LAND_KEYS)
        landed_before = csv_listed.join(
            before, [csv_listed[k].eqNullSafe(before[k]) for k in LAND_KEYS], "left_semi")
        fetched_members = decode_members(read_members(landed_before), charset)
        changed = changed_members(spark, fetched_members, layout.landing, touched).checkpoint(eager=True)
    land_archive_members(spark, csv_listed, layout.landing, partitions=touched, charset=charset, multi_line=multi_line)

    # Audit pass without content: the member list and what the landing tree holds now.
    landed = landed_keys(spark, layout.landing, touched).select(
        F.col("dataset").alias("l_dataset"), F.col("year").alias("l_year"), F.col("month").alias("l_month"),
        F.col("archive").alias("l_archive"), F.col("member").alias("l_member"), F.lit(True).alias("_landed"))
    per_task = listing.where(F.col("error").isNull()).join(keyed, "archive_path")
    members = (
        per_task.join(landed, (per_task["member"] == landed["l_member"]) & (per_task["archive"] == landed["l_archive"])
                      & F.nullif(per_task["dataset"], F.lit("")).eqNullSafe(landed["l_dataset"])
                      & per_task["year"].eqNullSafe(landed["l_year"]) & per_task["month"].eqNullSafe(landed["l_month"]),
                      "left")
        .join(t.select("task_id", "url"), "task_id")
        .select(run_id.alias("run_id"),
                F.lit(run_ts).cast("timestamp").alias("run_timestamp"), "task_id", "url",
                per_task["member"].alias("member_path"), F.col("basename").alias("filename"), "size_bytes",
                is_csv(per_task["member"]).alias("is_csv"), F.coalesce("_landed", F.lit(False)).alias("written"))
    )
    # Member detail is written once, row by row; the roll-up reads it back (pruned to
    # this run), so listing and landed checks are not computed twice.
    A.append_audit_members(members, layout.audit_members)
    mine = A.read_audit_members(spark, layout.audit_members).where(this_run)
    rolled = A.audit_rollup(mine.select("task_id", F.col("filename").alias("member"), "size_bytes", "is_csv",
                                        "written"), ["task_id"])
    bad = listing.where(F.col("error").isNotNull()).select("archive_path", F.lit(False).alias("archive_ok")).distinct()

    rows = matched.join(rolled, "task_id", "left").join(bad, "archive_path", "left")
    if fetch_log is not None:
        log = fetch_log.select("url", fetch_status("http_code", "error").alias("_fetch_state")).dropDuplicates(["url"])
        rows = rows.join(log, "url", "left")
        state = F.coalesce("_fetch_state", F.when(F.col("archive_path").isNotNull(), F.lit("success"))
                           .otherwise(F.lit("not_found")))
    else:
        state = F.when(F.col("archive_path").isNotNull(), F.lit("success")).otherwise(F.lit("not_found"))
    state = F.when((state == "success") & F.col("archive_path").isNull(), F.lit("error: archive missing")).otherwise(state)
    fetched_flag = state == "success"
    csv_count = F.coalesce("csv_count", F.lit(0))
    success = F.coalesce("success_count", F.lit(0))
    status = landing_outcome(fetched_flag, F.coalesce("archive_ok", F.lit(True)), csv_count, success, state)
    audit_rows = rows.select(
        run_id.alias("run_id"),
        F.lit(run_ts).cast("timestamp").alias("run_timestamp"),
        "url", "landing_path",
        F.lit(catalog_name).alias("catalog"), F.lit(schema_name).alias("schema"),
        "year", "month",
        status.alias("download_status"),
        landing_message(status, csv_count, success).alias("download_error_msg"),
        "files_in_zip", "files_written",
        csv_count.alias("csv_count"), success.alias("success_count"),
    )
    A.append_audit(audit_rows, layout.audit)
    mine = A.read_audit(spark, layout.audit).where(this_run)
    return mine, changed


def ingest_datasets(spark: SparkSession, datasets: list[tuple[str, str, str, dict]], layout: RunLayout,
                    options: IngestOptions, parallel: int = 4) -> DataFrame:
    """Ingest (landing_path, table_name, comment, types) datasets; tables are independent,
    so a thread pool runs their streams side by side. One result row per table. ``types`` of a
    table take precedence over the run's ``type_overrides``."""

    def one(item):
        landing_path, table_name, _comment, types = item
        own = replace(options, type_overrides=options.type_overrides | types)
        try:
            return ingest_table(
                spark, dataset_path(layout.landing, escape_partition_value(landing_path)),
                f"{layout.tables}/{table_name}", f"{layout.checkpoints}/{table_name}", table_name, own,
            ).collect()[0]
        except Exception as e:  # one table's failure does not stop the others
            return ("failed", table_name, None, None, None, f"{layout.checkpoints}/{table_name}", 0, str(e), None, None)

    if not datasets:
        return spark.createDataFrame([], RESULT_SCHEMA)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        rows = list(pool.map(one, datasets))
    return spark.createDataFrame([tuple(r) for r in rows], RESULT_SCHEMA)


def register_all(spark: SparkSession, results: DataFrame, datasets: list[tuple[str, str, str, dict]], layout: RunLayout,
                 schema_name: str) -> None:
    from quayside.streaming.tables import register_loaded_table, sql_string

    loaded = {r.table_name for r in results.where(F.col("status") == "success").select("table_name").collect()}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema_name}` LOCATION {sql_string(layout.root + '/catalog/' + schema_name)}")
    for _landing, table_name, comment, _types in datasets:
        if table_name in loaded:
            register_loaded_table(spark, f"`{schema_name}`.`{table_name}`", f"{layout.tables}/{table_name}",
                                  f"{layout.checkpoints}/{table_name}", comment or None)


def run_load(spark: SparkSession, catalog_path: str, archive_dir: str, root: str, *, mode: str = "backfill",
             start_year: int | None = None, end_year: int | None = None, as_of=None,
             catalog_name: str = "main", schema_name: str = "raw", statuses: tuple[str, ...] = ("success",),
             window: str = "1 DAY", options: IngestOptions | None = None, parallel: int = 4,
             fetch_log: DataFrame | None = None, register_tables: bool = False,
             report_changes: bool = False, charset: str = "UTF-8") -> dict[str, DataFrame]:
    """The whole run; returns tasks, audit (this run), selected, results, summary.

    ``charset`` is that of the CSV members (landed as UTF-8). ``register_tables`` names each loaded table ``schema_name.table_name`` in the
    session catalog, with the catalog comment (set once, at creation).
    """
    layout = RunLayout(root.rstrip("/"))
    now = as_of or _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    catalog = read_catalog(spark, catalog_path)
    tasks = plan_tasks(spark, catalog, mode, start_year, end_year, now)
    audit_rows, changed = fetch_and_land(spark, tasks, archive_dir, layout, catalog_name, schema_name, str(now),
                                         fetch_log, report_changes, charset, bool(options and options.multi_line))
    selected = A.recent_success(A.read_audit(spark, layout.audit), now, window, statuses)
    firsts = first_by_landing_path(catalog)
    chosen = (selected.join(firsts, "landing_path", "left")
              .select("landing_path", F.coalesce("_table_name", "landing_path").alias("table_name"),
                      F.coalesce("_comment", F.lit("")).alias("comment"),
                      F.coalesce("_types", F.create_map().cast("map<string,string>")).alias("types"))
              .orderBy("landing_path"))
    # Bounded by the number of datasets in the catalog.
    datasets = [(r.landing_path, r.table_name, r.comment, dict(r.types)) for r in chosen.collect()]
    opts = options or IngestOptions(as_of=as_of)
    results = ingest_datasets(spark, datasets, layout, opts, parallel)
    if register_tables:
        register_all(spark, results, datasets, layout, schema_name)
    summary = A.load_summary(results, mode, now, catalog_name, schema_name)
    out = {"tasks": tasks, "audit": audit_rows, "selected": chosen, "results": results, "summary": summary}
    if changed is not None:
        out["changed"] = changed
    return out


__all__ = ["RunLayout", "escape_partition_value", "fetch_and_land", "ingest_datasets", "plan_tasks", "run_load",
]
