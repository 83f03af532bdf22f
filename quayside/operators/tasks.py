"""Catalog x periods -> expected files.

Each qualifying template explodes its own period array (a bounded ``sequence``), so
there is no join at all: the work is a generator per catalog row.

Two forms:

* ``expected_files`` (default): one row per distinct URL. A template with month
  names gives one row per month; with ``quarter`` (no month) one per quarter, month =
  first month of the quarter; with only ``year`` one per year, month NULL; with no
  parameters one row, year/month NULL.
* ``per_period=True``: the reference's rule, one task per template and period,
  repeating the same URL for yearly and quarterly templates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.calendar import month_name, period_columns, periods_between, previous_period, quarter_label
from quayside.functions.paths import expand_template, partition_path

# Parameter names a template may use.
KNOWN_PARAMETERS = ["year", "month_name", "quarter"]


def qualifies(parameters: Column | str = "parameters") -> Column:
    """All parameters known and none repeated (a template with unknown ones gives no task)."""
    p = F.col(parameters) if isinstance(parameters, str) else parameters
    known = F.array(*[F.lit(k) for k in KNOWN_PARAMETERS])
    return F.size(F.array_intersect(p, known)) == F.size(p)


def backfill_periods(start_year: int, end_year: int) -> Column:
    return periods_between(F.lit(start_year), F.lit(end_year))


def incremental_periods(as_of: Column | str) -> Column:
    """The month before ``as_of`` (the reference's incremental mode)."""
    a = F.col(as_of) if isinstance(as_of, str) else as_of
    return F.array(previous_period(a))


def expected_files(catalog: DataFrame, periods: Column, per_period: bool = False) -> DataFrame:
    """Tasks: position, table_name, landing_path, url, year, month, quarter, parameters.

    ``catalog`` is ``read_catalog`` output (or any frame with those columns);
    ``periods`` an array<date> expression of first-of-month dates.
    """
    p = F.col("parameters")
    good = catalog.where(qualifies(p))
    static = good.where(F.size(p) == 0).select(
        "position", "table_name", "landing_path",
        F.col("url_pattern").alias("url"),
        F.lit(None).cast("int").alias("year"),
        F.lit(None).cast("int").alias("month"),
        F.lit(None).cast("string").alias("quarter"),
    )
    timed = good.where(F.size(p) > 0).select(
        "position", "table_name", "landing_path", "url_pattern", "parameters",
        F.explode(periods).alias("period_start"),
    ).select("*", *period_columns("period_start"))

    has_month = F.array_contains(p, "month_name")
    has_quarter = F.array_contains(p, "quarter")
    if per_period:
        g_year, g_month, g_quarter = F.col("year"), F.col("month"), F.col("quarter")
    else:
        g_year = F.col("year")
        g_month = (F.when(has_month, F.col("month"))
                   .when(has_quarter, F.ceil(F.col("month") / 3).cast("int") * 3 - 2))
        g_quarter = F.when(has_month | has_quarter, F.col("quarter"))
    gran = timed.select(
        "position", "table_name", "landing_path", "url_pattern", "parameters",
        g_year.cast("int").alias("year"), g_month.cast("int").alias("month"), g_quarter.alias("quarter"),
        F.col("month_name").alias("_period_month_name"), F.col("quarter").alias("_period_quarter"),
    )
    params = {
        "year": F.when(F.array_contains(p, "year"), F.col("year")),
        "month_name": F.when(F.array_contains(p, "month_name"), F.col("_period_month_name")),
        "quarter": F.when(F.array_contains(p, "quarter"), F.col("_period_quarter")),
    }
    expanded = gran.select(
        "position", "table_name", "landing_path",
        expand_template("url_pattern", params).alias("url"),
        "year", "month", "quarter",
    )
    if not per_period:
        expanded = expanded.distinct()
    return static.unionByName(expanded)


def skipped_templates(catalog: DataFrame) -> DataFrame:
    """Templates that give no task because a parameter is unknown or repeated."""
    return catalog.where(~qualifies("parameters")).select(
        "position", "table_name",
        F.array_except("parameters", F.array(*[F.lit(k) for k in KNOWN_PARAMETERS])).alias("unknown_parameters"),
    )


def task_counts(tasks: DataFrame) -> DataFrame:
    """tasks: number of tasks; tables: number of distinct table names."""
    return tasks.agg(F.count(F.lit(1)).alias("tasks"), F.countDistinct("table_name").alias("tables"))


def task_sample(tasks: DataFrame, n: int = 3, prefix: int = 80) -> DataFrame:
    """The first ``n`` tasks in catalog and period order, with the URL cut to ``prefix``
    characters for display (a top-k: Spark plans it as TakeOrderedAndProject)."""
    return (
        tasks.orderBy(F.col("position"), F.col("year").asc_nulls_first(), F.col("month").asc_nulls_first(), "url")
        .limit(n)
        .select("position", "table_name", F.substring("url", 1, prefix).alias("url_prefix"), "year", "month")
    )
