"""Period columns: month name, quarter, period grids and the previous month.

A period is the first day of a month (``DateType``); all other period columns
derive from it, so a grid is one ``sequence`` + ``explode`` and stays on the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The lower-case English month names used in file templates.
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_name(month: Column | str) -> Column:
    """Integer month -> lower-case English name; NULL outside 1..12."""
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    m = _c(month)
    return F.when(m.between(1, 12), F.try_element_at(names, m.cast("int")))


def quarter_label(month: Column | str) -> Column:
    """Integer month -> 'q1'..'q4'; NULL outside 1..12 (the reference maps those to q4)."""
    m = _c(month)
    return F.when(m.between(1, 12), F.concat(F.lit("q"), F.ceil(m / 3).cast("int").cast("string")))


def period_columns(period_start: Column | str) -> list[Column]:
    """year, month, month_name, quarter of a first-of-month date."""
    d = _c(period_start)
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.lower(F.date_format(d, "MMMM")).alias("month_name"),
        F.concat(F.lit("q"), F.quarter(d).cast("string")).alias("quarter"),
    ]


def periods_between(start_year: Column | str, end_year: Column | str) -> Column:
    """Array of first-of-month dates, January of start to December of end, inclusive."""
    s, e = _c(start_year), _c(end_year)
    return F.sequence(F.make_date(s, F.lit(1), F.lit(1)), F.make_date(e, F.lit(12), F.lit(1)),
                      F.expr("INTERVAL 1 MONTH"))


def period_grid(spark: SparkSession, start_year: int, end_year: int) -> DataFrame:
    """All months of the inclusive year range: 12 rows per year, ordered columns.

    The grid holds 12 x years rows, a size fixed by the two parameters, so callers
    may broadcast it.
    """
    base = spark.range(1).select(F.explode(periods_between(F.lit(start_year), F.lit(end_year))).alias("period_start"))
    return base.select(*period_columns("period_start"), "period_start")


def previous_period(as_of: Column | str) -> Column:
    """First day of the month before ``as_of``'s month."""
    return F.add_months(F.trunc(_c(as_of), "MM"), -1)
