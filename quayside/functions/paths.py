"""Template expansion, partition paths, table names and small string helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def expand_template(pattern: Column | str, params: dict[str, Column | str | None]) -> Column:
    """Replace each ``{key}`` by its value (cast to string).

    Keys whose value is None are not replaced, and placeholders that are not in
    ``params`` stay in the text, as in the reference.
    """
    out = _c(pattern)
    for key, value in params.items():
        if value is None:
            continue
        out = F.coalesce(F.replace(out, F.lit("{" + key + "}"), _c(value).cast("string")), out)
    return out


def partition_path(base: Column | str, year: Column | str, month: Column | str) -> Column:
    """``base/year=Y/month=MM``, ``base/year=Y`` or ``base``.

    A NULL or 0 year gives the base path (a month without a year is ignored), the
    month is zero-padded to two digits.
    """
    b, y, m = _c(base), _c(year), _c(month)
    has_y = y.isNotNull() & (y != 0)
    has_m = m.isNotNull() & (m != 0)
    return (
        F.when(has_y & has_m, F.concat(b, F.lit("/year="), y.cast("string"), F.lit("/month="),
                                       F.lpad(m.cast("string"), 2, "0")))
        .when(has_y, F.concat(b, F.lit("/year="), y.cast("string")))
        .otherwise(b)
    )


def full_table_name(catalog: Column | str, schema: Column | str, table: Column | str) -> Column:
    return F.concat_ws(".", _c(catalog), _c(schema), _c(table))


def default_checkpoint(given: Column | str, root: Column | str, catalog: Column | str,
                       schema: Column | str, table: Column | str) -> Column:
    """The given checkpoint path, or ``root/catalog/schema/checkpoints/table`` when empty."""
    return F.coalesce(
        F.nullif(_c(given), F.lit("")),
        F.concat_ws("/", _c(root), _c(catalog), _c(schema), F.lit("checkpoints"), _c(table)),
    )


def int_or_null(text: Column | str) -> Column:
    """'' -> NULL, '12' -> 12, anything else not a number -> NULL."""
    return F.nullif(_c(text), F.lit("")).try_cast("int")


def basename(path: Column | str) -> Column:
    """Last path component ('' for a path ending in '/')."""
    return F.regexp_extract(_c(path), r"[^/]*$", 0)
