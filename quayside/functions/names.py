"""Column-name normalisation.

Rule, in order: every run of characters outside ``[a-zA-Z0-9]`` becomes one ``_``,
the result is lower-cased, and ``_`` is stripped at both ends. No camel-case split,
digits kept, non-ASCII letters become ``_``.

Two decisions go beyond the plain rule so that a header can never produce an
unusable table: a name that normalises to the empty string becomes
``col_{position}`` (1-based), and a name that collides with an earlier one gets
``_2``, ``_3`` ... by position.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_NON_ALNUM = re.compile(r"[^a-zA-Z0-9]+")


def snake_case(name: str) -> str:
    """Plain rule for one name (may return '' for names made only of symbols)."""
    return _NON_ALNUM.sub("_", name).lower().strip("_")


def snake_case_col(col: Column | str) -> Column:
    """The same rule as a JVM expression, for string values (header tables, catalogs)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(F.lower(F.regexp_replace(c, r"[^a-zA-Z0-9]+", "_")), F.lit("_"))


def unique_snake_names(names: list[str], reserved: tuple[str, ...] = ()) -> list[str]:
    """Normalised names for a header, made unique by position.

    ``reserved`` names (lineage columns) count as taken, so a data column can never
    shadow them.
    """
    taken = {r for r in reserved}
    out: list[str] = []
    for pos, raw in enumerate(names, start=1):
        base = snake_case(raw or "") or f"col_{pos}"
        cand, k = base, 1
        while cand in taken:
            k += 1
            cand = f"{base}_{k}"
        taken.add(cand)
        out.append(cand)
    return out
