"""Column functions (built-in Spark expressions) and the small pure helpers behind them."""

from quayside.functions.calendar import (
    MONTH_NAMES,
    month_name,
    period_columns,
    period_grid,
    periods_between,
    previous_period,
    quarter_label,
)
from quayside.functions.names import snake_case, snake_case_col, unique_snake_names
from quayside.functions.paths import (
    basename,
    default_checkpoint,
    expand_template,
    full_table_name,
    int_or_null,
    partition_path,
)

__all__ = [
    "MONTH_NAMES",
    "basename",
    "default_checkpoint",
    "expand_template",
    "full_table_name",
    "int_or_null",
    "month_name",
    "partition_path",
    "period_columns",
    "period_grid",
    "periods_between",
    "previous_period",
    "quarter_label",
    "snake_case",
    "snake_case_col",
    "unique_snake_names",
]
