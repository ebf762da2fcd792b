"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from bizlens.functions.dates import (  # noqa: F401
    day_name,
    month_name,
    parse_short_date,
    seconds_between,
    short_date_text,
    week_label,
    week_of_month,
    week_start,
)
from bizlens.functions.numeric import div, money, rounded  # noqa: F401
from bizlens.functions.text import id_list, null_markers, strip_units  # noqa: F401
