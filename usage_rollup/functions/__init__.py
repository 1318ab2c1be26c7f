from usage_rollup.functions.columns import (  # noqa: F401
    bound_like,
    day_bucket,
    half_open,
    load_id,
    month_bucket,
    month_label,
    python_major_minor,
    week_bucket,
    date_label,
)
from usage_rollup.functions.labels import (  # noqa: F401
    compact_count,
    compact_kpi,
    signed_percent,
    long_date,
    short_date,
    period_label,
    with_labels,
)
from usage_rollup.functions.dates import partition_bounds, range_dates  # noqa: F401
