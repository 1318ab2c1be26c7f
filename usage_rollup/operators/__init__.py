from usage_rollup.operators.rollup import daily_rollup, flatten_log  # noqa: F401
from usage_rollup.operators.quality import (  # noqa: F401
    DataQualityError,
    check_quality,
    quality_report,
    quality_stats,
    validate_stats,
)
from usage_rollup.operators.maintain import (  # noqa: F401
    append,
    delete_range,
    delete_range_table,
    ensure_database,
    ensure_target,
    export_partitioned,
    replace_range,
    target_exists,
    upsert_by_key,
    upsert_frame,
    write_rollup,
)
from usage_rollup.operators import reports  # noqa: F401
