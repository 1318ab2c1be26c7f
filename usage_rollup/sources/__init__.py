from usage_rollup.sources.scan import (  # noqa: F401
    load_rollup,
    log_predicate,
    mock_log,
    read_partitioned,
    resolve_source,
    scan_log,
    sql_over_rollup,
)
from usage_rollup.sources.driverdata import (  # noqa: F401
    download_log,
    events_as_log,
    flat_log,
    orders_as_log,
)
