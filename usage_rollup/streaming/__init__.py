from usage_rollup.streaming.incremental import start_incremental_rollup, upsert_affected_dates  # noqa: F401
