"""Column functions; all run inside the JVM."""

from .scalars import (  # noqa: F401
    LONG_MAX, context_columns, day_type, floor_time, learning_cap, log_id, off_hours, pair_hash, pair_key, parse_time, positive_round,
    protocol_norm, quantile_round, saturating_add, saturating_sum, time_slot, total_order, window_end)
