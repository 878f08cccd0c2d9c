"""Column builders: clock/zone rules (R1, R2) and typed range predicates."""

from tarmac.functions.clock import (  # noqa: F401
    air_time_bucket, date_time_text, delay_minutes, elapsed_minutes, epoch_seconds,
    ground_minutes, hhmm, inverse_delay_minutes, offset_zone_id, repair_arrival,
    utc_millis, with_utc_millis, zone_offset_text,
)
from tarmac.functions.ranges import (  # noqa: F401
    closed, day_range, half_open, open_range, starts_with, utc_instant,
)
