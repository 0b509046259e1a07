"""Column expressions (all JVM-side built-ins, no UDFs)."""

from pricetide.functions.slots import (  # noqa: F401
    day_start,
    parse_delivery_day,
    slot_hour,
    slot_local_timestamp,
)
from pricetide.functions.tz import (  # noqa: F401
    DAY_KINDS,
    day_kind,
    hours_in_day,
    is_ambiguous,
    is_nonexistent,
    local_to_utc_naive,
    utc_offset_hours,
    zone_label,
)
