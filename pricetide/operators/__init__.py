"""DataFrame -> DataFrame operators; use with ``df.transform``."""

from pricetide.operators.long import (  # noqa: F401
    annotate_long,
    finish_long,
    long_with_nulls,
    normalise_wide,
    rejected_rows,
    to_long,
    with_zone_columns,
)
from pricetide.operators.quality import (  # noqa: F401
    all_null,
    day_completeness,
    day_spine,
    dst_calendar,
    dst_slots_all_null,
    quality_report,
    slot_pattern_violations,
    utc_hour_gaps,
)
from pricetide.operators.reshape import (  # noqa: F401
    drop_missing_price,
    slot_label_filter,
    snake_case_columns,
    split_by,
    union_parts,
    with_slot_time,
)
