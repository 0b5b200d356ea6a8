"""Column -> Column functions: indexes, labels, dates and small scalars."""

from airindex.functions.dates import (clip_at_zero, date_id, date_parts, day_end_epoch,
                                      epoch_to_timestamp, iso_day_of_week, mask_above, slug,
                                      to_epoch)
from airindex.functions.index import (breakpoint_table, dominant_pollutant, overall_index,
                                      ozone_index, piecewise_index)
from airindex.functions.labels import (health_label, is_hazardous, is_valid_day, level_label,
                                       quality_status)

__all__ = [
    "breakpoint_table", "clip_at_zero", "date_id", "date_parts", "day_end_epoch",
    "dominant_pollutant", "epoch_to_timestamp", "health_label", "is_hazardous",
    "is_valid_day", "iso_day_of_week", "level_label", "mask_above", "overall_index",
    "ozone_index", "piecewise_index", "quality_status", "slug", "to_epoch",
]
