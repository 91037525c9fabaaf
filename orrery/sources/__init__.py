"""Sources: raw telemetry readers, the driver-table adapter, file identity."""

from .adapter import events_to_raw, raw_telemetry
from .files import file_checksums
from .telemetry import detect_format, read_source, read_telemetry, with_row_ordinals

__all__ = [
    "detect_format",
    "events_to_raw",
    "file_checksums",
    "raw_telemetry",
    "read_source",
    "read_telemetry",
    "with_row_ordinals",
]
