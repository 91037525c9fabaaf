"""Column expressions (all JVM-side, codegen friendly)."""

from .metric import canonical_name, canonical_unit, convert_value, fingerprint, fixed10, unit_key
from .text import blank_to_null, is_identifier, parse_float, py_strip
from .timestamps import floor_window, iso_seconds, utc_instant, with_parsed_iso

__all__ = [
    "blank_to_null",
    "canonical_name",
    "canonical_unit",
    "convert_value",
    "fingerprint",
    "fixed10",
    "floor_window",
    "is_identifier",
    "iso_seconds",
    "parse_float",
    "unit_key",
    "utc_instant",
    "with_parsed_iso",
    "py_strip",
]
