"""Scalar functions: Column in, Column out, all built from native expressions."""

from caudal.functions.durations import interval_hours, interval_seconds, iso_duration_hours
from caudal.functions.identifiers import (
    child_id_a, child_id_b, last_property, organisation_code, original_id, parent_id_a,
    parent_id_b, percentile_column, short_name,
)
from caudal.functions.text import (
    cell_text, link_target, null_text, strip_line_breaks, unescape_entities, unescape_tags,
)
from caudal.functions.times import instant, round_to_minute

__all__ = [
    "cell_text", "child_id_a", "child_id_b", "instant", "interval_hours", "interval_seconds",
    "iso_duration_hours", "last_property", "link_target", "null_text", "organisation_code",
    "original_id", "parent_id_a", "parent_id_b", "percentile_column", "round_to_minute",
    "short_name", "strip_line_breaks", "unescape_entities", "unescape_tags",
]
