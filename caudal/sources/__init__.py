"""Readers of landed harvest files.  Each returns a lazy DataFrame with a declared schema."""

from caudal.sources.catalogue_a import (
    read_legacy_pages, read_point_pages, read_series_pages, read_variable_dictionary,
)
from caudal.sources.catalogue_b import (
    read_monthly_stats, read_observations, read_series_b, read_stations_b, read_variables_b,
)
from caudal.sources.records import (
    read_identifiers, read_metadata_formats, read_page_tokens, read_records,
)
from caudal.sources.semantic import read_semantic_rows
from caudal.sources.tables import read_basins, read_series_csv

__all__ = [
    "read_basins", "read_identifiers", "read_legacy_pages", "read_metadata_formats",
    "read_monthly_stats", "read_observations", "read_page_tokens", "read_point_pages",
    "read_records", "read_semantic_rows", "read_series_b", "read_series_csv",
    "read_series_pages", "read_stations_b", "read_variable_dictionary", "read_variables_b",
]
