"""Composed jobs: one lazy plan each, from landed pages to output tables."""

from caudal.plans.catalogue_a import TablesA, enrich_organisations, make_tables_a, write_tables_a
from caudal.plans.catalogue_b import TablesB, make_tables_b, write_tables_b
from caudal.plans.observations import observation_statistics, with_observation_statistics
from caudal.plans.records import record_harvest, semantic_table, shared_locations

__all__ = [
    "TablesA", "TablesB", "enrich_organisations", "make_tables_a", "make_tables_b",
    "observation_statistics", "record_harvest", "semantic_table", "shared_locations",
    "with_observation_statistics", "write_tables_a", "write_tables_b",
]
