"""Record harvest, semantic table and cross-catalogue filter (JOB-04..JOB-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caudal import schemas as S
from caudal.operators import membership, quality
from caudal.operators.filters import records_where
from caudal.operators.semantic import semantic_mapping
from caudal.sinks import write_csv, write_records_xml
from caudal.sources import (
    read_page_tokens, read_records, read_semantic_rows, read_series_csv,
)


def record_harvest(
    spark: SparkSession, landing: str, output: str | None = None, set_spec=None, per_record: bool = False,
    index: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Records of a landing folder and the completeness of each harvest in it (JOB-06).

    ``output`` gets their XML, as a table or (``per_record``) as files by name, whose names go
    to a table in the folder ``index``; ``quality.missing_intervals`` tells what to ask for again.
    """
    everything = read_records(spark, landing)
    records = records_where(everything, set_spec=set_spec)
    if output is not None:
        write_records_xml(records, output, per_record, index)
    return records, quality.completeness(everything, read_page_tokens(spark, landing))


def semantic_table(spark: SparkSession, pages: str, output: str | None = None) -> DataFrame:
    """Semantic mapping from landed HTML pages (JOB-05)."""
    table = semantic_mapping(read_semantic_rows(spark, pages))
    if output is not None:
        write_csv(table, output)
    return table


def shared_locations(
    spark: SparkSession, series_path: str, other_path: str, output: str, table: str
) -> None:
    """Rows of one saved series table whose location occurs in another (JOB-04)."""
    columns = S.SERIES_COLUMNS[table]
    mine, other = (read_series_csv(spark, p, columns) for p in (series_path, other_path))
    write_csv(membership.in_other_catalogue(mine, other), output)
