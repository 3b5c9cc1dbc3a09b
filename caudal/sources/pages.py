"""Shared page readers.

A landing folder holds many page files; reading the folder is the union of all
pages.  Pretty-printed pages (one document per file) need ``multi_line`` and
are one task each, which page-sized files allow.  Pages landed as JSON lines
are splittable and should be preferred for bulk loads.

A page that is not valid JSON fails the job: dropping it would lose its rows
silently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = "input_order"


def input_order(*parts) -> "Column":  # noqa: F821
    """Sortable input position: file, then position of the line in its file scan."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("line"),
        *parts,
    )


def read_items(
    spark: SparkSession, path: str, page_schema: str, field: str,
    multi_line: bool = True, with_order: bool = False,
) -> DataFrame:
    """One row per element of the page array; a page without the array has no rows.

    Partition folders of the landing path (``provider=...``) become columns, and
    a filter on them skips whole folders.
    """
    pages = (
        spark.read.schema(page_schema)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .json(path)
    )
    folders = [c for c in pages.columns if c != field]
    if not with_order:
        return pages.select(F.inline(field), *folders)
    positioned = pages.select(
        input_order().alias("_file"), F.posexplode(field).alias("_pos", "_item"), *folders
    )
    return positioned.select(
        "_item.*", *folders, F.struct("_file.file", "_file.line", F.col("_pos").alias("pos")).alias(ORDER)
    )


def read_flat(
    spark: SparkSession, path: str, schema: str, multi_line: bool = True
) -> DataFrame:
    """A JSON array (or JSON lines) of flat rows."""
    return (
        spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    )
