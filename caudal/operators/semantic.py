"""Semantic mapping table from HTML cells (SRC-04, S-12, S-13, S-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions.text import cell_text, link_target, null_text
from caudal.operators.filters import semantic_variables
from caudal.schemas import SEMANTIC_COLUMNS

_LINKS = ("variableURI", "unitsURI")
# Columns where the text "null" stands for no value.
_NULLABLE = ("interpolationType", "timeSupport", "timeInterval", "timeUnits", "realTime")


def semantic_mapping(rows: DataFrame) -> DataFrame:
    """Fourteen named columns per variable row."""
    # All texts of a row in one pass over its cells, instead of one large
    # expression per column.
    parsed = semantic_variables(rows).select("cells", F.transform("cells", cell_text).alias("texts"))

    def column(i: int, name: str):
        if name in _LINKS:
            return null_text(link_target(F.get("cells", F.lit(i))))
        text = F.get("texts", F.lit(i))
        return null_text(text) if name in _NULLABLE else text

    return parsed.select([column(i, n).alias(n) for i, n in enumerate(SEMANTIC_COLUMNS)])
