"""Catalogue A: monitoring-point pages, time-series pages, variable dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal import schemas as S
from caudal.functions.text import unescape_tags
from caudal.sources.pages import ORDER, input_order, read_items


def read_point_pages(spark: SparkSession, path: str, **options) -> DataFrame:
    """Monitoring points, one row per ``results`` element (SRC-01, SRC-15)."""
    return read_items(spark, path, S.POINT_PAGE, "results", **options)


def read_series_pages(spark: SparkSession, path: str, **options) -> DataFrame:
    """Time series, one row per ``member`` element (SRC-02, SRC-15)."""
    return read_items(spark, path, S.SERIES_PAGE, "member", **options)


def read_legacy_pages(spark: SparkSession, path: str, **options) -> DataFrame:
    """Time series of the older ``features`` pages, which carry the organisations."""
    return read_items(spark, path, S.LEGACY_PAGE, "features", **options)


def read_variable_dictionary(
    spark: SparkSession, path: str, escaped: bool = True, defaults: bool = True
) -> DataFrame:
    """(variableCode, variableName, unitName, input_order) of a variables response (SRC-03).

    The inner document of the response is entity-escaped.  The text is cut at
    the closing bracket of each ``variable`` tag, so one record holds one
    variable and a long response is split over tasks like any text file.
    Default rows precede the harvested ones.
    """
    chunks = (
        spark.read.option("lineSep", "variable&gt;" if escaped else "variable>")
        .text(path)
        .select(input_order().alias(ORDER), unescape_tags(F.col("value")).alias("chunk"))
    )
    # What precedes the closing tag: from the code element up to "</" or "</prefix:".
    body = F.regexp_extract("chunk", r"(?s)(<(?:[\w.-]+:)?variableCode\b.*)</(?:[\w.-]+:)?$", 1)
    parsed = chunks.select(ORDER, body.alias("body")).filter(F.col("body") != "").select(
        F.from_xml(
            F.concat(F.lit("<variable>"), F.col("body"), F.lit("</variable>")),
            S.VARIABLE_XML,
            {"ignoreNamespace": "true", "mode": "FAILFAST"},
        ).alias("v"),
        ORDER,
    )
    rows = parsed.select("v.variableCode", "v.variableName", F.col("v.unit.unitName"), ORDER)
    return with_default_variables(rows) if defaults else rows


def with_default_variables(rows: DataFrame) -> DataFrame:
    """Put the default rows before the harvested ones."""
    first = F.struct(
        F.lit("").alias("file"), F.lit(-1).cast("long").alias("line")
    ).alias(ORDER)
    defaults = D.default_variables(rows.sparkSession).select("*", first)
    return defaults.unionByName(rows)
