"""Names, codes and composed identifiers (P-02..P-06, P-16, P-17, S-17)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caudal import dictionaries as D


def short_name(name: Column) -> Column:
    """The first twelve characters of the name without its spaces (P-03)."""
    return F.substring(F.replace(name, F.lit(" "), F.lit("")), 1, 12)


def last_property(parameters: Column, name: str) -> Column:
    """Value of a named property; the last one wins where a name repeats (P-02)."""
    return F.try_element_at(F.filter(parameters, lambda p: p["name"] == name), F.lit(-1))["value"]


def original_id(identifier: Column) -> Column:
    """What follows the last colon (P-04)."""
    return F.regexp_replace(identifier, r"^.*:", "")


def organisation_code(name: Column, codes: dict[str, str] | None = None) -> Column:
    """Short code of an organisation (P-06).

    Without an organisation the harvest source stands in; a name outside the
    dictionary is shortened to five capitals.
    """
    mapped = D.map_lookup(codes or D.ORGANISATION_CODES, name)
    shortened = F.substring(F.replace(F.upper(name), F.lit(" "), F.lit("")), 1, 5)
    return F.coalesce(mapped, shortened, F.lit(D.SOURCE_A))


def parent_id_a(country: Column, organisation: Column, original: Column) -> Column:
    """COUNTRY prefix, organisation and original id; a missing id prints as ``None`` (P-05)."""
    return F.concat_ws(
        "_",
        F.coalesce(F.substring(F.upper(country), 1, 2), F.lit("")),
        organisation,
        F.coalesce(original, F.lit("None")),
    )


def parent_id_b(station: Column) -> Column:
    return F.concat(F.lit(D.PARENT_PREFIX_B), station.cast("string"))


def _whole_hours(step: Column) -> Column:
    # Steps below one hour truncate to 0: the published id format has no fractions.
    return step.cast("long").cast("string")


def child_id_a(parent: Column, step: Column, code: Column) -> Column:
    """Series id in catalogue A; NULL without a parent or a step (P-16)."""
    return F.concat(parent, F.lit(f"_{D.CHILD_MARK_A}_"), _whole_hours(step), F.lit("_"), code)


def child_id_b(station: Column, step: Column, variable: Column) -> Column:
    """Series id in catalogue B; an unmapped variable leaves the last part empty (P-17)."""
    quantity = D.map_lookup(D.QUANTITY_BY_VARIABLE, variable.cast("int"))
    return F.concat(
        parent_id_b(station), F.lit(f"_{D.SOURCE_B}_"), _whole_hours(step), F.lit("_"),
        F.coalesce(quantity, F.lit("")),
    )


def percentile_column(p: float) -> str:
    """Column name of a percentile, e.g. 0.05 -> THRESHOLD_P05 (S-17)."""
    return "THRESHOLD_P%02d" % round(p * 100)
