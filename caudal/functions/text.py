"""Text of HTML and XML cells (S-12..S-15)."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

_HREF = r"""(?is)<a\b[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_ENTITY = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def unescape_tags(text: Column) -> Column:
    """Turn an entity-escaped inner document into tags (S-14)."""
    return F.replace(
        F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")
    )


def strip_line_breaks(text: Column) -> Column:
    return F.regexp_replace(text, r"[\r\n]", "")


def null_text(text: Column) -> Column:
    """The text ``null`` means no value (S-12)."""
    return F.nullif(text, F.lit("null"))


def unescape_entities(text: Column) -> Column:
    """Decode named and numeric character references.

    The text is cut before each ``&``; only a piece that starts with a complete
    reference changes, so a bare ampersand survives.  A number that is no character becomes U+FFFD.
    """
    # One literal parsed by the JVM; 250 pairs of Column literals would each cost
    # a call from Python.
    named = F.from_json(
        F.lit("{" + ",".join(f'"{k}":"\\u{v:04x}"' for k, v in sorted(name2codepoint.items())) + "}"),
        "MAP<STRING, STRING>",
    )

    def decode_point(digits: Column, base: int) -> Column:
        # Leading zeros say nothing; what is left after seven digits is no code point.
        short = F.regexp_replace(digits, "^0+(?=.)", "")
        point = F.when(F.length(short) <= 7, F.conv(short, base, 10).cast("int"))
        real = (point > 0) & (point < 0x110000) & ~point.between(0xD800, 0xDFFF)
        return F.when(real, F.decode(F.unhex(F.lpad(F.hex(F.when(real, point).otherwise(32)), 8, "0")), "UTF-32")).otherwise(
            F.when(point.isNull() | ~real, F.lit("\ufffd"))
        )

    def piece(x: Column, i: Column) -> Column:
        ref = F.regexp_extract(x, _ENTITY, 1)
        char = (
            F.when(ref.rlike("^#[xX]"), decode_point(F.substr(ref, F.lit(3)), 16))
            .when(ref.startswith("#"), decode_point(F.substr(ref, F.lit(2)), 10))
            .when(ref == "apos", F.lit("'"))
            .otherwise(F.try_element_at(named, ref))
        )
        rest = F.regexp_replace(x, r"^[^;]*;", "")
        return (
            F.when(i == 0, x)
            .when((ref == "") | char.isNull(), F.concat(F.lit("&"), x))
            .otherwise(F.concat(char, rest))
        )

    decoded = F.array_join(F.transform(F.split(text, "&"), piece), "")
    return F.when(text.contains("&"), decoded).otherwise(text)


def cell_text(cell: Column) -> Column:
    """Text of a table cell up to its first child element, without line breaks (S-13).

    An empty cell has no text (NULL); one that holds only a line break has the
    empty text.
    """
    leading = F.regexp_extract(cell, r"^([^<]*)", 1)
    return F.when(leading != "", unescape_entities(strip_line_breaks(leading)))


def link_target(cell: Column) -> Column:
    """``href`` of the first link in a cell, NULL without one (S-15)."""
    parts = [F.nullif(F.regexp_extract(cell, _HREF, i), F.lit("")) for i in (1, 2, 3)]
    return F.when(cell.rlike(_HREF), unescape_entities(F.coalesce(*parts, F.lit(""))))
