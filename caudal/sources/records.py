"""Catalogue record pages (harvesting protocol XML).

A landed file is one answer of the service (or a few), so it is read whole; the service bounds its size.
Records are found by the namespace of the protocol, under whatever prefix a page binds it to; on a page that does not
declare it, by local name alone.  The other elements of the protocol count by their local name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal import schemas as S
from caudal.functions.text import unescape_entities

_HEADER_FIELDS = ("identifier", "datestamp", "setSpec")
_PREFIX = r"(?:[\w.-]+:)?"
#: The protocol's namespace.
PROTOCOL = "http://www.openarchives.org/OAI/2.0/"
_DECLARATION = r"""\sxmlns(?::([\w.-]+))?\s*=\s*(?:"([^"]*)"|'([^']*)')"""
_NOTHING = r"\s*(?:<!--(?s:.*?)-->\s*)*"


def _pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("page"))


def _found(pages: DataFrame, element: str) -> DataFrame:
    return pages.select("page", F.explode(F.regexp_extract_all("value", F.lit(element), 0)).alias("xml"))


def _elements(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """(page, element) of every ``<tag>``, with or without content."""
    element = rf"(?s)<{_PREFIX}{tag}(?:\s[^>]*?)?(?:/>|(?<!/)>.*?</{_PREFIX}{tag}>)"
    plain = F.regexp_replace("xml", rf"<(/?){_PREFIX}(?=[\w.-])", "<$1")
    return _found(_pages(spark, path), element).select(
        "page", F.from_xml(plain, schema, {"mode": "FAILFAST"}).alias("element")
    )


def _header(head: Column) -> list[Column]:
    """identifier, datestamp, first set and all sets of a header's text."""

    def pattern(name: str) -> str:
        return rf"(?s)<{_PREFIX}{name}(?:\s[^>]*)?>\s*(.*?)\s*</{_PREFIX}{name}>"

    sets = F.regexp_extract_all(head, F.lit(pattern("setSpec")), 1)
    return [
        *[unescape_entities(F.nullif(F.regexp_extract(head, pattern(n), 1), F.lit(""))).alias(n) for n in _HEADER_FIELDS],
        F.transform(sets, unescape_entities).alias("setSpecs"),
    ]


def read_metadata_formats(spark: SparkSession, path: str) -> DataFrame:
    """Offered metadata formats (SRC-05)."""
    return _elements(spark, path, "metadataFormat", S.METADATA_FORMAT).select("element.*")


def read_identifiers(spark: SparkSession, path: str) -> DataFrame:
    """(identifier, datestamp, setSpec, setSpecs) of the headers of identifier or record pages (SRC-06)."""
    header = rf"(?s)<{_PREFIX}header(?:\s[^>]*)?>{_NOTHING}<{_PREFIX}identifier[\s>].*?</{_PREFIX}header>"
    return _found(_pages(spark, path), header).select(*_header(F.col("xml")))


def read_page_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(page, token, completeListSize, cursor) of every page (SRC-08)."""
    return _elements(spark, path, "resumptionToken", S.PAGE_TOKEN).select(
        "page",
        F.col("element._VALUE").alias("token"),
        F.col("element._completeListSize").alias("completeListSize"),
        F.col("element._cursor").alias("cursor"),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(page, identifier, datestamp, setSpec, setSpecs, metadata) of every record (SRC-07).

    ``metadata`` is the inner XML as it was served, with the namespace declarations it needs from the elements around it.
    The XML reader would hand it out with its entities decoded, hence no longer well-formed;
    cutting the text where records start keeps it verbatim.
    """
    return parse_record_text(_pages(spark, path), "page")


def _declared(text: Column) -> Column:
    """(prefix, uri) of the namespace declarations in a text of tags, in order; the default namespace has the empty prefix.

    A URI stays escaped, as it stands between double quotes.
    """
    found = F.regexp_extract_all(text, F.lit(_DECLARATION), 0)
    uri = lambda x: F.concat(
        F.regexp_extract(x, _DECLARATION, 2), F.replace(F.regexp_extract(x, _DECLARATION, 3), F.lit('"'), F.lit("&quot;"))
    )
    return F.transform(found, lambda x: F.named_struct(F.lit("prefix"), F.regexp_extract(x, _DECLARATION, 1), F.lit("uri"), uri(x)))


def _escaped(prefix: Column) -> Column:
    return F.replace(F.replace(prefix, F.lit("."), F.lit("[.]")), F.lit("-"), F.lit("[-]"))


def _record_start(value: Column) -> Column:
    """The pattern before which a page's records start: ``record``, then ``header``, under a prefix of the protocol.

    A record of the protocol opens with its header.  An element named record inside the metadata does not.
    """
    own = F.array_distinct(F.filter(_declared(value), lambda x: x["uri"] == PROTOCOL)["prefix"])
    names = F.transform(own, lambda p: F.when(p == "", F.lit("")).otherwise(F.concat(_escaped(p), F.lit(":"))))
    prefix = F.when(F.size(own) > 0, F.concat(F.lit("(?:"), F.array_join(names, "|"), F.lit(")"))).otherwise(F.lit(_PREFIX))
    return F.concat(F.lit("(?=<"), prefix, F.lit(rf"record(?:\s[^>]*)?>{_NOTHING}<"), prefix, F.lit(r"header[\s>])"))


def _carried(metadata: Column, scope: Column) -> Column:
    """The metadata with those declarations of its ``scope`` (outer first) that it uses and does not make itself.

    They go to the end of its first tag, so that it can be parsed alone.  Metadata that declares what it uses stays as it was served.
    """
    inner_first = F.reverse(scope)
    prefixes = F.array_distinct(F.transform(inner_first, lambda x: x["prefix"]))

    def missing(prefix: Column) -> Column:
        # Up to the end of the first tag with the prefix: if it is not declared by then, an outer element must have done so.
        tag = F.concat(F.lit(r"(?s)^.*?<(?:"), F.when(prefix == "", F.lit(r"(?=[\w.-]+[\s/>])")).otherwise(F.concat(
            F.lit("(?=[^>]*?\\s"), _escaped(prefix), F.lit(r":)[\w]|"), _escaped(prefix), F.lit(":")
        )), F.lit(")[^>]*>"))
        upto = F.call_function("regexp_extract", metadata, tag, F.lit(0))
        name = F.when(prefix == "", F.lit(r"\sxmlns\s*=")).otherwise(F.concat(F.lit(r"\sxmlns:"), _escaped(prefix), F.lit(r"\s*=")))
        # Most prefixes of a page do not occur in most records: told without a pattern made for each.
        occurs = (prefix == "") | F.contains(metadata, F.concat(prefix, F.lit(":")))
        return occurs & (upto != "") & ~F.call_function("rlike", upto, name)

    def declaration(prefix: Column) -> Column:
        uri = F.get(F.filter(inner_first, lambda x: x["prefix"] == prefix), F.lit(0))["uri"]
        name = F.when(prefix == "", F.lit(" xmlns")).otherwise(F.concat(F.lit(" xmlns:"), prefix))
        return F.concat(name, F.lit('="'), uri, F.lit('"'))

    added = F.array_join(F.transform(F.filter(prefixes, missing), declaration), "")
    first = r"(?s)^((?:<\?.*?\?>|<!--.*?-->|\s)*<[^>]*?)(/?>)"
    opening, close = F.regexp_extract(metadata, first, 1), F.regexp_extract(metadata, first, 2)
    rest = F.substr(metadata, F.length(opening) + F.length(close) + 1)
    return F.when((added == "") | (opening == ""), metadata).otherwise(F.concat(opening, added, close, rest))


def parse_record_text(pages: DataFrame, *keep: str) -> DataFrame:
    """Records of whole pages in ``value``, with the columns to ``keep`` in front.

    A record whose header cannot be read stays, with a NULL identifier.  ``setSpec`` is the first of ``setSpecs``.
    ``metadata`` carries the namespace declarations of the elements around it that it needs.
    """
    starts = pages.select(*keep, "value", _record_start(F.col("value")).alias("start"))
    pieces = starts.select(*keep, "start", F.split("value", F.col("start")).alias("pieces"))
    # What stands before the first record of a page is none; the elements it opens are around all records.
    head = F.get("pieces", F.lit(0))

    def is_record(piece: Column) -> Column:
        return F.call_function("rlike", piece, F.concat(F.lit("^"), F.col("start")))

    around = _declared(F.when(is_record(head), F.lit("")).otherwise(head))
    # Told from the page before it is dealt out, so that no record carries its page along.
    told = pieces.select(*keep, "start", "pieces", around.alias("around"))
    rows = told.select(*keep, "start", "around", F.explode("pieces").alias("record")).filter(is_record(F.col("record")))
    head = F.regexp_extract("record", rf"(?s)^(.*?)</{_PREFIX}header>", 1)
    wrapped = rf"(?s)<{_PREFIX}metadata((?:\s[^>]*)?)>\s*(.*\S)\s*</{_PREFIX}metadata>"
    opened = F.concat(F.regexp_extract("record", r"^<[^>]*>", 0), F.regexp_extract("record", wrapped, 1))
    parts = rows.select(
        *keep, *_header(head), F.nullif(F.regexp_extract("record", wrapped, 2), F.lit("")).alias("metadata"),
        F.concat("around", _declared(opened)).alias("scope"),
    )
    # Spelled so that a filter for records with metadata asks for the text served alone and does not work out its declarations.
    served = F.col("metadata")
    metadata = F.when(served.isNotNull(), F.coalesce(_carried(served, F.col("scope")), served, F.lit("")))
    return parts.select(*[c for c in parts.columns if c not in ("metadata", "scope")], metadata.alias("metadata"))
