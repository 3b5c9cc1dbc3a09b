"""Adapter views: the benchmark tables in the shape of landed catalogue rows.

Each view derives every row of a whole table by fixed formulas, so a query on
it grows with the table.  The comparison SQL states the same formulas in its
own words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal.session import scratch_dir
from caudal.sinks.named import write_named
from caudal.sources.tables import basins_from_rings

ORGANISATIONS = list(D.ORGANISATION_CODES)
COUNTRIES = ["ARG", "BRA", "PRY", "URY", "BOL"]
NAMES = [
    "Precipitation", "Level", "Flux, discharge",
    "Air temperature (at specified distance from reference surface)", "No such variable", "Chuva",
    "Nivel de Río", "Vazao", "Inflow discharge (to the reservoir)", "Snow depth", "Stream level",
    "Volume",
]
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # Months and instants are defined in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def longitude(k: Column) -> Column:
    return F.lit(-70.0) + (k * 37 % 300).cast("double") / F.lit(10.0)


def latitude(k: Column) -> Column:
    return F.lit(-40.0) + (k * 53 % 300).cast("double") / F.lit(10.0)


def station_key(k: Column) -> Column:
    return F.upper(F.md5(k.cast("string")))


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Monitoring points from suppliers."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")

    def entry(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    country = pick(COUNTRIES, n % 5)
    parameter = F.array_compact(
        F.array(
            F.when(k % 6 == 1, entry("country", F.lit("XXX"))),
            F.when(k % 11 != 0, entry("country", country)),
            F.when(k % 17 != 0, entry("identifier", F.concat(F.lit("src:net:"), k.cast("string")))),
        )
    )
    party = F.when(k % 13 == 0, F.concat(F.lit("Servicio Hidro "), n.cast("string"))).when(
        n % 7 < 6, pick(ORGANISATIONS, n % 7)
    )
    coordinates = F.when(k % 4 == 0, F.array(longitude(k), latitude(k))).otherwise(
        F.array(longitude(k), latitude(k), F.col("s_acctbal"))
    )
    return table(spark, sf, "supplier").select(
        station_key(k).alias("id"),
        F.concat(F.lit("St "), F.col("s_name"), F.lit(" N"), n.cast("string")).alias("name"),
        F.struct(coordinates.alias("coordinates")).alias("shape"),
        parameter.alias("parameter"),
        F.transform(
            F.array_compact(F.array(party)), lambda x: F.struct(x.alias("organisationName"))
        ).alias("relatedParty"),
        F.concat(F.lit("p"), (n % 3).cast("string")).alias("provider"),
        k.alias("_k"),
    )


def series_items(spark: SparkSession, sf: str) -> DataFrame:
    """Time-series members, one per (supplier, return flag) of the line items."""
    k, flag = F.col("l_suppkey"), F.col("l_returnflag")
    spans = table(spark, sf, "lineitem").groupBy(k, flag).agg(
        F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"),
        F.max(F.ascii(flag)).alias("letter"),
    )
    # As an aggregate, so that predicates on derived columns see one row per series.
    f = k + F.col("letter")
    station = F.when(k % 19 == 0, F.upper(F.md5(F.concat(F.lit("gone"), k.cast("string"))))).otherwise(
        station_key(k)
    )
    property_code = F.upper(F.md5(F.concat(F.lit("var"), (f % 10).cast("string"))))
    duration = F.when(f % 6 != 4, pick(["P1D", "PT1H", "P1M", "PT15M", "", "bad"], f % 6))
    period = F.struct(
        F.date_format("first", ISO).alias("begin"), F.date_format("last", ISO).alias("end")
    )
    return spans.select(
        F.struct(station.alias("href")).alias("featureOfInterest"),
        F.struct(property_code.alias("href")).alias("observedProperty"),
        F.when(k % 23 != 0, period).alias("phenomenonTime"),
        F.struct(
            F.struct(
                duration.alias("aggregationDuration"), F.when(flag != "N", F.lit("mm")).alias("uom")
            ).alias("defaultPointMetadata"),
            F.struct(F.when(k % 2 == 0, F.lit("PT3H")).alias("intendedObservationSpacing")).alias("metadata"),
        ).alias("result"),
        F.concat(F.lit("p"), (k % 3).cast("string")).alias("provider"),
        k.alias("_k"),
    )


def legacy_items(spark: SparkSession, sf: str) -> DataFrame:
    """Legacy members, one per (supplier, line status), in the order of the status."""
    k, status = F.col("l_suppkey"), F.col("l_linestatus")
    f = k + F.ascii(status)
    named = F.struct(F.concat(F.lit("Otra "), (f % 8).cast("string")).alias("organisationName"))
    known = F.struct(pick(ORGANISATIONS, f % 8).alias("organisationName"))
    nameless = F.struct(F.lit(None).cast("string").alias("organisationName"))
    parties = (
        F.when(f % 5 == 0, F.array().cast("array<struct<organisationName:string>>"))
        .when(f % 5 == 1, F.array(nameless))
        .when(f % 8 < 6, F.array(known))
        .otherwise(F.array(named))
    )
    return table(spark, sf, "lineitem").select(k, status).distinct().select(
        F.struct(
            F.struct(
                F.struct(F.lit("x").alias("href")).alias("observedProperty"),
                F.struct(
                    F.struct(station_key(k).alias("href")).alias("sampledFeature"),
                    parties.alias("relatedParties"),
                ).alias("featureOfInterest"),
            ).alias("timeseries")
        ).alias("properties"),
        status.alias("input_order"),
    )


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Variable rows from nations: codes repeat, and the code of index 9 is left out."""
    n = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        F.upper(F.md5(F.concat(F.lit("var"), (n % 9).cast("string")))).alias("variableCode"),
        pick(NAMES, n % 12).alias("variableName"),
        F.when(n % 4 != 3, F.concat(F.lit("u"), n.cast("string"))).alias("unitName"),
        n.alias("input_order"),
    )


def part_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Variable rows from parts; 40 in 100 codes repeat, in the order of the parts."""
    p = F.col("p_partkey")
    return table(spark, sf, "part").select(
        F.concat(F.lit("V"), F.floor(p * 3 / 5).cast("string")).alias("variableCode"), F.col("p_name").alias("variableName"),
        F.col("p_brand").alias("unitName"), p.alias("input_order"),
    )


def basin_rings(spark: SparkSession, sf: str) -> DataFrame:
    """A polygon per nation: square, square with a hole, or L-shape, overlapping the next ones."""
    n = F.col("n_nationkey")
    x0, y0 = F.lit(-70.0) + n % 5 * 6, F.lit(-40.0) + F.floor(n / 5) * 6

    def ring(*corners: tuple[int, int]) -> Column:
        return F.array(
            *[F.array((x0 + dx).cast("double"), (y0 + dy).cast("double")) for dx, dy in (*corners, corners[0])]
        )

    square = ring((0, 0), (8, 0), (8, 8), (0, 8))
    hole = ring((2, 2), (2, 4), (4, 4), (4, 2))
    ell = ring((0, 0), (8, 0), (8, 5), (5, 5), (5, 8), (0, 8))
    rings = F.when(n % 3 == 0, F.array(square)).when(n % 3 == 1, F.array(square, hole)).otherwise(F.array(ell))
    return table(spark, sf, "nation").select(
        n.alias("basin_ord"), F.col("n_name").alias("name"), rings.alias("rings")
    )


def basins(spark: SparkSession, sf: str) -> DataFrame:
    return basins_from_rings(basin_rings(spark, sf))


def stations_b(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue B stations from suppliers."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    name = (
        F.when(k % 9 == 0, F.concat(F.lit("zPrueba "), F.col("s_name")))
        .when(k % 9 == 1, F.concat(F.col("s_name"), F.lit(" ZPRUEBA")))
        .otherwise(F.col("s_name"))
    )
    return table(spark, sf, "supplier").select(
        k.alias("id"),
        name.alias("nombre"),
        F.when(k % 2 == 1, F.concat(F.lit("AB"), k.cast("string"))).alias("abreviatura"),
        F.when(k % 3 != 0, F.concat(F.lit("Owner "), n.cast("string"))).alias("propietario"),
        F.when(k % 14 != 0, F.struct(F.array(longitude(k), latitude(k)).alias("coordinates"))).alias("geom"),
        F.col("s_acctbal").alias("altitud"),
        (k % 2 == 1).alias("automatica"),
        F.when(n % 5 < 3, "Argentina").otherwise("Brasil").alias("pais"),
        (n % 6).cast("long").alias("fuentes_id"),
        (k % 10 != 3).alias("has_obs"),
        (k % 10 != 4).alias("habilitar"),
        F.concat(F.lit("Rio "), (n % 4).cast("string")).alias("rio"),
        F.concat(F.lit("t"), (k % 3).cast("string")).alias("tabla"),
        F.concat(F.lit("x"), k.cast("string")).alias("id_externo"),
    )


def series_b(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue B series, one per (supplier, line number) of the line items."""
    k, ln = F.col("l_suppkey"), F.col("l_linenumber")
    spans = table(spark, sf, "lineitem").groupBy(k, ln).agg(
        F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"), F.count(F.lit(1)).alias("n")
    )
    variable = F.when((ln == 1) & (k % 10 == 0), F.lit(999)).otherwise(
        F.get(F.array(*[F.lit(v) for v in (1, 31, 34, 39, 40, 85, 101)]), ln - 1)
    )
    name = F.when(ln.isin(4, 6, 7), "Gage height").when(ln == 5, "Discharge").otherwise("Precipitation")

    def interval(**units: float) -> Column:
        return F.create_map(*[F.lit(x) for u, v in units.items() for x in (u, float(v))])

    support = (
        F.when(ln == 1, interval(days=1))
        .when(ln == 2, interval(hours=1))
        .when(ln == 3, interval(hour=3))
        .when(ln == 4, interval(days=1, minutes=30, foo=5))
        .when(ln == 5, interval(mon=1))
        .when(ln == 6, F.create_map().cast("map<string,double>"))
        .when(k % 2 == 0, interval(weeks=1, milliseconds=500))
    )
    return spans.select(
        (k * 10 + ln).alias("id"),
        F.struct(
            k.alias("id"),
            F.concat(F.lit("S"), k.cast("string")).alias("nombre"),
            (k.cast("double") / 10).alias("nivel_aguas_bajas"),
            (k + ln).cast("double").alias("nivel_alerta"),
            F.when(k % 5 != 0, (k + 2 * ln).cast("double")).alias("nivel_evacuacion"),
            F.struct(F.array(longitude(k), latitude(k)).alias("coordinates")).alias("geom"),
        ).alias("estacion"),
        F.struct(
            variable.cast("long").alias("id"), name.alias("VariableName"), support.alias("timeSupport")
        ).alias("var"),
        F.struct(ln.cast("long").alias("id"), F.concat(F.lit("u"), ln.cast("string")).alias("abrev")).alias("unidades"),
        F.struct((k % 3 + 1).alias("id")).alias("procedimiento"),
        F.concat(F.lit("t"), (k % 3).cast("string")).alias("tabla"),
        F.struct(
            F.date_format("first", ISO).alias("timestart"),
            F.date_format("last", ISO).alias("timeend"),
            F.col("n").alias("count"),
        ).alias("date_range"),
    )


def variables_b(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue B variables from parts."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("var"),
        F.col("p_name").alias("nombre"),
        F.col("p_brand").alias("abrev"),
        F.col("p_type").alias("type"),
        F.col("p_name").alias("VariableName"),
        F.col("p_size").cast("long").alias("def_unit_id"),
    )


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Observations from line items: series (supplier, line number), value the quantity."""
    return table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("series_id"),
        F.col("l_shipdate").alias("timestart"),
        (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("timeend"),
        F.col("l_quantity").alias("valor"),
    )


def fine_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Observations with microseconds from events."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("series_id"),
        F.col("ts").alias("timestart"),
        (F.col("ts") + F.expr("INTERVAL 30 SECONDS")).alias("timeend"),
        F.col("value").alias("valor"),
    )


# ---- landed files -----------------------------------------------------------

PAGE_ROWS = 500


def land_json_pages(
    items: DataFrame, page: Column, field: str, label: str = "pages", path: str | None = None
) -> str:
    """Add items as pages of ``field``, one page per line, to a landing folder."""
    path = path or scratch_dir(items.sparkSession, label)
    columns = [c for c in items.columns if not c.startswith("_")]
    (
        items.groupBy(page.alias("_page"))
        .agg(F.collect_list(F.struct(*columns)).alias(field))
        .select(F.to_json(F.struct(field)).alias("value"))
        .write.mode("append").text(path)
    )
    return path


def land_observations(rows: DataFrame, label: str = "observations") -> str:
    """Observations as landed JSON lines with their instants as text."""
    path = scratch_dir(rows.sparkSession, label)
    instants = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") for c in ("timestart", "timeend")}
    rows.withColumns(instants).write.json(path)
    return path


def land_documents(rows: DataFrame, page: Column, order: Column, item: Column, head: Column | str,
                   tail: Column | str, label: str, apart: bool = False) -> str:
    """Write one document per page (head, the items in order, tail), pages in order of number; ``apart``: a file for each."""
    path = scratch_dir(rows.sparkSession, label)

    def text(x) -> Column:
        return F.lit(x) if isinstance(x, str) else x

    documents = (
        rows.select(page.alias("page"), order.alias("_o"), item.alias("_i"))
        .groupBy("page")
        .agg(F.sort_array(F.collect_list(F.struct("_o", "_i"))).alias("_items"))
        .select(
            "page",
            F.concat(text(head), F.array_join(F.col("_items._i"), "\n"), text(tail)).alias("value"),
        )
    )
    if apart:
        write_named(documents.select(F.concat(F.lit("page-"), "page", F.lit(".xml")).alias("name"), "value"), path)
    else:
        documents.orderBy("page").select("value").write.mode("overwrite").text(path)
    return path


def page_number(k: Column, size: int = PAGE_ROWS) -> Column:
    return F.lpad(F.floor(k / size).cast("string"), 9, "0")


def land_dictionary(spark: SparkSession, sf: str) -> str:
    """Variables response documents from parts; 40 in 100 codes repeat."""
    p = F.col("p_partkey")
    item = F.concat(
        F.lit('<wml:variable><wml:variableCode vocabulary="x" default="true">V'),
        F.floor(p * 3 / 5).cast("string"),
        F.lit("</wml:variableCode><wml:variableName>"), F.col("p_name"),
        F.lit("</wml:variableName><wml:unit><wml:unitName>"), F.col("p_brand"),
        F.lit("</wml:unitName></wml:unit></wml:variable>"),
    )
    escaped = F.replace(F.replace(item, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    head = (
        '<?xml version="1.0"?><soap:Envelope xmlns:soap="http://schemas.xmlsoap.org/soap/envelope/">'
        "<soap:Body><GetVariablesResponse><GetVariablesResult>"
        '&lt;wml:variablesResponse xmlns:wml="http://www.cuahsi.org/waterML/1.1/"&gt;&lt;wml:variables&gt;'
    )
    tail = (
        "&lt;/wml:variables&gt;&lt;/wml:variablesResponse&gt;"
        "</GetVariablesResult></GetVariablesResponse></soap:Body></soap:Envelope>"
    )
    return land_documents(table(spark, sf, "part"), page_number(p), p, escaped, head, tail, "variables")


def land_semantic(spark: SparkSession, sf: str) -> str:
    """Semantic HTML pages from parts, with a header row and a row of another length per page.

    Every tenth description holds a table of its own, every eleventh row a comment with a row in it, and every
    thirteenth row (if its last cell has a text) leaves its cells and itself open.
    """
    p = F.col("p_partkey")
    text = p.cast("string")

    left_open = (p % 13 == 0) & (p % 6 != 0)
    end = F.when(left_open, F.lit("")).otherwise(F.lit("</td>"))
    nested = F.when(p % 10 == 0, F.lit("<table><tr><td>in<td>ner</table>")).otherwise(F.lit(""))
    comment = F.when(p % 11 == 0, F.lit("<!-- <tr><td>no</td> </table> -->")).otherwise(F.lit(""))

    def cell(value: Column | str) -> Column:
        return F.concat(F.lit("<td>"), F.lit(value) if isinstance(value, str) else value, end)

    def link(nothing: Column, target: Column) -> Column:
        href = F.when(nothing, F.lit("null")).otherwise(target)
        return cell(F.concat(F.lit('<a class="l" href="'), href, F.lit('">link</a>')))

    def maybe(nothing: Column, value: Column) -> Column:
        return cell(F.when(nothing, F.lit("null")).otherwise(value))

    item = F.concat(
        F.lit("<tr>"),
        cell(F.upper(F.sha1(text))), cell(F.concat(F.lit("id"), text)), cell(F.col("p_name")),
        link(p % 3 == 0, F.concat(F.lit("http://c/"), text, F.lit("?a=1&amp;b=2"))),
        cell(F.concat(F.col("p_name"), F.lit(" &lt;&eacute;&gt;\r\n"), F.col("p_type"), nested)), comment,
        cell(F.col("p_brand")), link(p % 5 == 0, F.concat(F.lit("http://u/"), F.col("p_brand"))),
        maybe(p % 4 == 0, F.col("p_type")), maybe(p % 7 == 0, F.col("p_size").cast("string")),
        maybe(p % 2 == 0, F.lit("1")), maybe(p % 9 == 0, F.lit("h")), maybe(p % 8 == 0, F.lit("true")),
        cell("null"), cell(F.when(p % 6 == 0, F.lit("")).otherwise(F.lit("ARG"))),
        F.when(left_open, F.lit("")).otherwise(F.lit("</tr>")),
    )
    head = "<html><body><table><tr><th>code</th><th>id</th></tr><tr><td>short</td><td>x</td></tr>"
    return land_documents(
        table(spark, sf, "part"), page_number(p), p, item, head, "</table></body></html>", "semantic"
    )


WMDR = ' xmlns:wmdr="http://def.wmo.int/wmdr/2017"'
OAI = '<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/" xmlns:p="http://www.openarchives.org/OAI/2.0/">'


def land_records(
    spark: SparkSession, sf: str, missing: int | None = None, nameless: bool = False, outer: bool = False,
    apart: bool = False, lost: Column | None = None,
) -> str:
    """Record pages from customers, without the ``missing`` one.  ``apart``: pages as files of their own,
    without those for which ``lost`` (on ``page``) holds.

    Every ninth record has no metadata, every seventh a record element of another kind inside it, every fourth two
    sets, and every fifth stands under a namespace prefix.  ``nameless`` takes the identifier from every eleventh that
    has metadata; ``outer`` leaves the declaration of the metadata's prefix to the page's root.
    """
    customers = table(spark, sf, "customer")
    k = F.col("c_custkey")
    size = customers.select(F.count(F.lit(1))).scalar()
    prefix = F.when(k % 5 == 0, F.lit("p:")).otherwise(F.lit(""))

    def element(name: str, content: Column) -> Column:
        return F.concat(F.lit("<"), prefix, F.lit(f"{name}>"), content, F.lit("</"), prefix, F.lit(f"{name}>"))

    day = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 365).cast("int")), "yyyy-MM-dd")
    second = F.when(k % 4 == 0, element("setSpec", F.lit("fourth"))).otherwise(F.lit(""))
    identifier = element("identifier", F.concat(F.lit("id-"), k.cast("string")))
    if nameless:
        identifier = F.when((k % 11 == 0) & (k % 9 != 0), F.lit("")).otherwise(identifier)
    header = element("header", F.concat(
        identifier, element("datestamp", day),
        element("setSpec", F.lower("c_mktsegment")), second,
    ))
    inner = F.when(k % 7 == 0, F.lit('<record xmlns="urn:x"><name/></record>')).otherwise(F.lit(""))
    metadata = element("metadata", F.concat(
        F.lit('<wmdr:Record id="r' if outer else f'<wmdr:Record{WMDR} id="r'), k.cast("string"),
        F.lit('"><wmdr:name>'), F.col("c_name"), F.lit(" &amp; &lt;sons&gt;</wmdr:name>"), inner, F.lit("</wmdr:Record>"),
    ))
    item = element("record", F.concat(header, F.when(k % 9 != 0, metadata).otherwise(F.lit(""))))
    # The cursor counts the records up to and including the page.
    last = F.least((F.col("page").cast("long") + 1) * PAGE_ROWS, size)
    tail = F.concat(
        F.lit("<resumptionToken completeListSize=\""), size.cast("string"),
        F.lit('" cursor="'), last.cast("string"), F.lit('">t'), F.col("page"),
        F.lit("</resumptionToken></ListRecords></OAI-PMH>"),
    )
    landed = customers if missing is None else customers.where(F.floor(k / PAGE_ROWS) != missing)
    if lost is not None:
        landed = landed.withColumn("page", F.floor(k / PAGE_ROWS)).where(~lost)
    return land_documents(
        landed, page_number(k), k, item, f"{OAI.replace('>', WMDR + '>') if outer else OAI}<ListRecords>\n", tail, "records", apart
    )


def land_formats(spark: SparkSession, sf: str) -> str:
    p = F.col("p_partkey")
    item = F.concat(
        F.lit("<metadataFormat><metadataPrefix>f"), p.cast("string"),
        F.lit("</metadataPrefix><schema>s</schema></metadataFormat>"),
    )
    return land_documents(
        table(spark, sf, "part"), page_number(p), p, item,
        f"{OAI}<ListMetadataFormats>", "</ListMetadataFormats></OAI-PMH>", "formats",
    )
