import json

import pytest

from caudal import sources
from caudal.operators import quality, semantic, series, stations
from caudal.operators.filters import points_where, records_where


def put(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text, encoding="utf-8")
    return str(path)


POINTS = [
    {"id": "A", "name": "Paso de los Libres", "shape": {"coordinates": [-57, -29.7]},
     "parameter": [{"name": "country", "value": "ARG"}, {"name": "country", "value": "URY"},
                   {"name": "identifier", "value": "x:y:8"}],
     "relatedParty": [{"organisationName": "INMET"}]},
    {"id": "B", "name": "B", "shape": {"coordinates": [-58.5, -30, 12.5]}, "parameter": [], "relatedParty": []},
    {"id": "C", "name": "C", "shape": {"coordinates": [-58.5, -30, 12.5]},
     "parameter": [{"name": "identifier", "value": "9"}], "relatedParty": [{"organisationName": "Prefectura Naval"}]},
]


def test_point_pages(spark, tmp_path):
    put(tmp_path, "p1.json", json.dumps({"results": POINTS[:2]}, indent=2))
    put(tmp_path, "p2.json", json.dumps({"results": POINTS[2:]}, indent=2))
    path = put(tmp_path, "p3.json", json.dumps({"message": "no more"}))
    rows = {r.STATION_ID: r for r in stations.stations_a(sources.read_point_pages(spark, path)).collect()}
    assert set(rows) == {"A", "B", "C"}
    a, b, c = rows["A"], rows["B"], rows["C"]
    assert (a.LONGITUDE, a.LATITUDE, a.ALTITUDE) == (-57.0, -29.7, None)
    assert (a.COUNTRY, a.ORGANIZATION, a.ORIGINAL_STATION_ID, a.PARENT_ID) == ("URY", "INMET", "8", "UR_INMET_8")
    assert (a.STATION_SHORTNAME, a.TOOLTIP, a.TYPE, a.SUBBASIN) == ("PasodelosLib", a.STATION_NAME, None, None)
    assert (b.ALTITUDE, b.ORGANIZATION, b.ORIGINAL_STATION_ID, b.PARENT_ID) == (12.5, "WHOS", None, "_WHOS_None")
    assert (c.ORGANIZATION, c.PARENT_ID) == ("PREFE", "_PREFE_9")


def test_provider_folders(spark, tmp_path):
    put(tmp_path / "provider=p1", "a.json", json.dumps({"results": POINTS[:1]}))
    put(tmp_path / "provider=p2", "a.json", json.dumps({"results": POINTS[1:]}))
    points = sources.read_point_pages(spark, str(tmp_path))
    kept = points_where(points, provider="p2")
    assert sorted(r.id for r in kept.collect()) == ["B", "C"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(provider" in plan
    assert points_where(points, country="URY").count() == 1
    ordered = sources.read_point_pages(spark, str(tmp_path), with_order=True)
    assert set(ordered.columns) == set(points.columns) | {"input_order"}


def test_broken_page_fails(spark, tmp_path):
    put(tmp_path, "p1.json", json.dumps({"results": POINTS}))
    path = put(tmp_path, "p2.json", '{"results": [{"id": ')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        sources.read_point_pages(spark, path).collect()


def test_series_pages(spark, tmp_path):
    def member(**result):
        return {"featureOfInterest": {"href": "A"}, "observedProperty": {"href": "V"}, "result": result}

    members = [
        member(defaultPointMetadata={"aggregationDuration": "P1D", "uom": "mm"}),
        member(defaultPointMetadata={}, metadata={"intendedObservationSpacing": "PT15M"}),
        member(defaultPointMetadata={}),
    ]
    put(tmp_path, "p1.json", json.dumps({"member": members}))
    path = put(tmp_path, "p2.json", "{}")
    rows = series.series_a(sources.read_series_pages(spark, path)).collect()
    assert sorted((r.TIMESTEP_HOUR or -1, r.UNIT) for r in rows) == [(-1, None), (0.25, None), (24.0, "mm")]
    assert {r.IMPORT for r in rows} == {True} and {r.IMPORT_SOURCE for r in rows} == {"WHOS"}


def test_page_order_is_kept(spark, tmp_path):
    def feature(name):
        return {"properties": {"timeseries": {"featureOfInterest": {
            "sampledFeature": {"href": "A"}, "relatedParties": [{"organisationName": name}]}}}}

    put(tmp_path, "p1.json", json.dumps({"features": [feature("One"), feature("Two")]}))
    path = put(tmp_path, "p2.json", json.dumps({"features": [feature("Three"), feature("One")]}))
    pairs = stations.station_organisations(sources.read_legacy_pages(spark, path, with_order=True))
    assert pairs.count() == 3
    assert [r.organisationName for r in stations.first_organisation(pairs).collect()] == ["One"]


VARIABLE = (
    '<wml:variable><wml:variableCode vocabulary="x">{code}</wml:variableCode><wml:variableName>{name}</wml:variableName>'
    "<wml:unit><wml:unitName>{unit}</wml:unitName></wml:unit></wml:variable>"
)


@pytest.mark.parametrize("escaped", [True, False])
def test_variable_dictionary(spark, tmp_path, escaped):
    inner = '<wml:variablesResponse xmlns:wml="http://x"><wml:variables>'
    for code, name, unit in [("C1", "Level", "m"), ("C2", "N &amp; 2", "mm"), ("C1", "Chuva", "mm")]:
        inner += VARIABLE.format(code=code, name=name, unit=unit) + "\n"
    inner += "<wml:variable><wml:variableCode>C3</wml:variableCode><wml:variableName>N3</wml:variableName></wml:variable>"
    inner += VARIABLE.format(code="http://hydro.geodab.eu/hydro-ontology/concept/3", name="Other", unit="u")
    inner += "</wml:variables></wml:variablesResponse>"
    if escaped:
        inner = inner.replace("<", "&lt;").replace(">", "&gt;")
    text = f'<?xml version="1.0"?><soap:Envelope xmlns:soap="s"><soap:Body>{inner}</soap:Body></soap:Envelope>'
    path = put(tmp_path, "v.xml", text)
    rows = sources.read_variable_dictionary(spark, path, escaped=escaped)
    assert rows.count() == 3 + 5
    last = {r.variableCode: (r.variableName, r.unitName) for r in series.latest_variables(rows).collect()}
    assert last["C1"] == ("Chuva", "mm") and last["C2"] == ("N & 2", "mm") and last["C3"] == ("N3", None)
    assert last["http://hydro.geodab.eu/hydro-ontology/concept/3"] == ("Other", "u")
    assert last["https://hydro.geodab.eu/hydro-ontology/concept/65"] == ("Precipitation", None)


def test_semantic_table(spark, tmp_path):
    code = "B838A449A5FBC64CBB8A204A5CD614519EB0844A"
    def cells(first):
        values = [first, "id", "Ni\nvel", '<a href="null">x</a>', "d", "m", "<a href='http://u'>u</a>", "null", "1", "null",
                  "h", "true", "null", "ARG"]
        return [f"<td>{v}</td>" for v in values]

    html = (
        "<html><body><table><tr><th>variableCode</th></tr>\n"
        f"<tr>{''.join(cells(code))}</tr>\n<TR class='x'>{''.join(cells(code.lower()))}</TR>\n"
        f"<tr>{''.join(cells('short'))}</tr><tr><td></td></tr>"
        f"<tr>{''.join(cells(code[:-1] + '&amp;'))}\n"
        "</table></body></html>"
    )
    path = put(tmp_path, "s.html", html)
    rows = semantic.semantic_mapping(sources.read_semantic_rows(spark, path)).collect()
    assert sorted(r.variableCode for r in rows) == sorted([code, code.lower(), code[:-1] + "&"])
    r = rows[0]
    assert (r.variableName, r.variableURI, r.unitsURI) == ("Nivel", None, "http://u")
    assert (r.interpolationType, r.timeSupport, r.country, r.countryISO3) == (None, "1", "null", "ARG")


PAGE = '<?xml version="1.0"?>\n<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>{records}{token}</ListRecords></OAI-PMH>'


def record(i, metadata=True, status=""):
    body = f'<metadata>\n<w:R xmlns:w="u" id="{i}"><w:n a="1 &amp; 2">t &lt; u</w:n></w:R>\n</metadata>' if metadata else ""
    return (f"<record><header{status}><identifier>id{i}</identifier><datestamp>2020-01-0{i}</datestamp>"
            f"<setSpec>s{i % 2}</setSpec></header>{body}</record>")


def test_record_pages(spark, tmp_path):
    put(tmp_path, "records_2.xml", PAGE.format(
        records=record(1) + "\n" + record(2, False, ' status="deleted"'),
        token='<resumptionToken completeListSize="3" cursor="2">tok</resumptionToken>'))
    path = put(tmp_path, "records_4.xml", PAGE.format(
        records=record(3) + record(1), token='<resumptionToken completeListSize="3" cursor="3"/>'))
    records = sources.read_records(spark, path)
    rows = sorted(records.collect(), key=lambda r: (r.identifier, r.page))
    assert [r.identifier for r in rows] == ["id1", "id1", "id2", "id3"]
    assert rows[0].metadata == '<w:R xmlns:w="u" id="1"><w:n a="1 &amp; 2">t &lt; u</w:n></w:R>'
    assert rows[2].metadata is None and rows[2].setSpec == "s0"
    assert [r.identifier for r in records_where(records, set_spec="s0").collect()] == ["id2"]
    headers = sources.read_identifiers(spark, path).collect()
    assert sorted(h.identifier for h in headers) == ["id1", "id1", "id2", "id3"]
    assert headers[0].datestamp.startswith("2020-01-0")
    tokens = {(t.token, t.completeListSize, t.cursor) for t in sources.read_page_tokens(spark, path).collect()}
    assert tokens == {("tok", 3, 2), (None, 3, 3)}
    done = quality.completeness(records, sources.read_page_tokens(spark, path)).collect()
    assert [(d.records, d.expected, d.last_cursor, d.complete) for d in done] == [(3, 3, 3, True)]


def test_records_with_metadata_are_told_without_their_declarations(spark, tmp_path):
    """A filter on the metadata looks at the text served; the declarations it gets from the page are worked out once, for what stays."""
    page = PAGE.format(records=record(1) + record(2, False), token="")
    found = sources.read_records(spark, put(tmp_path, "p.xml", page.replace("<OAI-PMH", '<OAI-PMH xmlns:z="urn:z"', 1)))
    some = found.where("metadata IS NOT NULL").select("identifier")
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    # Left: the declarations of the protocol at the page's head, and those of the page's sets; none by record.
    assert "xmlns:" not in plan and [r.identifier for r in some.collect()] == ["id1"]
    assert found.where("metadata IS NULL").select("identifier").collect()[0].identifier == "id2"


def test_records_under_a_prefix(spark, tmp_path):
    page = (
        '<o:OAI-PMH xmlns:o="http://www.openarchives.org/OAI/2.0/"><o:ListRecords>'
        '<o:record>\n<!-- a --><o:header status="x"><o:identifier>a&amp;b</o:identifier><o:datestamp>2020</o:datestamp>'
        '<o:setSpec>s1</o:setSpec><o:setSpec>s2</o:setSpec></o:header>'
        '<o:metadata><R><record><name>no</name></record><metadata>m</metadata></R></o:metadata></o:record>'
        '<o:record><o:header><o:identifier>c</o:identifier></o:header></o:record>'
        '<o:resumptionToken cursor="1" completeListSize="2"/></o:ListRecords></o:OAI-PMH>'
    )
    path = put(tmp_path, "p.xml", page)
    one, two = sorted(sources.read_records(spark, path).collect(), key=lambda r: r.identifier)
    assert (one.identifier, one.setSpec, one.setSpecs) == ("a&b", "s1", ["s1", "s2"])
    assert one.metadata == "<R><record><name>no</name></record><metadata>m</metadata></R>"
    assert (two.identifier, two.datestamp, two.setSpec, two.setSpecs, two.metadata) == ("c", None, None, [], None)
    assert [r.identifier for r in records_where(sources.read_records(spark, path), set_spec="s2").collect()] == ["a&b"]
    assert sorted(r.identifier for r in sources.read_identifiers(spark, path).collect()) == ["a&b", "c"]
    assert [(t.token, t.completeListSize, t.cursor) for t in sources.read_page_tokens(spark, path).collect()] == [(None, 2, 1)]


def test_basin_with_unreadable_coordinates_fails(spark, tmp_path):
    feature = '{"features": [{"properties": {"nombre_3": "x"}, "geometry": {"type": "Polygon", "coordinates": [[["a", 1.0]]]}}]}'
    path = put(tmp_path, "b.geojson", feature)
    with pytest.raises(Exception, match="MALFORMED"):
        sources.read_basins(spark, path).collect()


def test_incomplete_harvest(spark, tmp_path):
    token = '<resumptionToken completeListSize="9" cursor="1">t</resumptionToken>'
    put(tmp_path / "one", "p.xml", PAGE.format(records=record(1), token=token))
    put(tmp_path / "two", "p.xml", PAGE.format(records=record(2), token=""))
    path = str(tmp_path / "*")
    done = quality.completeness(sources.read_records(spark, path), sources.read_page_tokens(spark, path)).collect()
    assert {d.harvest.rsplit("/", 1)[1]: d.complete for d in done} == {"one": False, "two": True}


def test_metadata_formats(spark, tmp_path):
    path = put(tmp_path, "f.xml", '<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListMetadataFormats>'
               "<metadataFormat><metadataPrefix>A</metadataPrefix><schema>s</schema></metadataFormat>"
               "<metadataFormat><metadataPrefix>B</metadataPrefix></metadataFormat></ListMetadataFormats></OAI-PMH>")
    assert sorted(r.metadataPrefix for r in sources.read_metadata_formats(spark, path).collect()) == ["A", "B"]


def test_basins(spark, tmp_path):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    far = [[5, 5], [6, 5], [6, 6], [5, 6], [5, 5]]
    features = [
        {"properties": {"nombre_3": "a"}, "geometry": {"type": "Polygon", "coordinates": [square]}},
        {"properties": {"nombre_3": "b"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [far]]}},
    ]
    path = put(tmp_path, "b.geojson", json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    rows = {r.name: r for r in sources.read_basins(spark, path).collect()}
    assert len(rows["a"].edges) == 4 and len(rows["b"].edges) == 8
    assert rows["b"].bounds.asDict() == {"xmin": 0.0, "xmax": 6.0, "ymin": 0.0, "ymax": 6.0}
    assert (rows["a"].basin_ord.place, rows["b"].basin_ord.place) == (0, 1)
    path = put(tmp_path / "two", "a.geojson", json.dumps({"type": "FeatureCollection", "features": features[:1]}))
    put(tmp_path / "two", "b.geojson", json.dumps({"type": "FeatureCollection", "features": features[1:]}))
    assert [r.name for r in sources.read_basins(spark, path).orderBy("basin_ord").collect()] == ["a", "b"]


def test_catalogue_b_sources(spark, tmp_path):
    put(tmp_path / "st", "s.json", json.dumps([{"id": 1, "nombre": "x", "geom": {"coordinates": [-58, -30.5]}, "automatica": True}]))
    flat = stations.flatten_station_geometry(sources.read_stations_b(spark, str(tmp_path / "st"))).collect()[0]
    assert (flat.longitude, flat.latitude) == (-58.0, -30.5)
    put(tmp_path / "va", "v.json", json.dumps([{"id": 39, "nombre": "Altura"}]))
    assert sources.read_variables_b(spark, str(tmp_path / "va")).collect()[0].nombre == "Altura"
    put(tmp_path / "mo", "m.json", json.dumps({"values": []}))
    assert sources.read_monthly_stats(spark, str(tmp_path / "mo")).count() == 0
    put(tmp_path / "ob", "o.json", json.dumps([
        {"series_id": 1, "timestart": "2020-01-01T00:00:30.000Z", "timeend": "2020-01-01T00:01:30.000Z", "valor": "1.5"}]))
    o = sources.read_observations(spark, str(tmp_path / "ob"), "json", multi_line=True).collect()[0]
    assert (o.timestart.minute, o.timeend.minute, o.valor) == (0, 2, 1.5)


def test_nested_tables_open_cells_and_comments(spark, tmp_path):
    page = (
        "</table><body><table class='a>b'><tr><th>h</th></tr>"
        "<tr><td title='x>y'>one <b>b</b><td>two<table><tr><td>in</td></tr><tr><td>ner</table> rest</td>between"
        "<TD>three<!-- <tr><td>no</table> --> on</TD></tr>stray"
        "<tr><td>open<tr><td></td></tr></tr></table>out<td>side</td>"
        "<table><tbody><tr><td>second</td></tbody></table><!-- <table><tr><td>never"
    )
    path = put(tmp_path, "s.html", page)
    rows = sorted(r.cells for r in sources.read_semantic_rows(spark, path).collect())
    assert rows == sorted([
        ["h"], ["one <b>b</b>", "two<table><tr><td>in</td></tr><tr><td>ner</table> rest", "three on"],
        ["open"], [""], ["second"],
    ])


def test_a_large_semantic_page_is_split_and_held_in_pieces(spark, tmp_path, monkeypatch):
    """A page larger than a split is read by several tasks; rows, cells, nested tables and comments go over their borders."""
    from caudal.sources import semantic as reader

    row = (
        "<tr><td title='a<b>c'>{i} <b>b</b><td>two<table><tr><td>in</td></tr></table> rest</td>"
        "<t<!-- <tr><td>no</table> -->d>three<!-- <!-- --> on\r\n</TD></tr>"
    )
    folder = tmp_path / "pages"
    for name in ("a", "b"):
        put(folder, f"{name}.html", "<body><table>" + "".join(row.format(i=f"{name}{i}") for i in range(40)) + "</table></body>")
    (folder / "c.html").write_bytes(b"\xef\xbb\xbf<table><tr><td>caf\xe9<td>\x01<")
    put(folder, "d.html", "<TABLE<tr><td>cut<!-- -->")
    put(folder, "e.html", "")
    monkeypatch.setattr(reader, "PIECE_BYTES", 50, raising=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = sources.read_semantic_rows(spark, str(folder))
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.execute().getNumPartitions() > 10
        rows = sorted(r.cells for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert rows == sorted([
        *([f"{name}{i} <b>b</b>", "two<table><tr><td>in</td></tr></table> rest", "three on\r\n"] for name in ("a", "b") for i in range(40)),
        ["caf\ufffd", " <"], ["cut"],
    ])


def test_metadata_carries_the_namespaces_around_it(spark, tmp_path):
    """A page whose root declares every prefix: each record's metadata parses alone, under the same names."""
    import xml.etree.ElementTree as ET

    oai = "http://www.openarchives.org/OAI/2.0/"
    header = "<o:header><o:identifier>{}</o:identifier></o:header>"
    bodies = {
        "a": "<w:R w:id='1'><w:n>t: u <x:y/></w:n></w:R>",
        "b": '<R z.1:q="2"><w:n xmlns:w="own">v</w:n></R>',
        "c": '<w:R xmlns:w="own"><x:record><x:header/></x:record></w:R>',
        "d": '<v:R xmlns="urn:in"><n/></v:R>',
        "e": "<!-- c --><w:R/>",
    }
    record = '<o:record xmlns:v="urn:v">{}<o:metadata xmlns:x="urn:x2">{}</o:metadata></o:record>'
    page = (
        f'<?xml version="1.0"?><o:OAI-PMH xmlns:o="{oai}" xmlns:w="urn:w&amp;1" xmlns="urn:default" xmlns:x="urn:x1" xmlns:z.1="urn:z"><o:ListRecords>'
        + "".join(record.format(header.format(i), body) for i, body in bodies.items())
        + "</o:ListRecords></o:OAI-PMH>"
    )
    served = {x.find(f".//{{{oai}}}identifier").text: x.find(f"{{{oai}}}metadata")[0] for x in ET.fromstring(page).iter(f"{{{oai}}}record")}
    found = {r.identifier: r.metadata for r in sources.read_records(spark, put(tmp_path, "p.xml", page)).collect()}
    assert set(found) == set(bodies)
    names = lambda x: [(e.tag, sorted(e.attrib.items())) for e in x.iter()]
    for i, text in found.items():
        assert names(ET.fromstring(text)) == names(served[i]), text
    assert found["d"] == '<v:R xmlns="urn:in" xmlns:v="urn:v"><n/></v:R>'
    # The namespace decides, not the local name: in the metadata a record under another one opens no record.
    assert found["c"] == '<w:R xmlns:w="own" xmlns:x="urn:x2"><x:record><x:header/></x:record></w:R>'


def test_metadata_that_declares_its_namespaces_stays_as_served(spark, tmp_path):
    body = '<w:R xmlns:w="u" a="&gt;"><record xmlns="urn:x"><name/></record></w:R>'
    page = f'<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords><record><header><identifier>i</identifier></header><metadata>{body}</metadata></record></ListRecords></OAI-PMH>'
    assert [r.metadata for r in sources.read_records(spark, put(tmp_path, "p.xml", page)).collect()] == [body]


def test_missing_stretches_of_a_harvest(spark, tmp_path):
    def land(folder, name, ids, cursor=None, size=9, token="t"):
        told = "" if cursor is None else f'<resumptionToken completeListSize="{size}" cursor="{cursor}">{token}{cursor}</resumptionToken>'
        put(tmp_path / folder, name, PAGE.format(records="".join(record(i) for i in ids), token=told))

    land("whole", "1.xml", [1, 2, 3], 3)
    land("whole", "2.xml", [4, 5, 6], 6)
    land("whole", "3.xml", [7, 8, 9])                                     # the last page tells no cursor
    land("first", "2.xml", [3, 4], 4, 4)                                  # [0, 2) is missing
    land("inner", "1.xml", [1, 2], 2)
    land("inner", "1-again.xml", [1, 2], 2)                               # landed twice
    land("inner", "3.xml", [4, 5, 6], 6)                                  # [2, 3) and [6, 9) are missing
    land("unknown", "1.xml", [1])                                         # no size announced: nothing to miss
    path = str(tmp_path / "*")
    gaps = quality.missing_intervals(sources.read_records(spark, path), sources.read_page_tokens(spark, path)).collect()
    found = sorted((g.harvest.rsplit("/", 1)[1], g.missing_from, g.missing_to, g.token) for g in gaps)
    assert found == [("first", 0, 2, None), ("inner", 2, 3, "t2"), ("inner", 6, 9, "t6")]
