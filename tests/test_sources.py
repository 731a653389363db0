"""File sources, landing helpers and name similarity on small files."""

import datetime
import gzip
import json
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.functions.values import safe_decimal
from ledgerlake.operators.reports import name_similarity
from ledgerlake.functions.redaction import ALWAYS, PARTIES, redact_json, redact_notice, redact_source
from ledgerlake.sources import files, landing


def test_xml_and_json_records(spark, tmp_path):
    (tmp_path / "p.xml").write_text("<r><zakazka kod='1'><nazev>a</nazev><cast>x</cast><cast>y</cast></zakazka><zakazka kod='2'><nazev>b</nazev></zakazka></r>")
    rows = files.xml_records(spark, str(tmp_path / "p.xml"), "zakazka").orderBy("_kod").collect()
    assert [(r["_kod"], r["nazev"], r["cast"]) for r in rows] == [(1, "a", ["x", "y"]), (2, "b", None)]
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "1.json").write_text(json.dumps([{"id": "F1", "v": 1}, {"id": "F2", "v": [2]}]))
    (pages / "2.json").write_text(json.dumps([{"id": "F3"}], indent=1))
    found, count = files.notice_pages(spark, str(pages))
    assert sorted(r.id for r in found.collect()) == ["F1", "F2", "F3"] and count.first().landed == 3


def test_grants_window_and_semi_joins(spark, tmp_path):
    def put(name, text):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(text)
        return str(tmp_path / name)

    g = put("g.csv.gz", "iriDotace,iriPrijemce,podpisDatum,datumExportu\nd1,p1,2026-08-05,2026-09-01\nd2,p2,2030-06-17,2026-09-01\nd3,p3,2026-07-31,2026-09-01\n")
    p = put("p.csv.gz", "iriPrijemce,ico\np1,00255513\np2,1\np3,2\n")
    d = put("d.csv.gz", "iriRozhodnuti,iriDotace,castkaRozhodnuta\nr1,d1,100\nr2,d3,5\n")
    a, b, c = files.grants(spark, g, p, d, "2026-08-01", "2031-01-01")
    assert ([r.iriDotace for r in a.collect()], [r.ico for r in b.collect()], [r.iriRozhodnuti for r in c.collect()]) == (["d1"], ["00255513"], ["r1"])


def test_operations_skip_to_header_and_echo(spark):
    cells = [["note", ""], ["Číslo", "Částka"], ["Number", "Amount"], ["CZ.1", "10"], ["", ""], ["CZ.1", "20"]]
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cells)], "line_no int, cells array<string>")
    assert sorted(r.id for r in files.operations(df, "Číslo").collect()) == ["CZ.1#3", "CZ.1#5"]


def test_file_kinds(spark, tmp_path):
    for name, data in {"a": b"x;y;z\n1;2,5;3\n", "b": b' {"a": 1}', "c": b"<r/>", "d": gzip.compress(b"x"), "e": b"PK\x03\x04zip", "f": b"x,y\n"}.items():
        (tmp_path / name).write_bytes(data)
    got = {r.path[-1]: (r.kind, r.delimiter) for r in files.file_kinds(spark, str(tmp_path)).collect()}
    assert got == {"a": ("csv", ";"), "b": ("json", None), "c": ("xml", None), "d": ("gzip", None), "e": ("zip", None), "f": ("csv", ",")}


def test_methodologies_and_newest_file(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"kod": "a", "verze": "1",\n "parametry": {"x": 5}}')
    r = files.methodologies(spark, str(tmp_path)).first()
    assert (r.code, r.version, json.loads(r.parameters)) == ("a", "1", {"x": 5})
    links = spark.createDataFrame([("p", "u1", "list 1. 2. 2026"), ("p", "u2", "list 3.10.2026"), ("p", "u3", "no date")], "page string, link string, label string")
    x = files.newest_file(links, "page", "label").first()
    assert (x.link, x.day) == ("u2", datetime.date(2026, 10, 3))


def test_amounts_and_decimals(spark):
    df = spark.createDataFrame([('{"_value":"12.5","_currencyID":"EUR"}',), ("7",), ('"x"',)], "j string").select(files.amount_of(F.parse_json("j")).alias("x"))
    assert [(r.x.value, r.x.currency) if r.x else None for r in df.collect()] == [(Decimal("12.50"), "EUR"), (Decimal("7.00"), None), None]
    got = [r.x for r in spark.createDataFrame([("0.125",), ("0.135",), ("x",)], "t string").select(safe_decimal(F.col("t")).alias("x")).collect()]
    assert got == [Decimal("0.12"), Decimal("0.14"), None]


def test_hash_links_and_redaction(spark):
    df = spark.createDataFrame([('{"b":1,"a":[2]}', '{ "a": [2], "b": 1 }')], "x string, y string")
    assert df.select((landing.content_hash(F.col("x")) == landing.content_hash(F.col("y"))).alias("same")).first().same
    page = spark.createDataFrame([(1, "http://h.cz/a/b?q", """<a href="/x">1</a><a HREF='y#z'>2</a><a href="http://o.cz/">3</a><a href="/x">4</a>""")], "page_id int, url string, html string")
    assert sorted(r.link for r in landing.links(page).collect()) == ["http://h.cz/a/y", "http://h.cz/x", "http://o.cz/"]
    rows = spark.createDataFrame([("n", "1", True), ("m", None, False)], "name string, zip string, person boolean")
    got = landing.redacted(rows, {"name": F.col("person"), "zip": F.col("person")}).collect()
    assert [(r.name, r.zip, r.redacted) for r in got] == [(None, None, ["name", "zip"]), ("m", None, [])]


def test_personal_data_goes_from_payloads(spark):
    cases = {
        '{"dodavatel":[{"nazev":"Jan Novak"}]}': ('{"dodavatel":[{}]}', ["dodavatel[0].nazev"]),
        '{"dodavatel":{"ICO":"1","nazev":"F","adresa":{"ulice":"U","Telefon":"2"}}}': ('{"dodavatel":{"ICO":"1","adresa":{"ulice":"U"},"nazev":"F"}}', ["dodavatel.adresa.Telefon"]),
        '{"prijemce":{"obec":"O","datovaSchranka":"d","adresa":{"email":"e"},"x":{"ulice":"kept"}}}': ('{"prijemce":{"x":{"ulice":"kept"}}}', ["prijemce.adresa", "prijemce.datovaSchranka", "prijemce.obec"]),
        '{"a":[{"rodneCislo":"1"},[{"@e-mail":"x","n":1}]],"owner":"o"}': ('{"a":[{},[{"n":1}]]}', ["a[0].rodneCislo", "a[1][0].@e-mail", "owner"]),
        '[{"datumNarozeni":"1"},2]': ("[{},2]", ["[0].datumNarozeni"]),
        "not json": ("not json", []),
        "null": ("null", []),
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "p string").coalesce(1)
    got = {r.p: (r.x.payload, r.x.redacted) for r in df.select("p", redact_json(F.col("p"), PARTIES["open_data"], ALWAYS["notices"]).alias("x")).collect()}
    assert got == cases | {None: (None, [])}


def test_parties_depend_on_the_source(spark):
    text = '{"owner":{"prijmeni":"P"},"dodavatel":{"nazev":"N"},"dodavatele":[{"nazev":"D"}],"smluvniStrana":{"obec":"O"}}'
    df = spark.createDataFrame([(text,)], "p string")
    gone = {s: df.select(redact_source(F.col("p"), s)["redacted"]).first()[0] for s in PARTIES}
    assert gone == {"contracts": ["smluvniStrana.obec"], "notices": ["dodavatele[0].nazev", "owner"], "open_data": ["dodavatel.nazev", "dodavatele[0].nazev"], "buyer_profiles": ["dodavatel.nazev"]}


def test_contacts_owners_and_nameless_organisations_go_from_notice_trees(spark):
    firm = {"BT-500-Organization-Company": "Firm", "ND-CompanyLegalEntity": [{"x": 1}, {"BT-501-Organization-Company": "27502988"}], "ND-CompanyContact": {"BT-503-Organization-Company": "1", "BT-739-Organization-Company": "2"}}
    person = {"BT-500-Organization-Company": "Jan", "ND-CompanyAddress": {"BT-510(a)-Organization-Company": "U", "BT-502-X": "c"}, "BT-165-Organization-Company": "sme"}
    empty = {"ND-CompanyLegalEntity": {"BT-501-Organization-Company": ""}, "ND-CompanyAddress": {"a": 1}}
    tree = {"deti": [{"owner": {"name": "X"}, "data": {"orgs": [{"ND-Company": firm}, {"ND-Company": person}, {"ND-Company": empty}], "ND-UBO": [{"BT-500-UBO": "Jan"}]}}]}
    df = spark.createDataFrame([(json.dumps(tree),), ("no json",), (None,)], "p string").coalesce(1)
    first, second, third = [r.x for r in df.select(redact_notice(F.col("p")).alias("x")).collect()]
    left = json.loads(first.payload)["deti"][0]["data"]["orgs"]
    assert left == [{"ND-Company": firm | {"ND-CompanyContact": {}}}, {"ND-Company": {"BT-165-Organization-Company": "sme"}}, {"ND-Company": {"ND-CompanyLegalEntity": {"BT-501-Organization-Company": ""}}}]
    orgs = "deti[0].data.orgs"
    assert first.redacted == ["deti[0].data.ND-UBO", f"{orgs}[0].ND-Company.ND-CompanyContact.BT-503-Organization-Company", f"{orgs}[0].ND-Company.ND-CompanyContact.BT-739-Organization-Company",
        f"{orgs}[1].ND-Company.BT-500-Organization-Company", f"{orgs}[1].ND-Company.ND-CompanyAddress", f"{orgs}[2].ND-Company.ND-CompanyAddress", "deti[0].owner"]
    assert (second.payload, third.payload) == ("no json", None)


def test_name_similarity(spark):
    df = spark.createDataFrame([("abc def", "abc def"), ("abc def", "def abc"), ("abcd", "abce"), ("", "x")], "a string, b string")
    got = [round(r.x, 3) for r in df.select(name_similarity(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [1.0, 1.0, 0.75, 0.0]
