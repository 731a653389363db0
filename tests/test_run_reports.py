"""Files of unknown layout, writers that are tried again, the gate by kind and profile documents."""

import csv
import datetime as dt
import glob
import gzip
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import gate, run_reports
from ledgerlake.sources import unknown, writers


def test_a_folder_of_files_of_unknown_layout(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("a.xml", "<data><zakazka id='1'><email>a</email></zakazka><zakazka><x>1</x><x>2</x></zakazka><other/></data>")
        z.writestr("readme.txt", "not data")
    outer = io.BytesIO()
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("deep.zip", inner.getvalue())
    files = {
        "one.json": b'\xef\xbb\xbf{"n":1,"short":[1],"long":{"rows":[1]},"rows":[{"id":1},{"id":2},3]}',
        "single.json": b'{"id":9}', "list.json.gz": gzip.compress(b'[{"id":4}]'), "x.zip": outer.getvalue(),
        "semi.csv": "id;name\n5;Ž, x\n6;\n".encode(), "comma.csv": b"id,name\n7,a;b\n8,c,extra\n", "empty.csv": b"", "broken.json": b'{"a":', "root.xml": b"<r><only><v/></only></r>", "text.xml": b"<r><i>1</i><i>2</i><j/></r>",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got: dict = {}
    for r in unknown.unknown_files(spark, str(tmp_path)).orderBy("path", "pos").collect():
        got.setdefault(r.path.rsplit("/", 1)[-1], []).append((r.format, r.record and json.loads(r.record)) if r.error is None else r.error.split(":")[0])
    assert got == {
        "one.json": [("json", {"id": 1}), ("json", {"id": 2}), ("json", {"hodnota": 3})], "single.json": [("json", {"id": 9})], "list.json.gz": [("json", {"id": 4})],
        "x.zip": [("xml", {"@id": "1", "email": "a"}), ("xml", {"x": ["1", "2"]})], "semi.csv": [("csv", {"id": "5", "name": "Ž, x"}), ("csv", {"id": "6", "name": ""})],
        "comma.csv": [("csv", {"id": "7", "name": "a;b"}), ("csv", {"id": "8", "name": "c", "_rest": ["extra"]})], "broken.json": ["JSONDecodeError"], "text.xml": [("xml", {"hodnota": "1"}), ("xml", {"hodnota": "2"})],
    }


def test_a_writer_that_fails_between_two_tables_leaves_the_run_before(spark, tmp_path):
    folder = str(tmp_path / "out")
    table = lambda k: spark.createDataFrame([(k,)], "k int")
    fails = table(0).select(F.raise_error(F.lit("lost")).cast("int").alias("k"))
    read = lambda: [writers.published(spark, folder, t).first().k for t in ("a", "b")]
    writers.publish({"a": table(1), "b": table(2)}, folder, "r1")
    with pytest.raises(Exception, match="lost"):
        writers.publish({"a": table(3), "b": fails}, folder, "r2")
    assert read() == [1, 2]
    writers.publish({"a": table(3), "b": table(4)}, folder, "r2")
    assert read() == [3, 4]
    writers.publish({"a": table(3), "b": table(4)}, folder, "r2")
    assert read() == [3, 4]
    (tmp_path / "out" / "current").rename(tmp_path / "out" / "superseded2")  # lost between the two renames
    assert read() == [3, 4]


def test_csv_of_fixed_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b', None), (2, None, "x\ny")], "id int, t string, more string")
    writers.csv_extract(df.coalesce(1), ["t", "confirmed", "id"], str(tmp_path / "c"))
    with open(glob.glob(str(tmp_path / "c" / "*.csv"))[0], newline="", encoding="utf-8") as f:
        assert list(csv.reader(f)) == [["t", "confirmed", "id"], ['a "q", b', "", "1"], ["", "", "2"]]


def test_gate_by_kind(spark):
    rules = {"castka": gate.amount_rules(), "text": gate.text_rules("text")}
    df = spark.createDataFrame([("castka", "CZK", "", True), ("text", None, "podezřelý", True), ("text", "CZK", "", False), ("jiny", "CZK", "", True), (None, "CZK", "", True)], "kind string, currency string, text string, fresh boolean").withColumns({c: F.lit("x") for c in ("type", "vat", "period")})
    got = [r.c for r in df.select(gate.dispatched(F.col("kind"), rules, {"OLD": ~F.col("fresh")}, {"NO_DATE": F.lit(True)}).alias("c")).collect()]
    assert got == [["NO_DATE"], ["EVALUATIVE_WORDS"], ["OLD"], [gate.UNKNOWN_OUTPUT], [gate.UNKNOWN_OUTPUT]]


def test_profile_documents(spark):
    day = dt.date(2026, 5, 1)
    rows = [
        ("1", "2", "vvz", "vysoutezena", "CZK", 100, True, day), ("1", "2", "vvz", "vysoutezena", "CZK", 300, False, day), ("1", "2", "vvz", "vysoutezena", "CZK", 999, False, dt.date(2022, 1, 1)),
        ("1", None, "vvz", "predpokladana", "CZK", 5, False, day), ("1", None, "vvz", "predpokladana", "EUR", 5, False, day), ("3", "2", "red", "dotace_priznana", "CZK", 7, False, day), ("1", "2", "red", "smluvni", "CZK", 7, False, day),
    ]
    amounts = spark.createDataFrame([(*r[:5], "bez_dph", "celkem", *r[5:]) for r in rows], "payer string, recipient string, source string, type string, currency string, vat string, period string, value int, heuristic boolean, day date")
    marks = spark.createDataFrame([("2", "b", day, ("b1",), []), ("2", "a", dt.date(2025, 1, 1), ("a1",), []), ("2", "a", day, ("a2",), []), ("2", "c", day, ("c",), ["X", "A"]), ("2", "z", dt.date(2027, 1, 1), ("z",), [])], "ico string, code string, period_from date, item struct<v: string>, codes array<string>")
    companies = spark.createDataFrame([("1", False), ("2", False), ("3", True), ("4", None), ("5", False)], "ico string, person boolean")
    got = {r.ico: json.loads(r.document) for r in run_reports.profiles(companies, amounts, marks, F.lit("2026-06-15").cast("date")).collect()}
    one, two = got["1"], got["2"]
    assert one["zakazky_jako_zadavatel"] == [{"source": "vvz", "type": "vysoutezena", "currency": "CZK", "vat": "bez_dph", "period": "celkem", "value": "400.00", "n": 2, "heuristic_share": "0.2500", "range": {"low": "300.00", "high": "400.00"}}]
    assert one["left_out"] == [{"item": "zakazky_jako_zadavatel/vvz/predpokladana", "reason": ["SUMMARY_OF_SEVERAL_KINDS"]}] and (one["from"], one["to"]) == ("2023-06-01", "2026-06-16")
    assert [x["value"] for x in two["zakazky_jako_dodavatel"]] == ["400.00"] and [x["value"] for x in two["dotace"]] == ["7.00"]
    assert [x["v"] for x in two["indicators"]] == ["a2", "a1", "b1"] and two["left_out"] == [{"item": "c", "reason": ["A", "X"]}]
    assert [got[k]["issued"] for k in ("3", "4", "5")] == [False, False, True]
