import io
import zipfile

import pytest

from voltframe.sources import files, psse, workbook
from voltframe.sources.columns import SourceError, fields

RAW = """0, 100.0, 30 / written by nobody
FIRST
SECOND
1, 'ONE / A', 138.0, 1, 0, 0, 1, 1, 1.0, 0.0, 1 /* [1 ONE] */
2, 'TWO', 138.0, 3
0 / END OF BUS DATA
0 / END OF LOAD DATA
0 / END OF GENERATOR DATA
1, 2, '1 ', 0.01, 0.1, 0.0, 100, 120, 130, 0, 0, 0, 0, 1 / [LINE_A]
0 / END OF BRANCH DATA
1, 2, 0, '1 ', 1, 1, 1, 0, 0, 2, 'X', 1
0.0, 0.2, 100
1.05, 138, 0, 50, 60, 70
1.0, 138
0 / END OF TRANSFORMER DATA
Q
"""


def pack(spark, **named):
    rows = [("b", "m" + n, n, bytearray(x.encode() if isinstance(x, str) else x)) for n, x in named.items()]
    return spark.createDataFrame(rows, files.MEMBER)


def test_zip_members_and_delimited(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/Lines_20260101.csv", '﻿Hour Ending,MW,Name,\r\n1.0, 2.5 ,"a, b",extra,more\r\n2,,\r\n\r\n')
    (tmp_path / "plain.txt").write_text("none")
    found = files.members(files.documents(spark, str(tmp_path)))
    assert {r["member_path"] for r in found.collect()} == {"x/Lines_20260101.csv", "plain.txt"}
    kinds = files.identity(files.classified(found, [(r"Lines_\d{8}\.csv$", "lines")]), r"_(\d{8})\.", [("day", "string")])
    assert {(r["kind"], r["day"]) for r in kinds.collect()} == {("lines", "20260101"), ("unknown", None)}
    rows = files.delimited(kinds.where("kind = 'lines'"), fields("Hour Ending:i", "MW:d", "Name")).orderBy("hour_ending").collect()
    assert [(r["hour_ending"], r["mw"], r["name"], r["day"]) for r in rows] == [(1, 2.5, "a, b", "20260101"), (2, None, None, "20260101")]


@pytest.mark.parametrize("text", ["Other\n1\n", "Hour Ending\n1.5\n", "Hour Ending\nx\n", ""])
def test_bad_files_are_errors(spark, text):
    with pytest.raises(Exception, match="declared one|whole number"):
        files.delimited(pack(spark, a=text), fields("Hour Ending:i")).collect()


def test_no_files_give_no_rows(spark):
    none = pack(spark, a="A\n").where("false")
    assert files.delimited(none, fields("A:d")).collect() == []
    assert psse.table(psse.records(none), "bus").collect() == []


@pytest.mark.parametrize("text", [RAW, None])
def test_psse_in_both_dialects(spark, text):
    if text is None:
        body = RAW.replace(",", " ").split("\n")
        text = "\n".join(["0" if x.startswith("0 / END") else x for x in body[:-2]] + ["0"] * 10 + ["Q"])
    found = psse.records(pack(spark, a=text)).cache()
    bus = psse.table(found, "bus").orderBy("i").collect()
    assert [(r["i"], r["name"], r["ide"], r["owner"], r["comment"]) for r in bus] == [(1, "ONE / A", 1, 1, "1 ONE"), (2, "TWO", 3, None, None)]
    assert [(r["ckt"], r["x"], r["st"], r["len"], r["comment"]) for r in psse.table(found, "branch").collect()] == [("1", 0.1, 1, None, "LINE_A")]
    assert [(r["x1_2"], r["windv1"], r["ratb1"], r["nomv2"], r["comment"]) for r in psse.table(found, "transformer").collect()] == [(0.2, 1.05, 60.0, 138.0, None)]
    case = psse.table(found, "case").first()
    assert (case["sbase"], case["title1"], case["title2"], case["header_comment"]) == (100.0, "FIRST", "SECOND", "written by nobody")
    found.unpersist()


@pytest.mark.parametrize(
    "old, new",
    [("30 /", "33 /"), ("'TWO'", "'TWO"), ("1, 2, 0,", "1, 2, 3,"), ("1.0, 138\n", ""), ("END OF LOAD", "END OF BUS"), ("END OF LOAD", "END OF NOTHING"), ("0 / END OF LOAD DATA", "0"), ("0 / END OF TRANSFORMER DATA\n", ""), ("138.0, 3", "138.0" + ", 1" * 9)],
)
def test_psse_refuses(old, new):
    with pytest.raises(SourceError):
        for _ in psse.sections(RAW.replace(old, new, 1)):
            pass


def book(rows):
    def cell(v):
        return f'<c t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else "<c/>" if v is None else f"<c><v>{v}</v></c>"

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Results" sheetId="1" r:id="q"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="q" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>" + "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in rows) + "</sheetData></worksheet>")
    return out.getvalue()


def test_limits_of_a_long_day(spark):
    hours = ["2026-11-01 00:00:00", "2026-11-01 01:00:00", "2026-11-01 01:00:00", "2026-11-01 02:00:00"]
    data = book([["Time", "A", "A\nDAM"], *[[h, 10 + i, "n/a" if i else 5.5] for i, h in enumerate(hours)]])
    rows = workbook.limits(pack(spark, g=data)).orderBy("market", "interval_start_utc").collect()
    assert [r["interval_start_utc"].hour for r in rows] == [5, 6, 7, 8] * 2
    assert [(r["market"], r["gtc_name"], r["limit_mw"]) for r in rows][:2] == [("dam", "A", 5.5), ("dam", "A", None)]
    assert [r["limit_mw"] for r in rows[4:]] == [10, 11, 12, 13] and [r["hour_ending"] for r in rows[4:]] == [1, 2, 2, 3]
    with pytest.raises(Exception, match="pair up"):
        workbook.limits(pack(spark, g=book([["Time", "A"], [hours[0], 1]]))).collect()
