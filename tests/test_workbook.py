"""Sheets of workbooks: cell types, sparse rows, styles, many files, and the
whole inventory from one workbook."""

import datetime as dt
import io
import os
import tempfile
import zipfile

import pytest
from pyspark.errors import PythonException
from pyspark.sql import Row

from checks import rows
from emberledger.plans import sectors
from emberledger.sources import schemas as S
from emberledger.sources.workbook import book_bytes, cells, read_sheet, sheet_names, sheet_rows, to_books
from test_sectors import tables  # noqa: F401

SPACE = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def by_hand(sheet_xml, strings=(), styles="", workbook=""):
    """A workbook as spreadsheet programs write it: shared strings, styles."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{SPACE}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
                   f'{workbook}<sheets><sheet name="first" sheetId="1" r:id="rId7"/><sheet name="data &amp; more" sheetId="4" r:id="rId3"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId3" Target="/xl/worksheets/other.xml"/><Relationship Id="rId7" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{SPACE}"><sheetData/></worksheet>')
        z.writestr("xl/worksheets/other.xml", f'<worksheet xmlns="{SPACE}"><dimension ref="A1:D9"/><sheetData>{sheet_xml}</sheetData></worksheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{SPACE}">{"".join(strings)}</sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{SPACE}">{styles}</styleSheet>')
    return out.getvalue()


SHEET = (
    '<row r="3"><c r="B3" t="s"><v>0</v></c><c r="C3" t="s"><v>1</v></c><c r="AA3" t="s"><v>2</v></c><c r="AB3" t="str"><v>when</v></c></row>'
    '<row r="4"><c r="A4"><v>99</v></c><c r="B4" t="s"><v>3</v></c><c r="C4"><v>0.1</v></c><c r="AA4"><v>2.016E3</v></c><c r="AB4" s="1"><v>43831.5</v></c></row>'
    '<row r="5"/>'
    '<row r="7"><c r="B7" t="inlineStr"><is><r><t>two </t></r><r><t>parts</t></r></is></c><c r="C7" t="e"><v>#N/A</v></c><c r="AA7" t="b"><v>1</v></c><c r="AB7" s="2"><v>1</v></c></row>'
    '<row r="8"><c r="B8" t="s"><v>4</v></c><c r="C8"><f>C4*2</f><v>0.2</v></c></row>'
)
STRINGS = ("<si><t>name</t></si>", "<si><t>amount</t></si>", "<si><r><t>input_</t></r><r><t>year</t></r></si>", "<si><t>a &amp; b</t></si>", "<si><t>NA</t></si>")
STYLES = '<numFmts count="2"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="[Red]0.0&quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'


def test_cells():
    got = list(cells(by_hand(SHEET, STRINGS, STYLES), "data & more"))
    assert got == [
        (3, {1: "name", 2: "amount", 26: "input_year", 27: "when"}),
        (4, {0: "99", 1: "a & b", 2: "0.1", 26: "2016", 27: "2020-01-01 12:00:00"}),
        (7, {1: "two parts", 26: "true", 27: "1"}),
        (8, {2: "0.2"}),
    ]
    later = dict(cells(by_hand(SHEET, STRINGS, STYLES, '<workbookPr date1904="1"/>'), "data & more"))
    assert later[4][27] == "2024-01-02 12:00:00"
    with pytest.raises(ValueError, match="no sheet 'none'"):
        list(cells(by_hand(SHEET), "none"))


def frame(spark, *contents):
    return spark.createDataFrame([(f"f{i}", bytearray(c)) for i, c in enumerate(contents)], "file string, content binary")


def test_typed_rows_of_many_books(spark):
    clean = SHEET.replace('<c r="AA7" t="b"><v>1</v></c>', "")
    books = frame(spark, by_hand(clean, STRINGS, STYLES), by_hand(clean, STRINGS, STYLES))
    got = sheet_rows(books, "data & more", "input_year int, amount double, name string", with_position=True)
    assert got.schema.simpleString() == "struct<input_year:int,amount:double,name:string,_file:string,_row:int>"
    want = [(2016, 0.1, "a & b", 4), (None, None, "two parts", 7), (None, 0.2, None, 8)]
    assert rows(got) == sorted([(y, a, n, f, r) for y, a, n, r in want for f in ("f0", "f1")], key=repr)


def test_wrong_cells_and_columns_fail(spark):
    books = frame(spark, by_hand(SHEET, STRINGS, STYLES))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sheet_rows(books, "data & more", "input_year int").collect()
    with pytest.raises(PythonException, match="lacks columns"):
        sheet_rows(books, "data & more", "other int").collect()
    assert sheet_rows(frame(spark, by_hand("")), "first", "a int").collect() == []


def test_names_and_types_from_the_header(spark):
    books = frame(spark, book_bytes({"s": (["year", "town_tonnes", "note"], [(2020, 1.5, "x"), (2021, None, "3")])}))
    got = sheet_rows(books, "s")
    assert got.schema.simpleString() == "struct<year:double,town_tonnes:double,note:string>"
    assert got.collect() == [Row(year=2020.0, town_tonnes=1.5, note="x"), Row(year=2021.0, town_tonnes=None, note="3")]


def test_round_trip(spark):
    data = [(i, i / 7, f"<{i}> & 'q' \n é", i % 2 == 0, dt.datetime(1999, 12, 31, 23, 59, 59, 123000 * (i % 8)), dt.date(1900, 3, 1)) for i in range(500)]
    data += [(None, None, None, None, None, None)]
    df = spark.createDataFrame(data, "i long, d double, s string, b boolean, t timestamp_ntz, day date").repartition(3)
    back = sheet_rows(to_books(df, "sheet", rows_per_book=70), "sheet", df.schema)
    assert rows(back) == rows(df.where("i IS NOT NULL"))  # a row without a cell is no row


def test_inventory_from_one_workbook(spark, tables):  # noqa: F811
    from emberledger.plans.run import run_inventory

    sheets = {}
    for name, df in tables.items():
        # a sheet has a header even where it has no rows
        sheets[name] = (df.columns, [tuple(r) for r in df.collect()])
    base = tempfile.mkdtemp(prefix="workbook-")
    path = os.path.join(base, "inputs.xlsx")
    with open(path, "wb") as f:
        f.write(book_bytes(sheets))
    assert sheet_names(spark, path) == set(tables)
    out = run_inventory(spark, path, f"{base}/out", ["town", "campus"], ["campus"], "town", fmt="xlsx", out_fmt="parquet", waste_years=[2020])
    got = spark.read.schema(S.LEDGER).parquet(out["inventory"])
    direct = sectors.inventory(tables, ["town", "campus"], ["campus"], "town", [2020])
    cols = ["supercategory", "activity", "entity", "input_year", "amount", "total_mtco2e"]
    assert rows(got, *cols) == rows(direct, *cols)
    assert rows(read_sheet(spark, base + "/*.xlsx", "activity_map", S.ACTIVITY_MAP)) == rows(tables["activity_map"])
