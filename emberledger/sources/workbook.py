"""Sheets of workbooks (S1): ``.xlsx`` files read by Spark, cell by cell.

A workbook is a zip archive of XML parts. Spark's binary file source brings the
archives to the tasks from any store it can read, one row per workbook, so a
folder of many workbooks is read in parallel; a task streams the wanted
sheet's XML and never builds the sheet as a whole. The first row that is not empty
is the header. Cells become text -- shared and inline strings, numbers, truth
values, dates by the cell's style -- and are then cast to the declared schema
like the cells of a CSV table: columns by header name, empty cells, errors and
``NA`` are null, and a value that does not fit fails the read.
"""

from __future__ import annotations

import io
import posixpath
import re
import sys
import zipfile
from collections.abc import Iterator
from datetime import date, datetime, timedelta
from xml.etree.ElementTree import iterparse
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberledger.functions.semantics import NA_TOKEN
from emberledger.sources.typing import typed

# what runs in tasks is sent along, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the format.
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
EPOCH, EPOCH_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)
MOST_ROWS = 1_048_576

#: Rows that a task hands to Spark at a time.
BATCH = 2000


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _events(archive: zipfile.ZipFile, part: str, *names: str) -> Iterator:
    """Finished elements of the given names in a part of the archive."""
    with archive.open(part) as f:
        context = iterparse(f, events=("start", "end"))
        _, root = next(context)
        for event, element in context:
            if event == "end" and _local(element.tag) in names:
                yield element
                root.clear()  # what was read is let go


def _column(reference: str) -> int:
    """Number from 0 of the column of a cell such as ``AB12``."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = 26 * n + ord(c.upper()) - 64
    return n - 1


def sheet_parts(archive: zipfile.ZipFile) -> dict[str, str]:
    """Sheet name -> its part in the archive, in the workbook's order."""
    targets = {e.get("Id"): e.get("Target") for e in _events(archive, "xl/_rels/workbook.xml.rels", "Relationship")}

    def part(target: str) -> str:
        return target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join("xl", target))

    return {e.get("name"): part(targets[e.get(RELATION)]) for e in _events(archive, "xl/workbook.xml", "sheet")}


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """The cell styles that show a number as a date."""
    if "xl/styles.xml" not in archive.namelist():
        return set()
    dates, styles = set(DATE_FORMATS), []
    for e in _events(archive, "xl/styles.xml", "numFmt", "cellXfs"):
        if _local(e.tag) == "numFmt":
            code = re.sub(r'"[^"]*"|\\.|\[(?!h|m|s)[^\]]*\]', "", e.get("formatCode", "").lower())
            if re.search("[ymdhs]", code):
                dates.add(int(e.get("numFmtId")))
        else:
            styles = [int(x.get("numFmtId", 0)) for x in e]
    return {i for i, n in enumerate(styles) if n in dates}


def _shared_strings(archive: zipfile.ZipFile) -> list[str]:
    part = "xl/sharedStrings.xml"
    if part not in archive.namelist():
        return []
    return ["".join(t.text or "" for t in e.iter() if _local(t.tag) == "t") for e in _events(archive, part, "si")]


def _number(text: str) -> str:
    """A number as text that casts to integer and floating types alike."""
    value = float(text)
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)


def cells(content: bytes, sheet: str) -> Iterator[tuple[int, dict[int, str]]]:
    """Row number and the cells (column number -> text) of the rows of a
    sheet that are not empty."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        parts = sheet_parts(archive)
        if sheet not in parts:
            raise ValueError(f"no sheet {sheet!r}; there are {list(parts)}")
        strings, dates = _shared_strings(archive), _date_styles(archive)
        epoch = EPOCH
        for e in _events(archive, "xl/workbook.xml", "workbookPr"):
            epoch = EPOCH_1904 if e.get("date1904") in ("1", "true") else EPOCH
        number = 0
        for row in _events(archive, parts[sheet], "row"):
            number = int(row.get("r", number + 1))
            found, at = {}, -1
            for c in row:
                at = _column(c.get("r")) if c.get("r") else at + 1
                kind = c.get("t", "n")
                if kind == "inlineStr":
                    text = "".join(t.text or "" for t in c.iter() if _local(t.tag) == "t")
                else:
                    text = next((v.text for v in c if _local(v.tag) == "v"), None)
                if text is None or text == "" or kind == "e":
                    continue
                if kind == "s":
                    text = strings[int(text)]
                elif kind == "b":
                    text = "true" if text == "1" else "false"
                elif kind == "n" and int(c.get("s", 0)) in dates:
                    text = str(epoch + timedelta(milliseconds=round(float(text) * 86_400_000)))  # a day's fraction tells no more
                elif kind == "n":
                    text = _number(text)
                if text not in ("", NA_TOKEN):
                    found[at] = text
            if found:
                yield number, found


def books(spark: SparkSession, path: str) -> DataFrame:
    """The workbooks of a file, folder or pattern: ``file``, ``content``."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return found.select(F.col("path").alias("file"), "content")


def sheet_names(spark: SparkSession, path: str) -> set[str]:
    """The sheets that every workbook at ``path`` has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(*(c.to_pylist() for c in batch.columns)):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    names = list(sheet_parts(archive))
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(names)), pa.array(names)], names=["file", "name"])

    found = books(spark, path)
    n = found.select("file").count()
    named = found.mapInArrow(run, "file string, name string").groupBy("name").agg(F.count_distinct("file").alias("n"))
    return {r.name for r in named.filter(F.col("n") == n).collect()}


def sheet_rows(found: DataFrame, sheet: str, schema: T.StructType | str | None = None, with_position: bool = False) -> DataFrame:
    """The rows of one sheet of every workbook of ``found`` (``file``,
    ``content``), typed by ``schema``.

    Columns of the sheet that the schema does not name are ignored; one that
    is missing raises. Without a schema, a pass over the sheets takes the names from
    their headers, and a column is a number if all its cells are.
    ``with_position`` adds ``_file`` and ``_row``, the row of the sheet.
    """
    if isinstance(schema, str):
        schema = found.sparkSession.createDataFrame([], schema).schema
    schema = schema if schema is not None else _inferred(found, sheet)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (*[pa.string()] * (len(names) + 1), pa.int32()))]
            return pa.RecordBatch.from_arrays(columns, names=[*names, "_file", "_row"])

        for batch in batches:
            for i in range(batch.num_rows):
                file = batch.column(0)[i].as_py()
                held, at = [], None
                for number, row in cells(batch.column(1)[i].as_py(), sheet):
                    if at is None:
                        header = {v: k for k, v in reversed(row.items())}  # of equal names the first
                        lacks = [n for n in names if n not in header]
                        if lacks:
                            raise ValueError(f"{file}, sheet {sheet!r} lacks columns {lacks}")
                        at = [header[n] for n in names]
                        continue
                    held.append((*(row.get(k) for k in at), file, number))
                    if len(held) == BATCH:
                        yield batch_of(held)
                        held = []
                if held:
                    yield batch_of(held)

    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_file"]] + [T.StructField("_row", T.IntegerType())])
    rows = found.select("file", "content").mapInArrow(run, text)
    if with_position:
        schema = T.StructType([*schema.fields, *text.fields[-2:]])
    return typed(rows, schema, f"sheet {sheet!r}")


def _inferred(found: DataFrame, sheet: str) -> T.StructType:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                header, numbers = None, set()
                for _, row in cells(content, sheet):
                    if header is None:
                        header = row
                        numbers = set(header)
                        continue
                    numbers -= {k for k in numbers & row.keys() if not re.fullmatch(r"[-+]?[0-9.]+(e[-+]?\d+)?", row[k])}
                if header:
                    at = list(header)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at, pa.int32()), pa.array([header[k] for k in at]), pa.array([k in numbers for k in at])],
                        names=["at", "name", "number"],
                    )

    seen = found.select("content").mapInArrow(run, "at int, name string, number boolean")
    names = seen.groupBy("name").agg(F.min("at").alias("at"), F.bool_and("number").alias("number")).orderBy("at", "name").collect()
    return T.StructType([T.StructField(r.name, T.DoubleType() if r.number else T.StringType()) for r in names])


def read_sheet(spark: SparkSession, path: str, sheet: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One sheet of the workbook, or of all workbooks, at ``path``."""
    return sheet_rows(books(spark, path), sheet, schema)


# -- writing --------------------------------------------------------------


def book_bytes(sheets: dict[str, tuple[list[str], list[tuple]]]) -> bytes:
    """A workbook of sheets given as header and rows of plain values."""

    def letters(n: int) -> str:
        out = ""
        while n >= 0:
            out, n = chr(65 + n % 26) + out, n // 26 - 1
        return out

    def cell(value, at: str) -> str:
        if value is None:
            return ""
        if isinstance(value, bool):
            return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
        if isinstance(value, date) and not isinstance(value, datetime):
            value = datetime(value.year, value.month, value.day)
        if isinstance(value, datetime):
            return f'<c r="{at}" s="1"><v>{(value - EPOCH) / timedelta(days=1)!r}</v></c>'
        if isinstance(value, (int, float)):
            return f'<c r="{at}"><v>{value!r}</v></c>'
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'

    space = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    office = RELATION[1:].partition("}")[0]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        named = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{space}" xmlns:r="{office}"><sheets>{named}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in enumerate(sheets, 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}">{links}</Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{space}"><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{package}"><Relationship Id="r" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        main = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{main}.worksheet+xml"/>' for i, _ in enumerate(sheets, 1))
        z.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   f'<Override PartName="/xl/workbook.xml" ContentType="{main}.sheet.main+xml"/>'
                   f'<Override PartName="/xl/styles.xml" ContentType="{main}.styles+xml"/>{kinds}</Types>')  # fmt: skip
        for i, (header, rows) in enumerate(sheets.values(), 1):
            if len(rows) >= MOST_ROWS:
                raise ValueError(f"a sheet holds {MOST_ROWS} rows")
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                f.write(f'<worksheet xmlns="{space}"><sheetData>'.encode())
                for r, row in enumerate([header, *rows], 1):
                    f.write(f'<row r="{r}">{"".join(cell(v, f"{letters(k)}{r}") for k, v in enumerate(row))}</row>'.encode())
                f.write(b"</sheetData></worksheet>")
    return out.getvalue()


def to_books(df: DataFrame, sheet: str, rows_per_book: int = 50_000) -> DataFrame:
    """``df`` as workbooks of at most ``rows_per_book`` rows, made in the
    tasks that hold the rows: ``file`` (a number in the task), ``content``."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def book(k, rows):
            content = book_bytes({sheet: (names, rows)})
            return pa.RecordBatch.from_arrays([pa.array([str(k)]), pa.array([content], pa.binary())], names=["file", "content"])

        held, k = [], 0
        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            while len(held) >= rows_per_book:
                yield book(k, held[:rows_per_book])
                held, k = held[rows_per_book:], k + 1
        if held:
            yield book(k, held)

    return df.mapInArrow(run, "file string, content binary")
