"""SNK-1 beside CSV: tables as XLSX workbooks.

A workbook is one zip archive and so one writer's work; a table of any size
becomes as many workbooks as its rows need. Every task streams its rows into
archives of at most ``rows_per_book`` rows; what comes back is a frame of
``(path, content)``, which any binary sink can store."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from datetime import date, datetime
from decimal import Decimal
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_TYPES = "application/vnd.openxmlformats-officedocument.spreadsheetml"
MOST_ROWS = 1_048_575  # of a worksheet, besides the header

_PARTS = {
    "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{_TYPES}.sheet.main+xml"/>'
    f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{_TYPES}.worksheet+xml"/>'
    f'<Override PartName="/xl/styles.xml" ContentType="{_TYPES}.styles+xml"/></Types>',
    "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" Type="{_RELS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" Type="{_RELS}/worksheet" Target="worksheets/sheet1.xml"/>'
    f'<Relationship Id="r2" Type="{_RELS}/styles" Target="styles.xml"/></Relationships>',
    # style 1 shows dates, style 2 moments
    "xl/styles.xml": f'<styleSheet xmlns="{_MAIN}"><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd\\ hh:mm:ss"/></numFmts>'
    '<fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
    '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="164" applyNumberFormat="1"/></cellXfs></styleSheet>',
}
_DAY_0 = datetime(1899, 12, 30)


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float | Decimal):
        return f"<c><v>{value}</v></c>"
    if isinstance(value, datetime):
        days = value.replace(tzinfo=None) - _DAY_0
        return f'<c s="2"><v>{days.days + days.seconds / 86_400 + days.microseconds / 86_400e6!r}</v></c>'
    if isinstance(value, date):
        return f'<c s="1"><v>{(datetime(value.year, value.month, value.day) - _DAY_0).days}</v></c>'
    text = "".join(x for x in str(value) if x in "\t\n\r" or x >= " ")
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


class _Book:
    def __init__(self, sheet: str, header: list[str]):
        self.raw, self.rows = io.BytesIO(), 0
        self.zip = zipfile.ZipFile(self.raw, "w", zipfile.ZIP_DEFLATED)
        for name, xml in _PARTS.items():
            self.zip.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + xml)
        shown = escape(sheet[:31], {'"': "&quot;"})
        self.zip.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_MAIN}" xmlns:r="{_RELS}"><sheets>'
                                             f'<sheet name="{shown}" sheetId="1" r:id="r1"/></sheets></workbook>')
        self.out = self.zip.open("xl/worksheets/sheet1.xml", "w")
        self.out.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN}"><sheetData>'.encode())
        self.add(header)
        self.rows = 0

    def add(self, values) -> None:
        self.out.write(f"<row>{''.join(map(_cell, values))}</row>".encode())
        self.rows += 1

    def close(self) -> bytes:
        self.out.write(b"</sheetData></worksheet>")
        self.out.close()
        self.zip.close()
        return self.raw.getvalue()


BOOKS = T.StructType([T.StructField("path", T.StringType()), T.StructField("content", T.BinaryType())])


def to_workbooks(df: DataFrame, sheet: str, rows_per_book: int = 50_000) -> DataFrame:
    """``(path, content)``: the rows of ``df``, in the order of each partition, as
    workbooks named ``<sheet>-<partition>-<n>.xlsx`` of one worksheet ``sheet``."""
    header, most = list(df.columns), min(rows_per_book, MOST_ROWS)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, n, part = None, 0, 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [f"{sheet}-{part:05d}-{n:05d}.xlsx"], "content": [book.close()]})

        for b in batches:
            for p, *values in zip(*[c.to_pylist() for c in b.columns]):
                part = p
                if book is None:
                    book = _Book(sheet, header)
                book.add(values)
                if book.rows >= most:
                    yield done()
                    book, n = None, n + 1
        if book is not None:
            yield done()

    return df.select(F.spark_partition_id().alias("__part"), *[f"`{c}`" for c in header]).mapInArrow(write, BOOKS)
