"""XLSX without libraries: a reader of the first sheet, a writer of workbooks, and a Spark data source."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterable
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Characters that XML can't hold.
_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")
#: Widths of a data sheet's text and other columns, and of the metadata sheet's columns.
WIDE, NARROW, META_WIDTHS, LONGEST_SHEET_NAME = 46, 16, (22, 36, 72), 31


def column_name(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def _column_index(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _text(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_NS}t"))


def read_rows(path) -> list[tuple]:
    """The first sheet's rows, all cells as text or None. ``path`` may be a file object."""
    with zipfile.ZipFile(path) as z:
        names = set(z.namelist())
        shared = [_text(x) for x in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{_NS}si")] if "xl/sharedStrings.xml" in names else []
        first = ElementTree.fromstring(z.read("xl/workbook.xml")).find(f"{_NS}sheets")[0].get(f"{_REL}id")
        links = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = links[first].lstrip("/")
        sheet = z.read(target if target.startswith("xl/") else f"xl/{target}")
    rows = []
    for r in ElementTree.fromstring(sheet).iter(f"{_NS}row"):
        cells: list = []
        for i, c in enumerate(r.findall(f"{_NS}c")):
            at = _column_index(c.get("r")) if c.get("r") else i
            cells += [None] * (at + 1 - len(cells))
            kind, value = c.get("t"), c.find(f"{_NS}v")
            if kind == "inlineStr":
                cells[at] = _text(c)
            elif value is not None and value.text is not None:
                cells[at] = shared[int(value.text)] if kind == "s" else value.text
        rows.append(tuple(x if x != "" else None for x in cells))
    return rows


def _cell(ref: str, x, style: int) -> str:
    if x is None:
        return ""
    if isinstance(x, (int, float)) and not isinstance(x, bool):
        return f'<c r="{ref}" s="{style}"><v>{x!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr" s="{style}"><is><t xml:space="preserve">{escape(_BAD.sub("", str(x)))}</t></is></c>'


def _sheet(columns: list[str], rows: Iterable, widths: list[int], styles: list[int]) -> Iterable[str]:
    yield '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>'
    yield "".join(f'<col min="{i + 1}" max="{i + 1}" width="{w}" customWidth="1" style="{s}"/>' for i, (w, s) in enumerate(zip(widths, styles, strict=True)))
    yield "</cols><sheetData>"
    for n, row in enumerate([columns, *rows] if isinstance(rows, list) else _chain(columns, rows), 1):
        yield f'<row r="{n}">{"".join(_cell(f"{column_name(i)}{n}", x, 1 if n == 1 else styles[i]) for i, x in enumerate(row))}</row>'
    yield "</sheetData></worksheet>"


def _chain(first, rest):
    yield first
    yield from rest


def write_book(path, columns: list[str], rows: Iterable, meta: Iterable[tuple[str, str, str]] = (), sheet: str = "data", text_columns: Iterable[str] = ("english", "target")) -> None:
    """A workbook of a data sheet and a sheet ``metadata`` (section, item, value), headers frozen; rows are streamed.

    ``path`` may be a file object. Sheet names are cut to 31 characters.
    """
    wide = set(text_columns)
    sheets = [
        (sheet[:LONGEST_SHEET_NAME], list(columns), rows, [WIDE if c in wide else NARROW for c in columns], [0] * len(columns)),
        ("metadata", ["section", "item", "value"], meta, list(META_WIDTHS), [1, 0, 2]),
    ]
    main, office = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in (1, 2)) + "</Types>")
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{main}" xmlns:r="{office}"><sheets>' + "".join(f'<sheet name={quoteattr(s[0])} sheetId="{i}" r:id="rId{i}"/>' for i, s in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in (1, 2)) + f'<Relationship Id="rId3" Type="{office}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<?xml version="1.0"?><styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf/><xf fontId="1" applyFont="1"/><xf applyAlignment="1"><alignment vertical="top" wrapText="1"/></xf></cellXfs></styleSheet>')
        for i, (_, names, own, widths, styles) in enumerate(sheets, 1):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as out:
                for text in _sheet(names, own, widths, styles):
                    out.write(text.encode())


class XlsxSource(DataSource):
    """``spark.read.format("xlsx").load(path)``: the first sheet, all columns as text. Option header (true)."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _has_header(self) -> bool:
        return self.options.get("header", "true").lower() == "true"

    def schema(self) -> StructType:
        rows = read_rows(self.options["path"])
        width = max(map(len, rows), default=0)
        names = [str(x) if x is not None else f"Unnamed: {i}" for i, x in enumerate((*rows[0], *[None] * (width - len(rows[0]))))] if rows and self._has_header() else [f"c{i}" for i in range(width)]
        return StructType([StructField(n, StringType()) for n in names])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _XlsxReader(self.options["path"], self._has_header(), len(schema))


class _XlsxReader(DataSourceReader):
    def __init__(self, path: str, header: bool, width: int):
        self.path, self.header, self.width = path, header, width

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition):
        for row in read_rows(self.path)[self.header :]:
            yield (*row, *[None] * (self.width - len(row)))
