"""Workbooks (.xlsx) of small tables, written and read without another library.

A sheet has a bold, frozen header; columns may have number formats, widths and a colour
scale, and the last row may be a total.  Texts are written in place.
"""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKED = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGED = "http://schemas.openxmlformats.org/package/2006"
HEADER = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
# Number formats and the colours of a scale from low to high.
PERCENT, WHOLE, HUNDREDTHS = '0.0" %"', "#,##0", "#,##0.00"
SCALE = ((0, "FFF8696B"), (50, "FFFFEB84"), (100, "FF63BE7B"))


@dataclass
class Sheet:
    columns: Sequence[str]
    rows: Sequence[Sequence]
    formats: Mapping[str, str] = field(default_factory=dict)
    widths: Mapping[str, int] = field(default_factory=dict)
    scaled: Sequence[str] = ()  # columns with a colour scale from 0 to 100
    total: bool = False


def letters(index: int) -> str:
    """Column letters of an index from 0."""
    out = ""
    index += 1
    while index:
        index, r = divmod(index - 1, 26)
        out = chr(65 + r) + out
    return out


def _cell(place: str, value, style: int) -> str:
    if value is None or value != value:
        return f'<c r="{place}" s="{style}"/>'
    if isinstance(value, bool):
        return f'<c r="{place}" s="{style}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return f'<c r="{place}" s="{style}"><v>{value}</v></c>'
    text = escape(re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", value.isoformat() if isinstance(value, (datetime.date, datetime.datetime)) else str(value)))
    return f'<c r="{place}" s="{style}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def _sheet(s: Sheet, formats: list[str]) -> str:
    style = lambda c, bold: 2 * (formats.index(s.formats[c]) + 1 if c in s.formats else 0) + bold
    header = 2 * (len(formats) + 1)
    lines = ['<row r="1">' + "".join(_cell(f"{letters(i)}1", c, header) for i, c in enumerate(s.columns)) + "</row>"]
    for n, row in enumerate(s.rows, 2):
        last = s.total and n == len(s.rows) + 1
        lines.append(f'<row r="{n}">' + "".join(_cell(f"{letters(i)}{n}", v, style(c, last)) for i, (c, v) in enumerate(zip(s.columns, row))) + "</row>")
    cols = "".join(f'<col min="{i}" max="{i}" width="{s.widths.get(c, max(12, len(c) + 2))}" customWidth="1"/>' for i, c in enumerate(s.columns, 1))
    scales = ""
    for k, c in enumerate(s.scaled, 1):
        at = letters(list(s.columns).index(c))
        marks = "".join(f'<cfvo type="num" val="{v}"/>' for v, _ in SCALE) + "".join(f'<color rgb="{rgb}"/>' for _, rgb in SCALE)
        scales += f'<conditionalFormatting sqref="{at}2:{at}{len(s.rows) + 1}"><cfRule type="colorScale" priority="{k}"><colorScale>{marks}</colorScale></cfRule></conditionalFormatting>'
    pane = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
    return f'{HEADER}<worksheet xmlns="{MAIN}">{pane}<cols>{cols}</cols><sheetData>{"".join(lines)}</sheetData>{scales}</worksheet>'


def _styles(formats: list[str]) -> str:
    numbers = "".join(f'<numFmt numFmtId="{164 + i}" formatCode="{escape(f, {chr(34): "&quot;"})}"/>' for i, f in enumerate(formats))
    pairs = "".join(f'<xf numFmtId="{n}" fontId="{b}" fillId="0" borderId="{b}" applyNumberFormat="1" applyFont="1"/>' for n in (0, *range(164, 164 + len(formats))) for b in (0, 1))
    return (
        f'{HEADER}<styleSheet xmlns="{MAIN}">' + (f'<numFmts count="{len(formats)}">{numbers}</numFmts>' if formats else "")
        + '<fonts count="2"><font/><font><b/></font></fonts><fills count="3"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>'
        + '<fill><patternFill patternType="solid"><fgColor rgb="FFD9D9D9"/></patternFill></fill></fills><borders count="2"><border/><border><top style="medium"/></border></borders>'
        + f'<cellXfs count="{2 * len(formats) + 3}">{pairs}<xf numFmtId="0" fontId="1" fillId="2" borderId="0" applyFont="1" applyFill="1"/></cellXfs></styleSheet>'
    )


def to_bytes(sheets: Mapping[str, Sheet]) -> bytes:
    """The workbook; sheet names are cut to 31 characters, as its format asks."""
    formats = sorted({f for s in sheets.values() for f in s.formats.values()})
    kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
    listed = "".join(f'<sheet name="{escape(n[:31], {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
    joined = "".join(f'<Relationship Id="rId{i}" Type="{LINKED}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'{HEADER}<Types xmlns="{PACKAGED}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'{HEADER}<Relationships xmlns="{PACKAGED}/relationships"><Relationship Id="rId1" Type="{LINKED}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{HEADER}<workbook xmlns="{MAIN}" xmlns:r="{LINKED}"><sheets>{listed}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{HEADER}<Relationships xmlns="{PACKAGED}/relationships">{joined}<Relationship Id="styles" Type="{LINKED}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", _styles(formats))
        for i, s in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", _sheet(s, formats))
    return out.getvalue()


def read(data: bytes, sheet: str | int = 0) -> list[list]:
    """Rows of a sheet, by name or place: texts, numbers, truth values, None where a cell is empty."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        book = ET.fromstring(z.read("xl/workbook.xml"))
        names = {s.get("name"): s.get(f"{{{LINKED}}}id") for s in book.iter(f"{{{MAIN}}}sheet")}
        wanted = names[sheet] if isinstance(sheet, str) else list(names.values())[sheet]
        target = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}[wanted]
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{MAIN}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{{{MAIN}}}si")]
        root = ET.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    rows = []
    for row in root.iter(f"{{{MAIN}}}row"):
        cells: list = []
        for c in row:
            place = re.match("[A-Z]+", c.get("r") or "")
            at = 0
            for x in place[0] if place else letters(len(cells)):
                at = at * 26 + ord(x) - 64
            cells += [None] * (at - len(cells))
            v, kind = c.findtext(f"{{{MAIN}}}v"), c.get("t")
            if kind == "inlineStr":
                cells[at - 1] = "".join(t.text or "" for t in c.iter(f"{{{MAIN}}}t"))
            elif v is not None:
                cells[at - 1] = shared[int(v)] if kind == "s" else v == "1" if kind == "b" else v if kind in ("str", "e") else float(v) if re.search("[.eE]", v) else int(v)
        rows.append(cells)
    width = max(map(len, rows), default=0)
    return [r + [None] * (width - len(r)) for r in rows]
