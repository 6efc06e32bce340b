"""First sheet of an .xlsx workbook as rows of text cells, with the standard library only.

Runs inside Spark tasks, one workbook at a time; the format itself ends a sheet at 1,048,576 rows.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Fixed values of the file format: built-in number formats that show a date.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), 45, 46, 47, *range(50, 59)}


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ET.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in root.iter(f"{_MAIN}si")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that show a number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ET.fromstring(book.read("xl/styles.xml"))
    dated = set(_DATE_FORMATS)
    for fmt in root.iter(f"{_MAIN}numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", fmt.get("formatCode", ""))
        if re.search(r"[dmyhs]", code, re.IGNORECASE) and "general" not in code.lower():
            dated.add(int(fmt.get("numFmtId")))
    styles = root.find(f"{_MAIN}cellXfs")
    cells = [] if styles is None else list(styles)
    return {i for i, xf in enumerate(cells) if int(xf.get("numFmtId", "0")) in dated}


def _first_sheet(book: zipfile.ZipFile) -> str:
    workbook = ET.fromstring(book.read("xl/workbook.xml"))
    sheet = next(workbook.iter(f"{_MAIN}sheet"))
    links = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in links if r.get("Id") == sheet.get(f"{_REL}id"))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _column(reference: str) -> int:
    index = 0
    for ch in reference:
        if not ch.isalpha():
            break
        index = index * 26 + ord(ch.upper()) - 64
    return index - 1


def _epoch(book: zipfile.ZipFile) -> datetime:
    props = ET.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}workbookPr")
    from_1904 = props is not None and props.get("date1904") in ("1", "true")
    return datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)


def sheet_rows(content: bytes) -> Iterator[tuple[list[str | None], list[str | None]]]:
    """Per sheet row, in order: the cells as text, and the cells that are dates as ISO days."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, dated, epoch = _shared_strings(book), _date_styles(book), _epoch(book)
        held_back, expected = 0, 1
        with book.open(_first_sheet(book)) as sheet:
            for _, row in ET.iterparse(sheet):
                if row.tag != f"{_MAIN}row":
                    continue
                number = int(row.get("r", expected))
                held_back += number - expected
                expected = number + 1
                texts: list[str | None] = []
                days: list[str | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    at = _column(cell.get("r", "")) if cell.get("r") else len(texts)
                    while len(texts) <= at:
                        texts.append(None)
                        days.append(None)
                    kind, raw = cell.get("t", "n"), cell.find(f"{_MAIN}v")
                    value = None if raw is None else raw.text
                    if kind == "inlineStr":
                        value = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                    elif value is None:
                        continue
                    elif kind == "s":
                        value = strings[int(value)]
                    elif kind == "b":
                        value = "True" if value == "1" else "False"
                    elif kind == "e":
                        value = None
                    elif kind == "d":
                        days[at] = value[:10]
                    elif kind == "n" and int(cell.get("s", "0")) in dated:
                        days[at] = (epoch + timedelta(days=float(value))).strftime("%Y-%m-%d")
                    texts[at] = value
                row.clear()
                if any(t not in (None, "") for t in texts):
                    # Blank rows count between filled ones; trailing ones do not exist.
                    for _ in range(held_back):
                        yield [], []
                    held_back = 0
                    yield texts, days
                else:
                    held_back += 1
