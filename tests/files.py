"""Statement files for tests."""

import os
import zipfile
from xml.sax.saxutils import escape


def write_text(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def _cell(column, row, value):
    ref = f"{chr(65 + column)}{row}"
    if value is None:
        return ""
    if isinstance(value, tuple):  # a day number shown as a date
        return f'<c r="{ref}" s="1"><v>{value[0]}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'


def write_xlsx(path, rows):
    """Cells: text, number, None, or (day number,) for a date cell."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    body = "".join(
        f'<row r="{i}">' + "".join(_cell(j, i, v) for j, v in enumerate(row)) + "</row>"
        for i, row in enumerate(rows, 1) if row
    )
    parts = {
        "xl/workbook.xml": f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="t" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>",
    }
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + text)
