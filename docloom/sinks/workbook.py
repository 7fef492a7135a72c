"""XLSX workbooks as binary columns.

Rows of one workbook are cut into files of at most ``rows`` rows, so that no
workbook of a large group is built in one task.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006"


def column_letters(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def sheet_name(name: str, used: set[str]) -> str:
    """A name that a sheet may bear: no forbidden signs, at most 31 of them, and not one in use."""
    base = re.sub(r"[\[\]:*?/\\]", "_", name or "").strip()[:31] or "Sheet"
    out, n = base, 2
    while out.lower() in used:
        out = f"{base[: 31 - len(str(n)) - 1]}_{n}"
        n += 1
    used.add(out.lower())
    return out


def build(sheets: list[tuple[str, list[list]]]) -> bytes:
    """One workbook; numbers as numbers, other values as text, null cells left out, control signs dropped."""
    buffer, used = io.BytesIO(), set()
    names = [sheet_name(n, used) for n, _ in sheets]
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(len(sheets)))
        z.writestr("[Content_Types].xml", f'<?xml version="1.0" encoding="UTF-8"?><Types xmlns="{_PKG}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_PKG}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_PKG}/relationships">' + "".join(f'<Relationship Id="rId{k + 1}" Type="{_REL}/worksheet" Target="worksheets/sheet{k + 1}.xml"/>' for k in range(len(sheets))) + "</Relationships>")
        listed = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{k + 1}" r:id="rId{k + 1}"/>' for k, n in enumerate(names))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_NS}" xmlns:r="{_REL}"><sheets>{listed}</sheets></workbook>')
        for k, (_, rows) in enumerate(sheets):
            body = []
            for r, row in enumerate(rows):
                cells = []
                for c, v in enumerate(row):
                    at = f"{column_letters(c)}{r + 1}"
                    if v is None:
                        continue
                    if isinstance(v, (int, float)) and not isinstance(v, bool):
                        cells.append(f'<c r="{at}"><v>{v}</v></c>')
                    else:
                        text = escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "", str(v)))
                        cells.append(f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>')
                body.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{k + 1}.xml", f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_NS}"><sheetData>{"".join(body)}</sheetData></worksheet>')
    return buffer.getvalue()


def workbooks(df: DataFrame, name: str, order: str, columns: list[str], rows: int = 50_000) -> DataFrame:
    """path, content: workbooks of the rows of each ``name``, header first, as many files as ``rows`` demands."""
    import pandas as pd

    spread = df.withColumn("__part", F.floor(F.col(order) / rows).cast("bigint"))

    def one(key, pdf):
        pdf = pdf.sort_values(order, kind="stable")
        data = [columns] + [[None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in r] for r in pdf[columns].itertuples(index=False, name=None)]
        return pd.DataFrame({"path": [f"{key[0]}-{key[1]}.xlsx"], "content": [build([(str(key[0]), data)])]})

    return spread.select(name, "__part", order, *[c for c in columns if c not in (name, order)]).groupBy(name, "__part").applyInPandas(one, "path string, content binary")
