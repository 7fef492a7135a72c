"""DOCX and XLSX files as rows, read with the standard library.

A file is one archive of XML parts; files come from ``binaryFile`` and are
parsed by a narrow Arrow function, so the scan is as parallel as the folder.
Files that cannot be read give one row with ``error`` and no other value.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.arrow import chunked

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Font sizes of heading styles, and the synthetic height of a line.
SIZES = {"1": 24.0, "2": 20.0, "3": 16.0, "4": 14.0}
LINE = 20.0

_DOCX = pa.schema([("path", pa.string()), ("seq", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("style", pa.string()), ("font_size", pa.float64()), ("is_bold", pa.bool_()), ("cells", pa.list_(pa.list_(pa.string()))), ("y0", pa.float64()), ("y1", pa.float64()), ("error", pa.string())])
DOCX = "path string, seq int, kind string, text string, style string, font_size double, is_bold boolean, cells array<array<string>>, y0 double, y1 double, error string"
_XLSX = pa.schema([("path", pa.string()), ("sheet", pa.string()), ("sheet_no", pa.int32()), ("row", pa.int32()), ("col", pa.int32()), ("value", pa.string()), ("formula", pa.string()), ("error", pa.string())])
XLSX = "path string, sheet string, sheet_no int, row int, col int, value string, formula string, error string"


def files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path and content of the files of a folder and its subfolders that match a name pattern (SRC-12, SRC-14)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "content")


def _text(e) -> str:
    return "".join("\t" if t.tag == f"{_W}tab" else "\n" if t.tag == f"{_W}br" else t.text or "" for t in e.iter() if t.tag in (f"{_W}t", f"{_W}tab", f"{_W}br"))


def docx_rows(path: str, content: bytes) -> list[tuple]:
    """Paragraphs and tables of one file in body order, y growing by a line each."""
    try:
        body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{_W}body")
        out, y, seq = [], 0.0, 0
        for e in body if body is not None else []:
            if e.tag == f"{_W}p":
                text = _text(e)
                style = next((s.get(f"{_W}val") or "" for s in e.iter(f"{_W}pStyle")), "")
                level = re.search(r"(?:Heading|Заголовок|heading)\s*(\d)", style)
                bold = any(b.get(f"{_W}val", "1") not in ("0", "false") for r in e.iter(f"{_W}r") for b in r.iter(f"{_W}b"))
                if text.strip():
                    out.append((path, seq, "heading" if level else "paragraph", text, style, SIZES.get(level[1], 12.0) if level else 12.0, bold, None, y, y + LINE, None))
                    seq += 1
                y += LINE
            elif e.tag == f"{_W}tbl":
                rows = [[" ".join(_text(c).replace("\xa0", " ").split()) for c in r.findall(f"{_W}tc")] for r in e.findall(f"{_W}tr")]
                out.append((path, seq, "table", None, None, None, None, rows, y, y + LINE * (len(rows) + 1), None))
                seq += 1
                y += LINE * (len(rows) + 1)
        return out
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
        return [(path, *[None] * 9, type(e).__name__)]


def xlsx_rows(path: str, content: bytes) -> list[tuple]:
    """Filled cells of all sheets of one file, as text, with their formulas."""
    try:
        z = zipfile.ZipFile(io.BytesIO(content))
        strings = ["".join(t.text or "" for t in s.iter(f"{_S}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for n, s in enumerate(ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_S}sheet")):
            part = targets[s.get(_R)].lstrip("/")
            for c in ElementTree.fromstring(z.read(part if part.startswith("xl/") else f"xl/{part}")).iter(f"{_S}c"):
                v, f = c.find(f"{_S}v"), c.find(f"{_S}f")
                text = strings[int(v.text)] if c.get("t") == "s" and v is not None else "".join(t.text or "" for t in c.iter(f"{_S}t")) if c.get("t") == "inlineStr" else v.text if v is not None else None
                letters, row = re.match(r"([A-Z]+)(\d+)", c.get("r")).groups()
                col = 0
                for x in letters:
                    col = col * 26 + ord(x) - 64
                if text is not None or f is not None:
                    out.append((path, s.get("name"), n, int(row) - 1, col - 1, text, "=" + (f.text or "") if f is not None else None, None))
        return out
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
        return [(path, *[None] * 6, type(e).__name__)]


def _parsed(df: DataFrame, rows: Callable, schema: pa.Schema, ddl: str) -> DataFrame:
    def one(batch: pa.RecordBatch) -> dict[str, list]:
        got = [r for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in rows(p, c or b"")]
        return dict(zip(schema.names, map(list, zip(*got)))) if got else {}

    return df.select("path", "content").mapInArrow(chunked(one, schema, 4), ddl)


def docx(df: DataFrame) -> DataFrame:
    """Body rows of DOCX files given as path and content (SRC-09, SRC-17, SRC-33)."""
    return _parsed(df, docx_rows, _DOCX, DOCX)


def xlsx(df: DataFrame) -> DataFrame:
    """Cell rows of XLSX files given as path and content (SRC-10, SRC-32)."""
    return _parsed(df, xlsx_rows, _XLSX, XLSX)


def formulas(cells: DataFrame) -> DataFrame:
    """Formulas of each sheet (SRC-11)."""
    return cells.where(F.coalesce("formula", F.col("value")).startswith("=")).select("path", "sheet", "row", "col", F.coalesce("formula", "value").alias("formula"))


def sheet_records(cells: DataFrame) -> DataFrame:
    """path, sheet, row, fields of rows below each sheet's header; rows without a value in the first column are left out (SRC-15)."""
    head = cells.where("row = 0").select("path", "sheet", "col", F.col("value").alias("name"))
    rows = cells.where("row > 0").join(head, ["path", "sheet", "col"])
    first = rows.where("col = 0").select("path", "sheet", "row")
    return rows.join(first, ["path", "sheet", "row"], "left_semi").groupBy("path", "sheet", "row").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("fields"))


def key_values(body: DataFrame, most_tables: int = 10) -> DataFrame:
    """path, key, value of the first tables with two to four columns; the first value of five signs per key (SRC-16)."""
    from pyspark.sql import Window

    t = body.where("kind = 'table'").withColumn("n", F.row_number().over(Window.partitionBy("path").orderBy("seq"))).where(F.col("n") <= most_tables)
    r = t.select("path", "seq", F.posexplode("cells").alias("row", "r")).where("size(r) between 2 and 4")
    kv = r.select("path", F.struct("seq", "row").alias("at"), F.lower(F.trim(F.get("r", F.lit(0)))).alias("key"), F.trim(F.get("r", F.lit(1))).alias("value")).where("key != '' and length(value) >= 5")
    return kv.groupBy("path", "key").agg(F.min_by("value", "at").alias("value"))


def coco(spark: SparkSession, path: str) -> DataFrame:
    """Annotations of COCO files with their image and category (SRC-30)."""
    schema = "images array<struct<id:bigint,width:double,height:double,file_name:string>>, annotations array<struct<id:bigint,image_id:bigint,category_id:bigint,bbox:array<double>>>, categories array<struct<id:bigint,name:string>>"
    d = spark.read.schema(schema).option("multiLine", "true").json(path).withColumn("file", F.input_file_name())
    a = d.select("file", F.explode("annotations").alias("a")).select("file", "a.*")
    i = d.select("file", F.explode("images").alias("i")).select("file", F.col("i.id").alias("image_id"), "i.width", "i.height", "i.file_name")
    c = d.select("file", F.explode("categories").alias("c")).select("file", F.col("c.id").alias("category_id"), F.col("c.name").alias("category"))
    return a.join(i, ["file", "image_id"]).join(c, ["file", "category_id"])


# Display names of process elements.
ELEMENTS = {"manualTask": "Ручная задача", "userTask": "Пользовательская задача", "serviceTask": "Сервисная задача", "task": "Задача", "subProcess": "Подпроцесс", "exclusiveGateway": "Шлюз (XOR)", "parallelGateway": "Шлюз (AND)", "inclusiveGateway": "Шлюз (OR)", "startEvent": "Начало", "endEvent": "Завершение"}


def bpmn(df: DataFrame) -> DataFrame:
    """path, tag, id, name, label and section of the elements in process XML texts (SRC-31, SCL-36)."""
    tag = "|".join(ELEMENTS)
    found = F.regexp_extract_all("text", F.lit(rf"(<(?:\w+:)?(?:{tag})\b[^>]*>)"), F.lit(1))
    e = df.select("path", F.explode(found).alias("e"))
    part = lambda p: F.nullif(F.regexp_extract("e", p, 1), F.lit(""))
    e = e.select("path", part(r"<(?:\w+:)?(\w+)").alias("tag"), part(r'\bid="([^"]*)"').alias("id"), part(r'\bname="([^"]*)"').alias("name"))
    return e.withColumns({"label": F.element_at(F.create_map(*[F.lit(x) for kv in ELEMENTS.items() for x in kv]), F.col("tag")), "section": F.coalesce(F.nullif(section_of_name(F.col("name")), F.lit("")), section_of_id(F.col("id")))})


def section_of_id(c: Column) -> Column:
    """The section number in an element id: one group as it is, of several the first with its figures parted."""
    parts = F.filter(F.array(*[F.regexp_extract(c, r"(?:Task|SubProcess)_(\d+)_?(\d*)_?(\d*)", n) for n in (1, 2, 3)]), lambda x: x != "")
    first = F.get(parts, F.lit(0))
    return F.when(F.size(parts) == 0, "").when(F.size(parts) == 1, first).when(F.length(first) <= 3, F.array_join(F.split(first, "(?<=.)(?=.)"), ".")).otherwise("")


def section_of_name(c: Column) -> Column:
    """The section number at the start of an element name."""
    return F.regexp_extract(c, r"^(\d+(?:\.\d+)*)", 1)
