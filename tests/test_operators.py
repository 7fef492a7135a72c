"""Operators on small tables with results worked out by hand."""

import random

from pyspark.sql import functions as F

from docloom.operators import blocks, boxes, graphs, lines, matrices, nested, ordered, records, sections
from docloom.plans import catalog
from docloom.sinks import workbook
from docloom.sources import office


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_repeats_are_over_half_of_the_pages(spark):
    data = [("d", p, x) for p, x in ((1, "a"), (2, "a"), (1, "b"), (2, "B "), (3, "b"), (4, "c"), (None, "b"))]
    got = lines.repeated(spark.createDataFrame(data, "doc_id string, page int, line string"))
    assert rows(got, "line", "n_pages", "pages") == [("b", 3, 4)]


def test_empty_tables_give_empty_results(spark):
    empty = spark.createDataFrame([], "doc_id string, page int, line string, line_no int")
    assert lines.repeated(empty).count() == 0 and lines.cleaned(empty, "doc_id").count() == 0


def test_running_values_cross_chunks(spark):
    random.seed(1)
    data = [(f"d{random.randrange(3)}" if random.random() > 0.1 else None, n // 4, n, random.choice([None, 1, 2, 3])) for n in range(80)]
    df = spark.createDataFrame(data, "doc string, chunk int, n int, v int")
    df = ordered.last_known(df, "doc", "chunk", ["n"], F.col("v"), "last")
    df = ordered.next_known(df, "doc", "chunk", ["n"], F.col("v"), "next")
    df = ordered.before(df, "doc", "chunk", ["n"], F.col("v"), "prev")
    df = ordered.running_sum(df, "doc", "chunk", ["n"], F.col("v"), "total")
    got = df.collect()
    assert len(got) == 80
    for r in got:
        own = [x for x in data if x[0] == r["doc"]]
        up = [x[3] for x in own if x[2] <= r["n"]]
        assert r["last"] == next((v for v in reversed(up) if v is not None), None)
        assert r["next"] == next((x[3] for x in own if x[2] > r["n"] and x[3] is not None), None)
        assert r["prev"] == (up[-2] if len(up) > 1 else None)
        assert r["total"] == sum(v or 0 for v in up)


def test_tree_parents(spark):
    heads = [("d", n, t) for n, t in enumerate(["# 1 А", "## 1.1 Б", "### 1.1.1 В", "## 1.2 Г", "### 1.2.1 Д", "## 1.1 Е"])]
    t = sections.tree(sections.headings(spark.createDataFrame(heads, "k string, line_no int, line string"), "k"), "k")
    assert rows(t, "pos", "id", "parent_id") == [(1, "1", None), (2, "1.1", "1"), (3, "1.1.1", "1.1"), (4, "1.2", "1"), (5, "1.2.1", "1.2")]
    assert rows(sections.paths(t, "k"), "id", "path")[2] == ("1.1.1", [1, 2, 3])


def test_fill_down(spark):
    data = [("t", n, 0, v) for n, v in enumerate(["H", "a", None, "", None])]
    got = matrices.filled_down(spark.createDataFrame(data, "table_id string, row int, col int, value string"), "table_id")
    assert [v for _, v in rows(got, "row", "value")] == ["H", "a", "a", "", "a"]


def test_record_machine(spark):
    events = [("START", None), ("PERSONAL", "a1"), ("PERSONAL", "a2"), ("QUANTITY", "5"), ("PERSONAL", "x"), ("START", None), ("QUANTITY", "7"), ("START", None)]
    df = spark.createDataFrame([("d", 1 + n // 3, n, k, v) for n, (k, v) in enumerate(events)], "doc string, page int, seq int, kind string, value string")
    got = records.state_machine(df, "doc", "page", ["page", "seq"])
    assert rows(got, "record", "address", "quantity", "complete") == [(1, "a2", 5, True), (2, None, 7, False), (3, None, None, False)]


def test_asof(spark):
    m = spark.createDataFrame([("d", 100, "o1"), ("d", 300, "o2")], "doc string, pos int, owner string")
    t = spark.createDataFrame([("d", 50, 1), ("d", 350, 2)], "doc string, pos int, qty int")
    assert rows(records.asof(m, t), "pos", "qty", "how") == [(100, 1, "backward"), (300, 2, "forward")]
    m = spark.createDataFrame([("d", 100, "o1"), ("d", 200, "o2")], "doc string, pos int, owner string")
    t = spark.createDataFrame([("d", 250, 9)], "doc string, pos int, qty int")
    assert rows(records.asof(m, t), "pos", "qty_next") == [(100, 9), (200, 9)]


def test_validation(spark):
    df = spark.createDataFrame([("addr", 5), (None, 5), ("addr", 0)], "address string, quantity bigint")
    assert rows(records.validation(df), "total", "valid", "invalid", "quantity", "missing_address", "missing_quantity") == [(3, 1, 2, 5, 1, 1)]


def test_zip(spark):
    m = spark.createDataFrame([("d", 1), ("d", 2), ("d", 3)], "doc string, pos int")
    t = spark.createDataFrame([("d", 5, 10), ("d", 6, 20)], "doc string, pos int, value int")
    assert rows(records.zipped(m, t, "doc", "pos"), "pos", "right_value") == [(1, 10), (2, 20), (3, None)]


def test_columns_and_clusters():
    assert boxes.cluster([[0, 0, 10, 10], [25, 0, 30, 10], [200, 0, 210, 10], [40, 0, 45, 10]]) == [0, 0, 1, 0]
    assert [x["text"] for x in boxes.token_lines([("b", 50, 0, 60, 10), ("a", 0, 2, 10, 12), ("c", 0, 40, 9, 50)])] == ["a b", "c"]


def test_overlap_against_all_pairs(spark):
    random.seed(2)
    data = [("d", n % 2, n, (x := random.uniform(0, 600), y := random.uniform(0, 800), x + random.uniform(0, 300), y + random.uniform(0, 300))) for n in range(60)]
    df = spark.createDataFrame([(d, p, n, b) for d, p, n, b in data], "doc_id string, page int, id bigint, bbox struct<x0:double,y0:double,x1:double,y1:double>")
    got = {(r["left_id"], r["right_id"]) for r in boxes.overlapping(df, df).collect()}
    want = {(a[2], b[2]) for a in data for b in data if a[2] != b[2] and a[1] == b[1] and min(a[3][2], b[3][2]) > max(a[3][0], b[3][0]) and min(a[3][3], b[3][3]) > max(a[3][1], b[3][1])}
    assert got == want


def test_pruning(spark):
    node = spark.createDataFrame([("doc_A_01", "document"), ("doc_A_02", "document"), ("doc_B_01", "document"), ("r", "root")], "id string, node_type string")
    edge = spark.createDataFrame([("doc_B_01", "r")], "source string, target string")
    latest = spark.createDataFrame([("A-02",)], "code string")
    assert rows(graphs.without_orphans(node, edge, latest), "id") == [("doc_A_02",), ("doc_B_01",), ("r",)]


def test_nested_objects_keep_every_field():
    xml = '<V><TBODY><R6 a="1"><Table6 nRec="2"><Rec RecID="7"><Addr><City>A</City></Addr><F>1</F></Rec><Rec><F>1</F><TableX><Rec RecID="9"/></TableX></Rec></Table6></R6></TBODY></V>'
    found = nested.parse(1, xml)
    by = {r[3]: r for r in found}
    assert by["R6/Table6[1]/Rec[1]/Addr"][11] == [("City", "A")] and by["R6/Table6[1]"][10] == [("nRec", "2")]
    assert by["R6/Table6[1]/Rec[2]/TableX[1]/Rec[1]"][4] == "R6/Table6[1]/Rec[2]" and by["R6/Table6[1]/Rec[1]"][4] == "R6"
    assert nested.parse(1, xml[:-9]) == [] and nested.parse(1, "") == []
    assert nested.decode("Тест".encode("cp1251")) == "Тест"
    same = nested.parse(1, "<V><TBODY><R><Rec><F>1</F></Rec><Rec><F>1</F></Rec></R></TBODY></V>")
    assert len({r[9] for r in same if r[2] == "record"}) == 1


def test_workbook_round_trip(spark):
    data = [["id", "text"], [1, "a<b & «я»"], [2, None], [3, "=1+1"]]
    book = spark.createDataFrame([("b.xlsx", bytearray(workbook.build([("Лист/1", data)]))), ("bad.xlsx", bytearray(b"x"))], "path string, content binary")
    cells = office.xlsx(book)
    assert rows(cells.where("row = 1"), "col", "value") == [(0, "1"), (1, "a<b & «я»")]
    assert cells.where("error is not null").count() == 1
    assert rows(office.formulas(cells), "formula") == [("=1+1",)]


def test_docx(spark):
    import io
    import zipfile

    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    xml = f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:rPr><w:b/></w:rPr><w:t>Цель</w:t></w:r></w:p><w:p/><w:tbl><w:tr><w:tc><w:p><w:r><w:t>Разработчик</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>Отдел закупок</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", xml)
    body = office.docx(spark.createDataFrame([("a.docx", bytearray(buffer.getvalue()))], "path string, content binary"))
    assert rows(body, "seq", "kind", "font_size", "y0", "y1") == [(0, "heading", 24.0, 0.0, 20.0), (1, "table", None, 40.0, 80.0)]
    assert rows(office.key_values(body), "key", "value") == [("разработчик", "Отдел закупок")]


def test_bpmn_and_coco(spark, tmp_path):
    x = spark.createDataFrame([("p", '<bpmn:userTask id="Task_51_X" name="5.1.1 Проверка"/><task id="SubProcess_5_P"/>')], "path string, text string")
    assert rows(office.bpmn(x), "tag", "section") == [("task", "5"), ("userTask", "5.1.1")]
    (tmp_path / "c.json").write_text('{"images":[{"id":1,"width":10,"height":20,"file_name":"a"}],"categories":[{"id":3,"name":"t"}],"annotations":[{"id":1,"image_id":1,"category_id":3,"bbox":[1,2,3,4]}]}')
    assert rows(office.coco(spark, str(tmp_path / "c.json")), "file_name", "category") == [("a", "t")]


def test_block_routes(spark):
    m = spark.createDataFrame([(False, "single_column", 0.0, 0, 0, 0), (True, "newspaper", 0.0, 0, 0, 0), (True, "single_column", 0.5, 1, 0, 0), (True, "single_column", 0.0, 0, 0, 5)], "has_text boolean, layout string, coverage double, n_images int, n_drawings int, density int")
    assert [r["rule"] for r in blocks.routed(m).collect()] == [1, 2, 5, 7]


def test_every_statement_has_its_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
