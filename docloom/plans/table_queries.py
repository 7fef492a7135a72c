"""Queries over tables in pages and parsed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import matrices as X
from docloom.operators import ordered
from docloom.plans import oracle as O
from docloom.plans.line_queries import markdown_lines, page_lines, pages
from docloom.sinks import markdown as M

# Kinds of tables by the words they hold, and display names of fields.
KINDS = {"register": ("реестр", "владел"), "control": ("ведомость",), "schedule": ("график",)}
NAMES = {"Bank": "Банк", "Pasport": "Паспорт сделки", "Date": "Дата", "RepType": "Вид отчёта"}


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table of every page (SRC-06)."""
    t = pages(spark, sf_dir, "tables").select("content_id", F.posexplode("tables").alias("k", "matrix"))
    return t.select(F.concat_ws("-", "content_id", "k").alias("table_id"), "content_id", "k", "matrix")


def table_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables as Markdown and HTML, with their validity (SCL-03, SCL-04, SCL-05, FLT-10)."""
    return tables(spark, sf_dir).select("table_id", F.size("matrix").alias("n_rows"), M.table(F.col("matrix")).alias("markdown"), M.html(F.col("matrix")).alias("html"), X.valid(F.col("matrix")).alias("valid"))


def data_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that hold data (FLT-11)."""
    return tables(spark, sf_dir).select("table_id", F.posexplode("matrix").alias("row", "r")).select("table_id", "row", X.is_data_row(F.col("r")).alias("data"))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the Markdown tables of all pages and documents, one table per run of table lines."""
    rows = markdown_lines(spark, sf_dir).where("line like '|%' and not line rlike '^[|\\\\s:-]+$'").withColumn("g", F.floor(F.col("line_no") / 256))
    rows = ordered.before(rows, "result_id", "g", ["line_no"], F.col("line_no"), "last")
    rows = ordered.running_sum(rows, "result_id", "g", ["line_no"], F.coalesce(F.col("line_no") - F.col("last") > 2, F.lit(True)), "t")
    w = Window.partitionBy("result_id", "t").orderBy("line_no")
    rows = rows.select(F.concat_ws("-", "result_id", "t").alias("table_id"), (F.row_number().over(w) - 1).alias("row"), X.pipe_cells(F.col("line")).alias("cells"))
    return rows


def markdown_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of Markdown tables as wide as their header, in tables of three lines and more with the rule (SRC-22)."""
    r = _cells(spark, sf_dir)
    head = r.where("row = 0").select("table_id", F.size("cells").alias("width"))
    n = r.groupBy("table_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    return r.join(head, "table_id").join(n, "table_id").where("size(cells) = width").select("table_id", "row", F.array_join("cells", "|").alias("cells"))


def filled_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with merged ones filled from above; every third cell of a row is taken as merged (WIN-11)."""
    c = _cells(spark, sf_dir).select("table_id", "row", F.posexplode("cells").alias("col", "value"))
    c = c.withColumn("value", F.when((F.col("row") > 0) & ((F.col("row") + F.col("col")) % 3 == 0), F.lit(None)).otherwise(F.col("value")))
    return X.filled_down(c, "table_id")


def collapsed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two header rows of every table as one (AGG-19)."""
    return X.collapsed_header(_cells(spark, sf_dir).select("table_id", "row", F.posexplode("cells").alias("col", "value")), "table_id")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a number in front of every second one, and the same number on neighbours."""
    r = _cells(spark, sf_dir)
    n = F.when(F.col("row") % 2 == 1, (F.floor(F.col("row") / 4) + 1).cast("string")).otherwise("")
    return r.select("table_id", "row", F.concat(F.array(n), F.col("cells")).alias("cells"))


def numbered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the record number before them (WIN-02), continued rows merged (AGG-11)."""
    return X.merged(X.numbered_records(_numbered(spark, sf_dir), "table_id"), "table_id")


def sequential_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by record, the same number again opening none (WIN-03)."""
    return X.numbered_records(_numbered(spark, sf_dir), "table_id", repeats_open=False).select("table_id", "row", "number", "record")


def shifted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an empty second column moved left (SCL-43)."""
    r = _numbered(spark, sf_dir).select("table_id", "row", F.concat(F.slice("cells", 1, 1), F.array(F.lit("")), F.slice("cells", 2, 100)).alias("cells"))
    return r.select("table_id", "row", F.array_join(X.shifted(F.col("cells"), 100), "|", "~").alias("cells"))


def table_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table lines with the heading last seen before them, and how many each section has (WIN-19, AGG-12)."""
    l = markdown_lines(spark, sf_dir).withColumn("g", F.floor(F.col("line_no") / 256))
    head = F.nullif(F.regexp_extract("line", r"^#{1,6}\s+(.+?)\s*$", 1), F.lit(""))
    l = ordered.last_known(l, "result_id", "g", ["line_no"], head, "section").where("line like '|%'")
    return l.groupBy("result_id", F.coalesce("section", F.lit("Раздел I")).alias("section")).agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.size(X.pipe_cells(F.col("line")))).alias("max_cols"))


def table_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind of every table by its words (FLT-24)."""
    t = tables(spark, sf_dir)
    return t.select("table_id", X.table_kind(F.array_join(F.flatten("matrix"), " "), KINDS).alias("kind"))


def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First cell and the rest of every row of HTML tables, as read back from the tables' HTML (SCL-26)."""
    t = tables(spark, sf_dir).where("size(matrix) > 0").select("table_id", F.posexplode(X.html_rows(M.html(F.col("matrix")))).alias("row", "r"))
    return t.where("size(r) > 0").select("table_id", "row", F.element_at("r", 1).alias("name"), F.array_join(F.slice("r", 2, 100), "|").alias("rest"))


def doubled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page lines that repeat a cell or a row of a table of the page (JOIN-23)."""
    cells = pages(spark, sf_dir, "tables").select("content_id", F.explode("tables").alias("m")).select("content_id", F.explode("m").alias("r"))
    each = cells.select("content_id", F.explode(F.array_append(F.transform("r", lambda c: T.squeeze(c)), F.array_join(F.transform("r", lambda c: T.squeeze(c)), " "))).alias("norm")).where("norm != ''").distinct()
    l = page_lines(spark, sf_dir).where("length(line) <= 120").withColumn("norm", T.squeeze(F.col("line")))
    return l.join(each, ["content_id", "norm"], "left_semi").select("content_id", "line_no")


def section_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of each document that names a section, and the first where the table's width is nearer the other's (WIN-20, FLT-22)."""
    p = pages(spark, sf_dir, "doc_id", "page_num", "text", "tables")
    width = F.array_max(F.transform(F.flatten("tables"), lambda r: F.size(r)))
    return p.groupBy("doc_id").agg(F.min(F.when(F.col("text").contains("Раздел") | F.col("text").contains("разд."), F.col("page_num"))).alias("start_page"), F.min(F.when(F.abs(width - 3) < F.abs(width - 2), F.col("page_num"))).alias("stop_page"))


def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display name of every header field of the statements, its code where none is known (JOIN-20)."""
    from docloom.plans.nested_queries import _flat

    f = _flat(spark, sf_dir).where("kind = 'THEADER'").select("statement_id", F.explode("fields").alias("code", "value"))
    return f.select("statement_id", "code", F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv]), F.col("code")), F.col("code")).alias("name"))


QUERIES = {f.__name__: f for f in (table_texts, data_rows, markdown_tables, filled_tables, collapsed_headers, numbered_records, sequential_records, shifted_rows, table_sections, table_kinds, html_tables, doubled_lines, section_pages, display_names)}

_TABLES = "select content_id || '-' || k as table_id, content_id, k, m as matrix from (select content_id, generate_subscripts(tables, 1) - 1 as k, unnest(tables) as m from pages)"
_CELL = "coalesce(nullif(" + O.strip("translate(replace(c, '|', '\\|'), chr(10) || chr(13), '  ')") + ", ''), ' ')"
_FULL = f"list_filter(matrix, lambda r: len(list_filter(r, lambda c: {O.strip('c')} != '')) > 0)"
_LINE = f"'| ' || array_to_string(list_concat(list_transform(r, lambda c: {_CELL}), list_transform(range(w - len(r)), lambda i: ' ')), ' | ') || ' |'"
_HTML = "case when len(matrix) > 0 then '<table><thead><tr>' || array_to_string(list_transform(matrix[1], lambda c: '<th>' || coalesce(c, '') || '</th>'), '') || '</tr></thead><tbody>' || array_to_string(list_transform(matrix[2:], lambda r: '<tr>' || array_to_string(list_transform(r, lambda c: '<td>' || coalesce(c, '') || '</td>'), '') || '</tr>'), '') || '</tbody></table>' else '' end"
_CHARS = f"list_transform(range(w), lambda k: list_sum(list_transform(matrix, lambda r: coalesce(length({O.strip('r[k + 1]')}), 0))))"
_SPLIT = "list_transform(string_split(regexp_replace(" + O.strip("line") + ", '^\\||\\|$', '', 'g'), '|'), lambda c: " + O.strip("c") + ")"
_MD = f"select result_id || '-' || t as table_id, row_number() over (partition by result_id, t order by line_no) - 1 as row, {_SPLIT} as cells from (select *, sum(case when last is null or line_no - last > 2 then 1 else 0 end) over (partition by result_id order by line_no) as t from (select *, lag(line_no) over (partition by result_id order by line_no) as last from markdown_lines where starts_with(line, '|') and not regexp_matches(line, '^[|\\s:-]+$')))"
_LONG = "select table_id, row, generate_subscripts(cells, 1) - 1 as col, unnest(cells) as value from md"
_NUMBERED = "select table_id, row, list_concat([case when row % 2 = 1 then cast(row // 4 + 1 as varchar) else '' end], cells) as cells from md"
_REC = "select * from (select *, first_value(n) over (partition by table_id, record order by row) as number from (select *, sum(case when {opens} then 1 else 0 end) over (partition by table_id order by row) as record from (select *, last_value(n ignore nulls) over (partition by table_id order by row rows between unbounded preceding and 1 preceding) as p from (select *, case when regexp_matches(cells[1], '^\\d{{1,4}}$') then cast(cells[1] as int) end as n from numbered))) where record > 0) qualify record = max(record) over (partition by table_id, number)"
_ROWS = "select table_id, generate_subscripts(matrix, 1) - 1 as row, unnest(matrix) as r from t"
_FIRST = O.strip("list_filter(r, lambda c: {} != '')[1]".format(O.strip("c")))

SQL = {
    "table_texts": O.sql(f"select table_id, n_rows, case when len(f) > 0 then array_to_string(list_concat([l[1], '| ' || array_to_string(list_transform(range(w), lambda i: '---'), ' | ') || ' |'], l[2:]), chr(10)) else '' end as markdown, {_HTML} as html, coalesce(len(matrix) >= 2 and w0 >= 2 and (list_sum(ch) = 0 or list_max(ch) <= list_sum(ch) * 0.85), false) as valid from (select *, list_transform(f, lambda r: {_LINE}) as l, {_CHARS.replace('range(w)', 'range(w0)')} as ch from (select *, len(matrix) as n_rows, {_FULL} as f, list_max(list_transform({_FULL}, lambda r: len(r))) as w, list_max(list_transform(matrix, lambda r: len(r))) as w0 from t))", "pages", t=_TABLES),
    "data_rows": O.sql(f"select table_id, row, coalesce(not starts_with(f, '№') and regexp_matches(f, '\\d') and (not contains(f, '№') or regexp_matches(f, '\\d{{1,2}}[./]\\d{{1,2}}[./]\\d{{2,4}}')), false) as data from (select table_id, row, {_FIRST} as f from r)", "pages", t=_TABLES, r=_ROWS),
    "markdown_tables": O.sql("select table_id, row, array_to_string(cells, '|') as cells from (select *, first_value(len(cells)) over (partition by table_id order by row) as width, count(*) over (partition by table_id) as n from md) where n >= 2 and len(cells) = width", "markdown_lines", md=_MD),
    "filled_tables": O.sql(f"select table_id, row, col, coalesce(value, last_value(case when {O.strip('value')} != '' then value end ignore nulls) over (partition by table_id, col order by row rows between unbounded preceding and 1 preceding)) as value from (select table_id, row, col, case when row > 0 and (row + col) % 3 = 0 then null else value end as value from long)", "markdown_lines", md=_MD, long=_LONG),
    "collapsed_headers": O.sql(f"select table_id, col, string_agg(v, ' / ' order by row) as header from (select table_id, col, row, {O.strip('value')} as v from long where row < 2 and {O.strip('value')} != '' qualify row_number() over (partition by table_id, col, lower({O.strip('value')}) order by row) = 1) group by 1, 2", "markdown_lines", md=_MD, long=_LONG),
    "numbered_records": O.sql("select table_id, number, string_agg(concat_ws('=', col, v), '; ' order by col) as cells from (select table_id, number, col, case when col between 4 and 9 then arg_min(v, row) else string_agg(v, ' ' order by row) end as v from (select table_id, number, row, col, case when s not in ('', 'None', 'nan') then s end as v from (select *, " + O.strip("value") + " as s from (select table_id, number, row, generate_subscripts(cells, 1) - 1 as col, unnest(cells) as value from rec))) where v is not null group by 1, 2, 3) group by 1, 2", "markdown_lines", md=_MD, numbered=_NUMBERED, rec=_REC.format(opens="n is not null")),
    "sequential_records": O.sql("select table_id, row, number, record from rec", "markdown_lines", md=_MD, numbered=_NUMBERED, rec=_REC.format(opens="n is not null and n is distinct from p")),
    "shifted_rows": O.sql("select table_id, row, array_to_string(list_transform(case when len(c) > 2 and regexp_matches(c[1], '^\\d{1,4}$') then list_concat([c[1]], c[3:], [null]) else c end, lambda x: coalesce(x, '~')), '|') as cells from (select table_id, row, list_concat([cells[1]], [''], cells[2:]) as c from numbered)", "markdown_lines", md=_MD, numbered=_NUMBERED),
    "table_sections": O.sql(f"select result_id, coalesce(s, 'Раздел I') as section, count(*) as n_rows, max(len({_SPLIT})) as max_cols from (select *, last_value(nullif(regexp_extract(line, '^#{{1,6}}\\s+(.+?)\\s*$', 1), '') ignore nulls) over (partition by result_id order by line_no rows between unbounded preceding and current row) as s from markdown_lines) where starts_with(line, '|') group by 1, 2", "markdown_lines"),
    "table_kinds": O.sql("select table_id, case " + " ".join(f"when {' and '.join(f'contains(x, {O.lit(w)})' for w in ws)} then '{k}'" for k, ws in KINDS.items()) + " else 'unknown' end as kind from (select table_id, lower(array_to_string(flatten(matrix), ' ')) as x from t)", "pages", t=_TABLES),
    "html_tables": O.sql(f"select table_id, row, coalesce({O.strip('r[1]')}, '') as name, coalesce(array_to_string(list_transform(r[2:], lambda c: coalesce({O.strip('c')}, '')), '|'), '') as rest from r where len(r) > 0", "pages", t=_TABLES, r=_ROWS),
    "doubled_lines": O.sql(f"select content_id, line_no from page_lines p where length(line) <= 120 and (content_id, {O.squeeze('line')}) in (select content_id, x from (select content_id, unnest(list_append(list_transform(r, lambda c: {O.squeeze('c')}), array_to_string(list_transform(r, lambda c: {O.squeeze('c')}), ' '))) as x from (select content_id, unnest(matrix) as r from t)) where x != '')", "page_lines", "pages", t=_TABLES),
    "section_pages": O.sql("select doc_id, min(case when contains(text, 'Раздел') or contains(text, 'разд.') then page_num end) as start_page, min(case when abs(w - 3) < abs(w - 2) then page_num end) as stop_page from (select *, list_max(list_transform(flatten(tables), lambda r: len(r))) as w from pages) group by 1", "pages"),
}
