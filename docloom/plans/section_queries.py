"""Queries over section trees of the parsed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators import ordered
from docloom.operators import sections as S
from docloom.plans import oracle as O
from docloom.plans.line_queries import blocks, markdown_lines, page_lines
from docloom.sinks import markdown as M


def section_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, level, title and kind of every line read as a heading (SCL-08), with its sort key (ORD-03)."""
    s = T.section(F.col("line"))
    rows = page_lines(spark, sf_dir).select("content_id", "line_no", s.alias("s")).where("s.kind != 'unknown'")
    return rows.select("content_id", "line_no", "s.num", "s.level", "s.title", "s.kind", T.section_id(F.col("s.num"), F.col("s.kind")).alias("id"), F.array_join(T.section_key(F.col("s.num")), ".").alias("sort_key"))


def _heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.headings(markdown_lines(spark, sf_dir), "result_id")


def section_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with their parents (WIN-07, WIN-08)."""
    return S.tree(_heads(spark, sf_dir), "result_id").select("result_id", "pos", "id", "num", "title", "level", "kind", "parent_id")


def section_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every numbered section (WIN-09)."""
    return S.texts(markdown_lines(spark, sf_dir), "result_id")


def _full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.with_content(S.tree(_heads(spark, sf_dir), "result_id"), section_texts(spark, sf_dir), "result_id")


def section_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with text and action flag (JOIN-17)."""
    return _full(spark, sf_dir).select("result_id", "pos", "id", "content", "actionable")


def section_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with the path that puts the tree in pre-order (ITR-03)."""
    return S.paths(S.tree(_heads(spark, sf_dir), "result_id"), "result_id").select("result_id", "id", "pos", F.array_join("path", "/").alias("path"), F.size("path").alias("depth"))


def tree_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes, depth, levels and actionable nodes of every tree (AGG-20)."""
    return S.statistics(_full(spark, sf_dir), "result_id")


def structure_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tree as flat structure Markdown (SNK-08)."""
    return M.structure(S.tree(_heads(spark, sf_dir), "result_id"), "result_id")


def tree_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tree as a JSON list of nodes in document order (SNK-03)."""
    return M.tree_json(S.tree(_heads(spark, sf_dir), "result_id"), "result_id")


def heading_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks under each heading block, the ones before the first under none (WIN-10)."""
    b = blocks(spark, sf_dir, "doc_id", "page", "seq", "id", "type").where("doc_id is not null")
    b = ordered.last_known(b, "doc_id", "page", ["page", "seq", "block_no"], F.when(F.col("type") == "heading", F.col("id")), "section")
    return b.groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n_blocks"), F.min("seq").alias("first_seq"))


QUERIES = {f.__name__: f for f in (section_numbers, section_tree, section_texts, section_contents, section_order, tree_statistics, structure_markdown, tree_json, heading_sections)}


def _parse(c: str, key: str, source: str) -> str:
    t = O.strip(f"regexp_replace({O.strip(c)}, '\\.{{2,}}\\s*\\d*\\s*$', '')")
    num = r"^(\d+(?:\.\d+)*)(?:\s+.+)?$"
    app = O.lit(P.re2(r"^(Приложение\s+\d+|Приложение\s+[А-Яа-яA-Za-z])\.?\s*(.*)$"))
    service = " or ".join(f"starts_with(upper(t), {O.lit(s)})" for s in P.SERVICE_SECTIONS)
    inner = f"select {key}, line_no, {t} as t from ({source})"
    kinds = f"select *, case when {service} then 'service' when regexp_extract(t, {O.lit(num)}, 1) != '' then 'numeric' when regexp_extract(t, {app}, 1) != '' then 'appendix' else 'unknown' end as kind from ({inner})"
    rest = O.strip("regexp_extract(t, '^\\d+(?:\\.\\d+)*\\s+(.+)$', 1)")
    rest_app = O.strip(f"regexp_extract(t, {app}, 2)")
    n, a = f"regexp_extract(t, {O.lit(num)}, 1)", f"regexp_extract(t, {app}, 1)"
    return f"select {key}, line_no, case kind when 'numeric' then {n} when 'appendix' then {a} end as num, case kind when 'numeric' then len(string_split({n}, '.')) when 'appendix' then 1 else 0 end as level, case kind when 'numeric' then coalesce(nullif({rest}, ''), {n}) when 'appendix' then coalesce(nullif({rest_app}, ''), {a}) else t end as title, kind from ({kinds}) where kind != 'unknown'"


_ID = "case when kind = 'appendix' then 'app_' || lower(regexp_extract(num, '(\\d+|[А-Яа-яA-Za-z])$', 1)) else num end"
_L = O.strip("line")
_TEXT = f"regexp_replace({_L}, '^#{{1,6}}\\s+', '')"
_TT = O.strip(_TEXT)
_HEADS = _parse(_TEXT, "result_id", f"select * from markdown_lines where regexp_matches({_L}, '^#{{1,6}}\\s+') and not (regexp_matches({_TT}, {O.lit(P.TREE_GARBAGE)}) or (length({_TT}) < 3 and not regexp_matches({_TT}, '^\\d')))")
_KEPT = f"select *, row_number() over (partition by result_id order by line_no) as pos from (select *, {_ID} as sid from heads qualify kind = 'service' or row_number() over (partition by result_id, kind = 'service', {_ID} order by line_no) = 1)"
_TREE = "select k.result_id, k.pos, k.line_no as at, k.id, k.num, k.title, k.level, k.kind, case when k.level > 1 then (select arg_max(p.id, p.pos) from kept2 p where p.result_id = k.result_id and p.pos < k.pos and p.level < k.level) end as parent_id from kept2 k"
_KEPT2 = "select *, case when kind = 'service' then 'service_' || (pos - 1) else sid end as id from kept"
_BODY = {"heads": _HEADS, "kept": _KEPT, "kept2": _KEPT2, "tree": _TREE}
_TEXTS = f"select result_id, arg_max(num, beg) as num, {O.strip('arg_max(content, beg)')} as content from (select result_id, beg, any_value(num) as num, string_agg(line, chr(10) order by line_no) as content from (select *, last_value(case when n != '' then line_no end ignore nulls) over w as beg, last_value(nullif(n, '') ignore nulls) over w as num from (select *, regexp_extract(line, {O.lit(S.HEADING)}, 1) as n from markdown_lines) window w as (partition by result_id order by line_no rows between unbounded preceding and current row)) where beg is not null group by 1, 2) group by result_id, num"
_FULL = f"select t.*, coalesce(x.content, '') as content, regexp_matches(lower(coalesce(x.content, '')), {O.lit(P.ACTION_WORDS)}) as actionable from tree t left join texts x on t.result_id = x.result_id and t.num = x.num"
_KEY = "case when coalesce(num, '') = '' then '0' when starts_with(lower(num), 'приложение') then '9999.' || coalesce(nullif(regexp_extract(num, '(\\d+)', 1), ''), '0') else array_to_string(list_transform(string_split(num, '.'), lambda x: cast(x as int)), '.') end"

SQL = {
    "section_numbers": O.sql(f"select content_id, line_no, num, level, title, kind, {_ID} as id, {_KEY} as sort_key from s", "page_lines", s=_parse("line", "content_id", "select * from page_lines")),
    "section_tree": O.sql("select result_id, pos, id, num, title, level, kind, parent_id from tree", "markdown_lines", **_BODY),
    "section_texts": O.sql("select * from texts", "markdown_lines", texts=_TEXTS),
    "section_contents": O.sql("select result_id, pos, id, content, actionable from fulls", "markdown_lines", **_BODY, texts=_TEXTS, fulls=_FULL),
    "tree_statistics": O.sql("select result_id, sum(n) as n_nodes, max(level) as max_depth, string_agg(level || ':' || n, ',' order by level) as by_level, sum(a) as n_actionable from (select result_id, level, count(*) as n, count(*) filter (actionable) as a from fulls group by 1, 2) group by 1", "markdown_lines", **_BODY, texts=_TEXTS, fulls=_FULL),
    "structure_markdown": O.sql("select result_id, string_agg(repeat('#', least(greatest(level, 1) + 1, 6)) || ' ' || case when num is null or kind = 'appendix' and title = num or title = num then title else num || ' ' || title end, chr(10) order by pos) as markdown from tree group by 1", "markdown_lines", **_BODY),
    "heading_sections": O.sql("select doc_id, section, count(*) as n_blocks, min(seq) as first_seq from (select *, last_value(case when type = 'heading' then id end ignore nulls) over (partition by doc_id order by page nulls first, seq, block_no rows between unbounded preceding and current row) as section from blocks where doc_id is not null) group by 1, 2", "blocks"),
}
SQL["section_order"] = "with recursive " + SQL["section_tree"].split("with ", 1)[1].rsplit(" select result_id, pos, id, num", 1)[0] + ", walk as (select result_id, id, pos, cast(pos as varchar) as path, 1 as depth from tree where parent_id is null union all select t.result_id, t.id, t.pos, w.path || '/' || t.pos, w.depth + 1 from tree t join walk w on t.result_id = w.result_id and t.parent_id = w.id) select result_id, id, pos, path, depth from walk"
