"""Queries over glossaries, roles and tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators import glossary as G
from docloom.plans import oracle as O
from docloom.plans.line_queries import blocks, markdown_lines, page_lines


def term_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines joined to term blocks (WIN-16)."""
    return G.term_blocks(page_lines(spark, sf_dir), "content_id", F.col("doc_id"))


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms and definitions, split by language (FLT-21, SCL-30, SNK-13)."""
    d = term_blocks(spark, sf_dir).select("content_id", "block_no", G.definition(F.col("block")).alias("d")).where("d is not null and d.term rlike '[а-яА-ЯёЁ]'")
    s = T.split_languages(T.artefacts(F.col("d.definition")))
    return d.select("content_id", "block_no", "d.term", s["ru"].alias("definition_ru"), s["en"].alias("definition_en"), G.english_term(s["en"]).alias("term_en"))


def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten pages with most definitions, and how many have an English part (AGG-16)."""
    return definitions(spark, sf_dir).groupBy("content_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("definition_en") != "").alias("n_en")).orderBy(F.desc("n"), "content_id").limit(10)


def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines split into a Russian and an English part (SCL-30)."""
    s = T.split_languages(F.col("line"))
    return page_lines(spark, sf_dir).where("line rlike '[a-zA-Z]'").select("content_id", "line_no", s["ru"].alias("ru"), s["en"].alias("en"))


def first_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the first numbered section of every parsed document (WIN-18)."""
    return G.between(markdown_lines(spark, sf_dir), "result_id", r"^#*\s*\d+(?:\.\d+)*\s+\S").select("result_id", "line_no")


def scoped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without the parts under code marks (WIN-17)."""
    return G.scoped(markdown_lines(spark, sf_dir), "result_id", r"^\\begin\{|^```|^<", r"^\\end\{|^#|^$").select("result_id", "line_no")


def block_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles and tasks named in blocks (SCL-39)."""
    b = blocks(spark, sf_dir, "content").where("content is not null").select("block_no", G.roles(F.col("content")).alias("r"), G.tasks(F.col("content")).alias("t"))
    return b.where("size(r) + size(t) > 0").select("block_no", F.array_join("r", ",").alias("roles"), F.array_join("t", ",").alias("tasks"))


def _per_document(spark: SparkSession, sf_dir: str, find, most: int) -> DataFrame:
    from pyspark.sql import Window

    b = blocks(spark, sf_dir, "doc_id", "content").where("content is not null and doc_id is not null").select("doc_id", F.explode(find(F.col("content"))).alias("value")).distinct()
    # distinct phrases of a document, not its rows, meet in one window; the window keeps the first ones only
    return b.withColumn("k", F.row_number().over(Window.partitionBy("doc_id").orderBy("value"))).where(F.col("k") <= most)


def merged_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union of the first ten roles of every document (AGG-17)."""
    return _per_document(spark, sf_dir, G.roles, 10).select(F.col("value").alias("role")).distinct()


def merged_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty tasks of every document with their source (AGG-18, SNK-11)."""
    return _per_document(spark, sf_dir, G.tasks, 20).select("doc_id", F.col("value").alias("task"))


def raci_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid of the first ten tasks and five roles (JOIN-11, SNK-11); both sides are bounded by the feature."""
    t = merged_tasks(spark, sf_dir).select("task").distinct().orderBy("task").limit(10)
    r = merged_roles(spark, sf_dir).orderBy("role").limit(5)
    return t.join(F.broadcast(r.agg(F.collect_list("role").alias("roles")))).select("task", F.explode("roles").alias("role"))


QUERIES = {f.__name__: f for f in (term_blocks, definitions, term_counts, split_lines, first_sections, scoped_lines, block_roles, merged_roles, merged_tasks, raci_grid)}

_T = O.strip("line")
_TOC = lambda c: f"(contains({c}, '...') or contains({c}, '…') or (regexp_matches({c}, '\\s+\\d{{1,3}}\\s*$') and length(regexp_replace({c}, {O.lit(P.BLANK + '+$')}, '')) > 40))"
_START = O.lit(P.re2(r"^#*\s*\d+(?:\.\d+)*\s+\S"))
_BLOCKS = f"""select content_id, block_no, string_agg(c, ' ' order by line_no) as block from (select *, sum(case when s or coalesce(lag_s, true) or (regexp_matches(c, {O.lit(P.TERM)}) and (tab or not regexp_matches(c[1], '\\p{{Ll}}'))) then 1 else 0 end) over (partition by content_id order by line_no) as block_no from (
 select *, lag(s) over (partition by content_id order by line_no) as lag_s from (select *, case when tab then {O.strip("regexp_replace(t, '^\\||\\|$', '', 'g')")} else t end as c from (select *, {_T} as t, regexp_matches({_T}, '^#{{2,3}} ') as s, starts_with({_T}, '|') as tab from page_lines))
 where not regexp_matches(line, {O.lit(P.GLOSSARY_JUNK)}) and not coalesce(length(doc_id) > 0 and contains(line, doc_id) and length(t) < 200, false) and t != '' and not (tab and (c = '' or starts_with(c, '-'))))) where not s group by 1, 2"""
_ROLES = lambda c: f"list_sort(list_distinct(list_transform(regexp_extract_all({c}, {O.lit(P.re2(r'([\p{L}\p{N}_]+\s+(?:' + P.ROLES + '))'))}), lambda x: {O.squeeze('lower(x)')})))"
_TASKS = lambda c: f"list_sort(list_distinct(list_filter(list_transform(regexp_extract_all({c}, {O.lit(P.re2(r'((?:' + P.TASKS + r')\s+[а-я\s]+)'))}), lambda x: {O.squeeze('lower(x)')}[1:100]), lambda x: length(x) > 5)))"
_EACH = lambda f, n: f"select doc_id, value from (select distinct doc_id, unnest({f('content')}) as value from blocks where content is not null and doc_id is not null) qualify row_number() over (partition by doc_id order by value) <= {n}"
_CODE_ON, _CODE_OFF = O.lit(P.re2(r"^\\begin\{|^```|^<")), O.lit(P.re2(r"^\\end\{|^#|^$"))

SQL = {
    "term_blocks": O.sql(_BLOCKS, "page_lines"),
    "first_sections": O.sql(f"select l.result_id, l.line_no from markdown_lines l join (select result_id, min(line_no) as s from markdown_lines where regexp_matches({_T}, {_START}) and not {_TOC(_T)} group by 1) a on l.result_id = a.result_id and l.line_no > s where not exists (select 1 from markdown_lines e where e.result_id = l.result_id and e.line_no > s and e.line_no <= l.line_no and regexp_matches({O.strip('e.line')}, '^#\\s+\\d+[.\\s]'))", "markdown_lines"),
    "scoped_lines": O.sql(f"select result_id, line_no from (select *, last_value(case when regexp_matches(line, {_CODE_OFF}) then 1 when regexp_matches(line, {_CODE_ON}) then 0 end ignore nulls) over (partition by result_id order by line_no rows between unbounded preceding and current row) as k from markdown_lines) where coalesce(k, 1) = 1", "markdown_lines"),
    "block_roles": O.sql(f"select block_no, array_to_string(r, ',') as roles, array_to_string(t, ',') as tasks from (select block_no, {_ROLES('content')} as r, {_TASKS('content')} as t from blocks where content is not null) where len(r) + len(t) > 0", "blocks"),
    "merged_roles": O.sql("select distinct value as role from e", "blocks", e=_EACH(_ROLES, 10)),
    "merged_tasks": O.sql("select doc_id, value as task from e", "blocks", e=_EACH(_TASKS, 20)),
    "raci_grid": O.sql("select task, role from (select distinct value as task from t order by 1 limit 10), (select distinct value as role from r order by 1 limit 5)", "blocks", t=_EACH(_TASKS, 20), r=_EACH(_ROLES, 10)),
}
