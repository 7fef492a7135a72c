"""Queries over lines of pages and parsed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators import lines as L
from docloom.plans import oracle as O
from docloom.sources.tables import latest, table


def blocks(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The current state of the blocks."""
    t = table(spark, sf_dir, "ir_blocks")
    return latest(t.select("block_no", *columns, "loaded_at") if columns else t, "block_no", "loaded_at")


def pages(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The current state of the pages."""
    return latest(table(spark, sf_dir, "page_contents").select("content_id", *columns, "loaded_at"), "content_id", "loaded_at")


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current state of the parsed documents."""
    return latest(table(spark, sf_dir, "full_parse_results").select("result_id", "doc_code", "full_markdown", "parsed_at"), "result_id", "parsed_at")


def block_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.lines(blocks(spark, sf_dir, "doc_id", "page", "seq", "content"), "content", "doc_id", "page", "seq", "block_no")


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every page (SRC-19)."""
    return L.lines(pages(spark, sf_dir, "doc_id", "page_num", "text"), "text", "doc_id", F.col("page_num").alias("page"), "content_id")


def markdown_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.lines(parsed(spark, sf_dir), "full_markdown", "result_id", "doc_code")


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines on over half of a document's pages (AGG-01, SCL-01); only documents of several pages can tell."""
    return L.repeated(block_lines(spark, sf_dir)).where("pages >= 2")


def normalized_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as they are compared, with blanks squeezed (SCL-01, SCL-02)."""
    return page_lines(spark, sf_dir).select("content_id", "line_no", T.normal_line(F.col("line")).alias("norm"), T.squeeze(F.col("line")).alias("squeezed"))


def line_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbage, important and content lines (FLT-01, FLT-02, FLT-03)."""
    c = F.col("line")
    return block_lines(spark, sf_dir).select("block_no", "line_no", T.is_garbage(c).alias("garbage"), T.is_important(c).alias("important"), T.line_class(c).alias("class"))


def line_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each line is dropped or kept (FLT-04)."""
    rows = block_lines(spark, sf_dir)
    return L.with_reasons(rows, L.repeated(rows)).select("block_no", "line_no", "reason")


def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropped lines by reason and text, with the place where each is first seen (AGG-02)."""
    rows = block_lines(spark, sf_dir)
    found = L.with_reasons(rows, L.repeated(rows)).where("reason in ('repeat', 'blacklist', 'pattern')")
    return found.groupBy("doc_id", "reason", F.col("line").alias("text")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("seq", "line_no")).alias("at")).select("doc_id", "reason", "text", "n", F.col("at.seq").alias("first_seq"), F.col("at.line_no").alias("first_line"))


def heading_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of each document by class, with the first five of each (AGG-04)."""
    heads = markdown_lines(spark, sf_dir).withColumn("heading", T.strip(F.regexp_extract("line", r"^#{1,6}\s+(.+)$", 1))).where("heading != ''").withColumn("class", T.line_class(F.col("heading")))
    # at most five rows of a class leave a map task
    best = F.slice(F.array_sort(F.collect_list(F.struct("line_no", "heading"))), 1, 5)
    return heads.groupBy("result_id", "class").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(best, lambda x: x["heading"]), " | ").alias("examples"))


def tree_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that a section tree leaves out (FLT-05)."""
    return page_lines(spark, sf_dir).where(T.is_tree_garbage(F.col("line"))).select("content_id", "line_no", "line")


def cleaned_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed documents without garbage lines and change logs (FLT-06, FLT-07)."""
    return L.joined(L.cleaned(markdown_lines(spark, sf_dir), "result_id"), "result_id")


def running_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and footer lines by their words (FLT-08)."""
    return block_lines(spark, sf_dir).where(T.is_running_line(F.col("line"))).select("block_no", "line_no", "line")


def glossary_line_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table-of-contents, junk and document-header lines (FLT-12, FLT-13)."""
    c = F.col("line")
    head = (F.length("doc_id") > 0) & F.contains(c, F.col("doc_id")) & (F.length(T.strip(c)) < 200)
    return page_lines(spark, sf_dir).select("content_id", "line_no", T.is_toc_line(c).alias("toc"), T.is_glossary_junk(c).alias("junk"), F.coalesce(head, F.lit(False)).alias("header"))


def actionable_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that ask somebody to act (FLT-17)."""
    return blocks(spark, sf_dir, "content").where(T.is_actionable(F.col("content"))).select("block_no")


def corrupted_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First pages whose text is too short or mostly Latin (FLT-19)."""
    return pages(spark, sf_dir, "page_num", "text").where(F.col("page_num") == F.lit(1)).where(T.is_corrupted_title(F.col("text"))).select("content_id")


def failed_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the first 60 lines of each document hold the mark of a page read by OCR and its failure (FLT-20)."""
    heads = markdown_lines(spark, sf_dir).where("line_no < 60")
    marked, failed = F.bool_or(F.col("line").contains("<!-- Страница 1 (OCR) -->")), F.bool_or(F.col("line").contains("OCR не удался"))
    return heads.groupBy("result_id").agg((marked & failed).alias("failed"))


def heading_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as Markdown headings with their anchors (SCL-06, SCL-07)."""
    c = T.markdown_heading(F.col("line"))
    return page_lines(spark, sf_dir).select("content_id", "line_no", c.alias("formatted"), T.anchor(T.strip(F.col("line"))).alias("anchor"))


def typed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown lines as typed blocks (SCL-25)."""
    return L.typed(markdown_lines(spark, sf_dir)).select("result_id", (F.col("line_no") + 1).alias("line_number"), "type", "level", "content")


def page_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated tokens and text layer of each page (SCL-34)."""
    n = F.length(T.strip(F.coalesce("text", F.lit(""))))
    return pages(spark, sf_dir, "text").select("content_id", F.floor(n * 0.25).cast("bigint").alias("tokens"), (n > 0).alias("has_text"))


def mended_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without bars and cut words, and as they are exported (SCL-31, SCL-45)."""
    return pages(spark, sf_dir, "text").where("text is not null").select("content_id", T.artefacts(F.col("text")).alias("mended"), T.for_export(F.col("text")).alias("exported"))


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and dates found in a page (SCL-15, SCL-16)."""
    d = T.dates(F.col("text"))
    return pages(spark, sf_dir, "text").where("text is not null").select("content_id", T.title(F.col("text")).alias("title"), d["approval_date"].alias("approval_date"), d["effective_date"].alias("effective_date"))


def limited_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of the first two pages of every document, and its page count (SRC-18)."""
    rows = pages(spark, sf_dir, "doc_id", "page_num", "text")
    n = rows.groupBy("doc_id").agg(F.countDistinct("page_num").alias("n_pages"))
    head = rows.where("page_num <= 2 and text is not null").groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_num", "content_id", "text"))), lambda x: x["text"]), "\n").alias("head"))
    return n.join(head, "doc_id", "left").select("doc_id", "n_pages", "head")


QUERIES = {f.__name__: f for f in (repeated_lines, page_lines, normalized_lines, line_classes, line_reasons, reason_counts, heading_statistics, tree_lines, cleaned_markdown, running_lines, glossary_line_kinds, actionable_blocks, corrupted_titles, failed_titles, heading_lines, typed_lines, page_density, mended_pages, page_titles, limited_pages)}

_REPEATS = f"select doc_id, norm as line, count(*) as n_pages, any_value(pages) as pages from (select distinct doc_id, page, {O.normal_line('line')} as norm from block_lines where doc_id is not null and page is not null) join (select doc_id, count(distinct page) as pages from block_lines where doc_id is not null group by 1) using (doc_id) where norm != '' group by 1, 2 having count(*) > any_value(pages) * 0.5"
_REASON = f"case when r.line is not null then 'repeat' when upper({O.bare('l.line')}) in ({', '.join(map(O.lit, P.GARBAGE_LINES))}) then 'blacklist' when {O.found(O.bare('l.line'), *P.GARBAGE_PATTERNS)} then 'pattern' when {O.is_important('l.line')} then 'important' else 'content' end"
_REASONS = f"select l.*, {_REASON} as reason from block_lines l left join repeats r on l.doc_id = r.doc_id and {O.normal_line('l.line')} = r.line"
_CLASS = lambda c: f"case when {O.is_garbage(c)} then 'garbage' when {O.is_important(c)} then 'important' else 'content' end"
_T = O.strip("line")
_LATIN, _CYR = "len(regexp_extract_all({0}, '[a-zA-Z]'))", "len(regexp_extract_all({0}, '[а-яА-ЯёЁ]'))"
_MD_GARBAGE = f"(regexp_matches({_T}, {O.lit(P.re2('^(?:' + P.either(P.MARKDOWN_GARBAGE) + ')'))}) or ({_LATIN.format(_T)} + {_CYR.format(_T)} > 10 and {_LATIN.format(_T)} > ({_LATIN.format(_T)} + {_CYR.format(_T)}) * 0.6 and not regexp_matches({_T}, {O.lit(P.LATIN_ALLOWED)})))"
_HEAD = r"^(\d+(?:\.\d+)*)\s+([А-ЯA-Z].+)$"
_DATE = lambda c: "coalesce(" + ", ".join(f"nullif(regexp_extract({c}, {O.lit(P.re2(p))}, 1), '')" for p in P.DATES) + ")"
_NEAR = "coalesce(" + ", ".join(f"case when strpos(lower(text), {O.lit(w)}) > 0 then {_DATE(f'substring(text, greatest(strpos(lower(text), {O.lit(w)}) - 50, 1), strpos(lower(text), {O.lit(w)}) + 200 - greatest(strpos(lower(text), {O.lit(w)}) - 50, 1))')} end" for w in P.APPROVAL_WORDS) + ")"


def _title_sql() -> str:
    tries = []
    for p in P.TITLES:
        t = O.squeeze(f"regexp_extract(text, {O.lit('(?im)' + p)}, 1)")
        tries.append(f"case when length({t}) > 10 and length({t}) < 200 then {t} end")
    return "coalesce(" + ", ".join(tries) + ")"


def _export_sql() -> str:
    c = "text"
    for mark, plain in P.EXPORT_MARKS:
        c = f"replace({c}, {O.lit(mark)}, {O.lit(plain)})"
    c = f"regexp_replace(regexp_replace({c}, {O.lit(P.EMOJI)}, '', 'g'), '<br>\\s*', '  ' || chr(10), 'g')"
    return f"regexp_replace(regexp_replace({c}, '\\*\\*([^*]+)\\*\\*([А-ЯЁA-Z])', '**\\1** \\2', 'g'), '\\)([А-ЯЁ]{{2,}}:)', ') \\1', 'g')"


SQL = {
    "repeated_lines": O.sql(f"select * from ({_REPEATS}) where pages >= 2", "block_lines"),
    "page_lines": O.sql("select doc_id, page, content_id, line_no, line from page_lines", "page_lines"),
    "normalized_lines": O.sql(f"select content_id, line_no, {O.normal_line('line')} as norm, {O.squeeze('line')} as squeezed from page_lines", "page_lines"),
    "line_classes": O.sql(f"select block_no, line_no, {O.is_garbage('line')} as garbage, {O.is_important('line')} as important, {_CLASS('line')} as class from block_lines", "block_lines"),
    "line_reasons": O.sql("select block_no, line_no, reason from reasons", "block_lines", repeats=_REPEATS, reasons=_REASONS),
    "reason_counts": O.sql("select doc_id, reason, line as text, count(*) as n, min({'s': seq, 'l': line_no}).s as first_seq, min({'s': seq, 'l': line_no}).l as first_line from reasons where reason in ('repeat', 'blacklist', 'pattern') group by 1, 2, 3", "block_lines", repeats=_REPEATS, reasons=_REASONS),
    "heading_statistics": O.sql("select result_id, class, count(*) as n, string_agg(heading, ' | ' order by line_no) filter (k <= 5) as examples from (select *, row_number() over (partition by result_id, class order by line_no) as k from heads) group by 1, 2", "markdown_lines", heads=f"select *, {_CLASS('heading')} as class from (select *, {O.strip(f'regexp_extract(line, {O.lit('^#{1,6}\\s+(.+)$')}, 1)')} as heading from markdown_lines) where heading != ''"),
    "tree_lines": O.sql(f"select content_id, line_no, line from page_lines where regexp_matches({_T}, {O.lit(P.TREE_GARBAGE)}) or (length({_T}) < 3 and not regexp_matches({_T}, '^\\d'))", "page_lines"),
    "cleaned_markdown": O.sql(
        "select result_id, string_agg(line, chr(10) order by line_no) as text from two where not (blank and coalesce(was, false)) group by 1",
        "markdown_lines",
        zero=f"select *, case when regexp_matches({_T}, {O.lit(P.re2(P.CHANGE_LOG))}) then true when regexp_matches({_T}, {O.lit(P.re2(P.MARKDOWN_HEADING))}) then false end as mark from markdown_lines",
        one=f"select *, {_T} = '' as blank from (select *, last_value(mark ignore nulls) over (partition by result_id order by line_no rows between unbounded preceding and current row) as log from zero) where not coalesce(log, false) and not {_MD_GARBAGE}",
        two="select *, lag(blank) over (partition by result_id order by line_no) as was from one",
    ),
    "running_lines": O.sql(f"select block_no, line_no, line from block_lines where (contains(lower({_T}), 'из') and length({_T}) < 20) or " + " or ".join(f"contains(lower({_T}), {O.lit(p)})" for p in P.RUNNING_PARTS), "block_lines"),
    "glossary_line_kinds": O.sql(f"select content_id, line_no, contains(line, '...') or contains(line, '…') or (regexp_matches(line, '\\s+\\d{{1,3}}\\s*$') and length(regexp_replace(line, {O.lit(P.BLANK + '+$')}, '')) > 40) as toc, regexp_matches(line, {O.lit(P.GLOSSARY_JUNK)}) as junk, coalesce(length(doc_id) > 0 and contains(line, doc_id) and length({_T}) < 200, false) as header from page_lines", "page_lines"),
    "actionable_blocks": O.sql(f"select block_no from blocks where regexp_matches(lower(content), {O.lit(P.ACTION_WORDS)})", "blocks"),
    "corrupted_titles": O.sql(f"select content_id from (select content_id, {O.strip('coalesce(text, {})'.format(O.lit('')))} as t, substring(coalesce(text, ''), 1, 500) as h from pages where page_num = 1) where length(t) < 50 or ({_LATIN.format('h')} + {_CYR.format('h')} > 0 and {_LATIN.format('h')} > ({_LATIN.format('h')} + {_CYR.format('h')}) * 0.5)", "pages"),
    "failed_titles": O.sql("select result_id, bool_or(contains(line, '<!-- Страница 1 (OCR) -->')) and bool_or(contains(line, 'OCR не удался')) as failed from markdown_lines where line_no < 60 group by 1", "markdown_lines"),
    "heading_lines": O.sql(
        f"select content_id, line_no, case when n != '' and length(h) <= 150 then repeat('#', least(len(string_split(n, '.')), 4)) || ' ' || n || ' ' || h when n = '' and upper(t) = t and lower(t) != t and length(t) > 5 and length(t) < 80 and not regexp_matches(t, '\\d') then '# ' || t else t end as formatted, regexp_replace(replace(lower(regexp_replace(t, '^\\d+\\.?\\s*', '')), ' ', '-'), '[^\\p{{L}}\\p{{N}}_\\-]', '', 'g') as anchor from (select *, regexp_extract(t, {O.lit(_HEAD)}, 1) as n, regexp_extract(t, {O.lit(_HEAD)}, 2) as h from (select content_id, line_no, {_T} as t from page_lines))",
        "page_lines",
    ),
    "typed_lines": O.sql(f"select result_id, line_no + 1 as line_number, type, case when type = 'heading' then length(regexp_extract(line, '^(#+)', 1)) else 1 end as level, {_T} as content from (select *, case when starts_with(line, '#') then 'heading' when regexp_matches(line, '^[-*+] ') then 'list_item' when starts_with(line, '|') then 'table_row' when starts_with(line, '```') then 'code_block' when starts_with(line, '>') then 'quote' else 'paragraph' end as type from markdown_lines where {_T} != '')", "markdown_lines"),
    "page_density": O.sql(f"select content_id, cast(floor(length(t) * 0.25) as bigint) as tokens, length(t) > 0 as has_text from (select content_id, {O.strip('coalesce(text, {})'.format(O.lit('')))} as t from pages)", "pages"),
    "mended_pages": O.sql(f"select content_id, {O.strip('regexp_replace(regexp_replace(regexp_replace(text, {}, {}, {}), {}, {}, {}), {}, {}, {})'.format(O.lit(r'\s*\|\s*'), O.lit(' '), O.lit('g'), O.lit(r'([\p{L}\p{N}_])- ([\p{L}\p{N}_])'), O.lit(r'\1\2'), O.lit('g'), O.lit(r'\s{2,}'), O.lit(' '), O.lit('g')))} as mended, {_export_sql()} as exported from pages where text is not null", "pages"),
    "page_titles": O.sql(f"select content_id, {_title_sql()} as title, {_NEAR} as approval_date, case when {_NEAR} is null then {_DATE('substring(text, 1, 2000)')} end as effective_date from pages where text is not null", "pages"),
    "limited_pages": O.sql("select doc_id, n_pages, head from (select doc_id, count(distinct page_num) as n_pages from pages group by 1) left join (select doc_id, string_agg(text, chr(10) order by page_num, content_id) as head from pages where page_num <= 2 and text is not null group by 1) using (doc_id)", "pages"),
}
