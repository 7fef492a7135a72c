"""Queries over layout blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators import blocks as B
from docloom.plans import oracle as O
from docloom.plans.line_queries import blocks
from docloom.sinks import markdown as M
from docloom.sources.tables import latest, table

_COLUMNS = ("doc_id", "page", "seq", "id", "type", "content", "metadata")


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.lists(B.heading_types(blocks(spark, sf_dir, *_COLUMNS)))


def block_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings by number, capitals, font and bold type (SCL-38, AGG-14)."""
    return B.heading_types(blocks(spark, sf_dir, *_COLUMNS)).select("block_no", "kind", "level", F.round("mean_font", 6).alias("mean_font"))


def list_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List items and the list they belong to (WIN-05)."""
    return _typed(spark, sf_dir).where("list_no is not null").select("block_no", F.concat(F.lit("list_"), F.col("list_no").cast("string")).alias("list_id"), "list_type")


def heading_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heading that every block hangs on (WIN-06)."""
    return B.parents(B.heading_types(blocks(spark, sf_dir, *_COLUMNS))).select("block_no", "parent")


def table_of_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings in document order (ORD-08)."""
    return B.heading_types(blocks(spark, sf_dir, *_COLUMNS)).where("kind = 'heading'").select("doc_id", "page", "seq", "level", T.strip(F.coalesce("content", F.lit(""))).alias("title"))


def reading_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of every block in reading order (ORD-01, ORD-07)."""
    return B.reading_order(blocks(spark, sf_dir, "doc_id", "page", "seq", "bbox")).select("block_no", "rank")


def reading_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each block and the next in reading order (WIN-01)."""
    return B.order_edges(blocks(spark, sf_dir, "doc_id", "page", "seq", "bbox"))


def block_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks in all, by type and by source, and those of low confidence (AGG-03, FLT-14)."""
    b = blocks(spark, sf_dir, "type", "source", "confidence")
    sets = b.groupingSets([[F.col("type")], [F.col("source")], []], F.col("type"), F.col("source")).agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("confidence") < 0.7).alias("n_low"))
    return sets.select(F.when(F.col("g") == 1, "type").when(F.col("g") == 2, "source").otherwise("all").alias("by"), F.when(F.col("g") == 1, F.col("type")).when(F.col("g") == 2, F.col("source")).alias("value"), "n", "n_low")


def page_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of one page, source and confidence (FLT-14)."""
    return blocks(spark, sf_dir, "doc_id", "page", "id", "source", "confidence").where((F.col("page") == 1) & (F.lower("source") == "ocr") & (F.col("confidence") >= 0.8)).select("block_no", "doc_id", "id")


def band_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks in the header or footer band of an A4 page (FLT-09)."""
    return blocks(spark, sf_dir, "bbox").where(B.in_band(F.col("bbox.y0"), F.col("bbox.y1"), 842.0)).select("block_no")


def block_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width, height, area and centre of every box (SCL-33)."""
    x0, y0, x1, y1 = (F.col(f"bbox.{c}") for c in ("x0", "y0", "x1", "y1"))
    return blocks(spark, sf_dir, "bbox").where("bbox is not null").select("block_no", F.round(x1 - x0, 3).alias("width"), F.round(y1 - y0, 3).alias("height"), F.round((x1 - x0) * (y1 - y0), 2).alias("area"), F.round((x0 + x1) / 2, 3).alias("cx"), F.round((y0 + y1) / 2, 3).alias("cy"))


def page_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and route of every page (FLT-16, FLT-27, AGG-13, WIN-15)."""
    m = B.routed(B.page_measures(blocks(spark, sf_dir, "doc_id", "page", "type", "content", "bbox")))
    return m.select("doc_id", "page", "chars", "n_columns", "layout", "n_images", "n_drawings", "n_tables", F.round("coverage", 6).alias("coverage"), "density", "rule", "route")


def page_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box around all blocks of every page, zeros without any (AGG-15)."""
    b = blocks(spark, sf_dir, "doc_id", "page", "bbox")
    return b.groupBy("doc_id", "page").agg(*[F.coalesce(f(f"bbox.{c}"), F.lit(0.0)).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])


def common_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks, pages and OCR answers as rows of one form (SRC-07, SET-03, SCL-41)."""
    b = blocks(spark, sf_dir, "doc_id", "page", "type", "content", "source", "confidence").select(F.lit("block").alias("part"), F.col("block_no").alias("ref"), "doc_id", "page", "type", F.lower("source").alias("source"), F.length("content").alias("n_chars"), "confidence")
    p = latest(table(spark, sf_dir, "page_contents").select("content_id", "doc_id", "page_num", "text", "loaded_at"), "content_id", "loaded_at").select(F.lit("page").alias("part"), F.col("content_id").alias("ref"), "doc_id", F.col("page_num").alias("page"), F.lit("text").alias("type"), F.lit("native").alias("source"), F.length("text").alias("n_chars"))
    o = latest(table(spark, sf_dir, "ocr_responses").select("page_id", "doc_id", "page", "markdown", "confidence_avg", "received_at"), "page_id", "received_at").select(F.lit("ocr").alias("part"), F.col("page_id").alias("ref"), "doc_id", "page", F.lit("text").alias("type"), F.lit("ocr").alias("source"), F.length("markdown").alias("n_chars"), F.col("confidence_avg").alias("confidence"))
    return b.unionByName(p, allowMissingColumns=True).unionByName(o, allowMissingColumns=True)


def substituted_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with images replaced by their page's OCR answer where there is one, drawings dropped (ORD-02, SRC-08)."""
    b = blocks(spark, sf_dir, "doc_id", "page", "seq", "type", "content").where("type is null or type != 'vector'")
    o = latest(table(spark, sf_dir, "ocr_responses").select("page_id", "doc_id", "page", "markdown", "received_at"), "page_id", "received_at").where("markdown is not null and trim(markdown) != ''")
    o = o.groupBy(F.col("doc_id").alias("__d"), F.col("page").alias("__p")).agg(F.min_by("markdown", "page_id").alias("__m"))
    image = F.col("type").isin("image", "figure")
    out = b.join(o, (F.col("doc_id") == F.col("__d")) & (F.col("page") == F.col("__p")) & image, "left")
    return out.select("block_no", F.when(F.col("__m").isNotNull(), "ocr").otherwise(F.col("type")).alias("type"), F.length(F.coalesce("__m", "content")).alias("n_chars"))


def markdown_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block as Markdown (SNK-02)."""
    t = _typed(spark, sf_dir).where("content is not null")
    return t.select("block_no", M.block(F.col("kind"), F.col("content"), F.coalesce("level", F.lit(1)), F.col("list_type") == "ordered").alias("markdown"))


def markdown_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as Markdown with front matter, contents and page marks (SNK-01, SNK-09)."""
    t = _typed(spark, sf_dir).where("doc_id is not null and content is not null")
    line = M.block(F.col("kind"), F.col("content"), F.coalesce("level", F.lit(1)), F.col("list_type") == "ordered")
    order = F.struct("page", "seq", "block_no")
    per_page = t.groupBy("doc_id", "page").agg(M.in_order(order, F.when(F.col("kind") == "list", line).otherwise(F.concat(line, F.lit("\n")))).alias("body"), M.in_order(order, F.when(F.col("kind") == "heading", F.concat(F.repeat(F.lit("  "), F.col("level") - 1), F.lit("- "), T.strip(F.col("content"))))).alias("toc"), F.count(F.lit(1)).alias("n"))
    docs = per_page.groupBy("doc_id").agg(M.in_order("page", F.concat(F.lit("<!-- page "), F.col("page").cast("string"), F.lit(" -->\n"), F.col("body"))).alias("body"), M.in_order("page", F.nullif("toc", F.lit(""))).alias("toc"), F.sum("n").alias("n_blocks"), F.count(F.lit(1)).alias("n_pages"))
    return docs.select("doc_id", F.concat(M.front_matter({"doc_id": F.col("doc_id"), "pages": F.col("n_pages"), "blocks": F.col("n_blocks")}), F.lit("\n\n"), F.col("toc"), F.lit("\n\n"), F.col("body")).alias("markdown"))


def block_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that the same input always gets (SCL-40)."""
    return B.identified(blocks(spark, sf_dir, "doc_id", "type", "seq")).select("block_no", "uid")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with pages and without, with their time (AGG-21, SCL-37)."""
    t = latest(table(spark, sf_dir, "document_metadata").select("meta_id", "total_pages", "creation_date", "processed_date"), "meta_id", "processed_date")
    status = F.when(F.col("total_pages").isNull(), "failed").when(F.col("total_pages") == 0, "skipped").otherwise("success")
    took = F.unix_timestamp("processed_date") - F.unix_timestamp("creation_date")
    out = t.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"), F.sum("total_pages").alias("pages"), F.sum(took).alias("seconds"))
    return out.select("status", "n", "pages", T.duration(F.col("seconds")).alias("took"))


QUERIES = {f.__name__: f for f in (block_types, list_groups, heading_parents, table_of_contents, reading_ranks, reading_edges, block_statistics, page_lookup, band_blocks, block_geometry, page_measures, page_boxes, common_blocks, substituted_blocks, markdown_blocks, markdown_documents, block_ids, run_summary)}

_C = O.strip("coalesce(content, '')")
_NUMBERED = f"regexp_matches(t, {O.lit(P.either(P.HEADING_PATTERNS))})"
_KINDS = f"""select *, case when head then 'heading' else type end as kind, case when head then lvl when type = 'heading' then 1 end as level from (
 select *, type in ('text', 'paragraph', 'heading') and (numbered or large or bold) as head, case when bold then least(l2, 2) else l2 end as lvl from (
 select *, case when large then case when f > mean_font * 1.5 then 1 when f > mean_font * 1.3 then 2 else 3 end else l1 end as l2 from (
 select *, case when numbered and regexp_matches(t, '^\\d+\\.\\d+\\.\\d+') then 3 when numbered and regexp_matches(t, '^\\d+\\.\\d+') then 2 else 1 end as l1, f > mean_font * 1.2 as large, coalesce(lower(metadata['is_bold']) = 'true', false) and length(t) < 100 as bold from (
 select *, coalesce(font, mean_font) as f, {_NUMBERED} as numbered from (
 select *, {_C} as t, coalesce(sum(case when type in ('text', 'paragraph') then font end) over w / count(case when type in ('text', 'paragraph') then font end) over w, 12.0) as mean_font from (select *, case when try_cast(metadata['font_size'] as double) > 0 then try_cast(metadata['font_size'] as double) end as font from blocks) window w as (partition by doc_id))))))"""
_LISTS = f"select *, case when item then sum(case when item and not coalesce(was, false) then 1 else 0 end) over (partition by doc_id order by page nulls first, seq, block_no) end as list_no, case when item then case when regexp_matches(t, {O.lit(P.LIST_ORDERED)}) then 'ordered' else 'unordered' end end as list_type from (select *, lag(item) over (partition by doc_id order by page nulls first, seq, block_no) as was from (select *, kind in ('text', 'paragraph') and (regexp_matches(t, {O.lit(P.LIST_ORDERED)}) or regexp_matches(t, {O.lit(P.LIST_UNORDERED)})) as item from kinds))"
_RANKS = "select *, row_number() over (partition by doc_id order by page nulls first, coalesce(-bbox.y1, 0), coalesce(bbox.x0, 0), seq, block_no) as rank from blocks"
_PARENT = "case when level is null then greatest(l1, l2, l3) when level > 2 then greatest(l1, l2) when level > 1 then l1 end"
_ITEM = "regexp_replace(regexp_replace(regexp_replace(t, '^[-•·]\\s+', ''), '^\\d+\\)\\s+', ''), '^[а-я]\\)\\s+', '')"
_ANCHOR = "regexp_replace(replace(lower(regexp_replace(t, '^\\d+\\.?\\s*', '')), ' ', '-'), '[^\\p{L}\\p{N}_\\-]', '', 'g')"

SQL = {
    "block_types": O.sql("select block_no, kind, level, round(mean_font, 6) as mean_font from kinds", "blocks", kinds=_KINDS),
    "list_groups": O.sql("select block_no, 'list_' || cast(list_no as bigint) as list_id, list_type from items where item", "blocks", kinds=_KINDS, items=_LISTS),
    "heading_parents": O.sql(f"select block_no, ({_PARENT}).i as parent from (select block_no, hl as level, " + ", ".join(f"last_value(case when hl = {k} then {{'p': page, 's': seq, 'b': block_no, 'i': id}} end ignore nulls) over (partition by doc_id order by page nulls first, seq, block_no rows between unbounded preceding and 1 preceding) as l{k}" for k in (1, 2, 3)) + " from (select *, case when kind = 'heading' then level end as hl from kinds))", "blocks", kinds=_KINDS),
    "table_of_contents": O.sql("select doc_id, page, seq, level, t as title from kinds where kind = 'heading'", "blocks", kinds=_KINDS),
    "reading_ranks": O.sql("select block_no, rank from ranks", "blocks", ranks=_RANKS),
    "reading_edges": O.sql("select * from (select doc_id, block_no as source, lead(block_no) over (partition by doc_id order by rank) as target, rank - 1 as sequence from ranks) where target is not null", "blocks", ranks=_RANKS),
    "block_statistics": O.sql("select 'type' as by, type as value, count(*) as n, count(*) filter (confidence < 0.7) as n_low from blocks group by type union all select 'source', source, count(*), count(*) filter (confidence < 0.7) from blocks group by source union all select 'all', null, count(*), count(*) filter (confidence < 0.7) from blocks", "blocks"),
    "page_lookup": O.sql("select block_no, doc_id, id from blocks where page = 1 and lower(source) = 'ocr' and confidence >= 0.8", "blocks"),
    "band_blocks": O.sql("select block_no from blocks where bbox.y1 - bbox.y0 <= 842.0 * 0.12 and (bbox.y1 <= 842.0 * 0.08 or bbox.y0 >= 842.0 * 0.95)", "blocks"),
    "block_geometry": O.sql("select block_no, round(bbox.x1 - bbox.x0, 3) as width, round(bbox.y1 - bbox.y0, 3) as height, round((bbox.x1 - bbox.x0) * (bbox.y1 - bbox.y0), 2) as area, round((bbox.x0 + bbox.x1) / 2, 3) as cx, round((bbox.y0 + bbox.y1) / 2, 3) as cy from blocks where bbox is not null", "blocks"),
    "page_measures": O.sql(
        "select doc_id, page, chars, n_columns, layout, n_images, n_drawings, n_tables, round(coverage, 6) as coverage, density, rule, case rule when 7 then 'native' when 5 then 'hybrid' else 'ocr' end as route from (select *, case when chars = 0 then 1 when layout = 'newspaper' then 2 when layout = 'complex' then 3 when coverage > 0.7 then 4 when coverage > 0.3 and (n_images > 0 or n_drawings > 5) then 5 when density > 2000 then 6 else 7 end as rule from (select *, floor(chars * 0.25) as density, case when n_text = 0 then 'unknown' when n_text < 2 or n_columns = 1 then 'single_column' when n_columns = 2 then 'multi_column' when n_text > 10 then 'newspaper' else 'complex' end as layout from (select m.*, coalesce(c.n_columns, 0) as n_columns from m left join c on m.doc_id is not distinct from c.doc_id and m.page is not distinct from c.page)))",
        "blocks",
        m=f"select doc_id, page, sum(case when type in ('text', 'paragraph', 'heading', 'list') then length({_C}) else 0 end) as chars, count(*) filter (type in ('text', 'paragraph', 'heading', 'list') and bbox is not null) as n_text, count(*) filter (type in ('image', 'figure')) as n_images, count(*) filter (type = 'vector') as n_drawings, count(*) filter (type = 'table') as n_tables, coalesce(least(sum(case when type in ('image', 'figure', 'vector') then (bbox.x1 - bbox.x0) * (bbox.y1 - bbox.y0) end) / (595.0 * 842.0), 1.0), 0.0) as coverage from blocks group by 1, 2",
        c="select doc_id, page, count(*) filter (reach is null or x0 - reach > 50) as n_columns from (select doc_id, page, bbox.x0 as x0, max(bbox.x1) over (partition by doc_id, page order by bbox.x0, bbox.x1, block_no rows between unbounded preceding and 1 preceding) as reach from blocks where type in ('text', 'paragraph', 'heading', 'list') and bbox is not null) group by 1, 2",
    ),
    "page_boxes": O.sql("select doc_id, page, coalesce(min(bbox.x0), 0.0) as x0, coalesce(min(bbox.y0), 0.0) as y0, coalesce(max(bbox.x1), 0.0) as x1, coalesce(max(bbox.y1), 0.0) as y1 from blocks group by 1, 2", "blocks"),
    "common_blocks": O.sql("select 'block' as part, block_no as ref, doc_id, page, type, lower(source) as source, length(content) as n_chars, confidence from blocks union all select 'page', content_id, doc_id, page_num, 'text', 'native', length(text), null from pages union all select 'ocr', page_id, doc_id, page, 'text', 'ocr', length(markdown), confidence_avg from ocr", "blocks", "pages", "ocr"),
    "substituted_blocks": O.sql("select block_no, case when m is not null then 'ocr' else type end as type, length(coalesce(m, content)) as n_chars from blocks b left join (select doc_id as d, page as p, arg_min(markdown, page_id) as m from ocr where trim(markdown) != '' group by 1, 2) o on b.doc_id = o.d and b.page = o.p and b.type in ('image', 'figure') where type is null or type != 'vector'", "blocks", "ocr"),
    "markdown_blocks": O.sql(f"select block_no, case when kind = 'heading' then repeat('#', coalesce(level, 1)) || ' ' || t || ' {{#' || {_ANCHOR} || '}}' when item then case list_type when 'ordered' then '1. ' else '- ' end || {_ITEM} when kind = 'list' then '- ' || {_ITEM} when kind in ('text', 'paragraph') then t when kind = 'table' then chr(10) || content || chr(10) when kind in ('image', 'figure', 'vector') then '![' || kind || '](' || t || ')' else content end as markdown from items where content is not null", "blocks", kinds=_KINDS, items=_LISTS),
    "block_ids": O.sql("select block_no, 'block_' || seq || '_' || sha256(concat_ws('|', doc_id, type, cast(seq as varchar)))[1:8] as uid from blocks", "blocks"),
    "run_summary": O.sql("select status, n, pages, case when s < 60 then printf('%.1f сек', s::double) when s < 3600 then printf('%.1f мин', s / 60.0) else printf('%d ч %d мин', cast(floor(s / 3600) as int), cast(floor((s % 3600) / 60) as int)) end as took from (select case when total_pages is null then 'failed' when total_pages = 0 then 'skipped' else 'success' end as status, count(*) as n, sum(total_pages) as pages, sum(cast(floor(epoch(processed_date)) - floor(epoch(creation_date)) as bigint)) as s from meta group by 1)", "meta"),
}
