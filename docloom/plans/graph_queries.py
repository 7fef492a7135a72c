"""Queries over document codes, references and the document graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.functions.shared import kept
from docloom.operators import graphs as G
from docloom.plans import oracle as O
from docloom.plans.line_queries import blocks
from docloom.sources.tables import latest, table


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current state of the document metadata."""
    return latest(table(spark, sf_dir, "document_metadata").select("meta_id", "doc_id", "title", "source_file", "total_pages", "processed_date"), "meta_id", "processed_date")


def docx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(table(spark, sf_dir, "docx_metadata").select("docx_id", "doc_number", "title", "doc_type", "department", "approval_date", "effective_date", "extracted_at"), "docx_id", "extracted_at")


def documents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the source files whose name is a document code (SRC-13)."""
    rows = meta(spark, sf_dir).select(F.col("meta_id").alias("ordinal"), T.document_code(F.col("source_file")).alias("c")).where("c.code is not null")
    return kept(G.described(rows.select("ordinal", "c.*")))


def document_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code, type, process and version in every file name (SCL-09, SCL-10)."""
    return meta(spark, sf_dir).select("meta_id", T.document_code(F.col("source_file")).alias("c")).select("meta_id", "c.*", T.code_key(F.col("c.code")).alias("key"))


def process_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process, group and type of every document (SCL-12, SCL-13)."""
    return documents_of(spark, sf_dir).select("code", "process_id", "group", "type_name", "id")


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 50 PDF files by name, without print copies (SRC-14, ORD-06)."""
    f = meta(spark, sf_dir).where(F.lower("source_file").endswith(".pdf") & ~F.lower("source_file").contains("для печати"))
    return f.select("source_file", T.file_code(F.col("source_file")).alias("code"), "meta_id").orderBy("source_file", "meta_id").limit(50)


def block_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document codes named in every block (SCL-14, SET-05)."""
    b = blocks(spark, sf_dir, "doc_id", "content").where("content is not null")
    return b.select("block_no", F.array_join(T.references(F.col("content"), F.col("doc_id")), ",").alias("refs")).where("refs != ''")


def _refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blocks(spark, sf_dir, "doc_id", "content").where("content is not null and doc_id is not null")
    return b.select(F.col("doc_id").alias("code"), F.explode(T.references(F.col("content"), F.col("doc_id"))).alias("ref")).distinct()


def reference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References between known documents (JOIN-14, GRF-04)."""
    return G.resolved(documents_of(spark, sf_dir), _refs(spark, sf_dir))


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the document graph (GRF-01, GRF-02, SET-06)."""
    return G.nodes(documents_of(spark, sf_dir))


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents_of(spark, sf_dir)
    return G.without_orphan_edges(G.edges(docs, _refs(spark, sf_dir)), G.nodes(docs))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges whose both ends are nodes (GRF-01, JOIN-15)."""
    return _edges(spark, sf_dir)


def graph_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge ends of every node (AGG-07)."""
    return G.degrees(_edges(spark, sf_dir))


def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest version of every base code (AGG-08)."""
    return G.latest_versions(documents_of(spark, sf_dir))


def pruned_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes that stay when references alone tie documents (JOIN-16)."""
    docs = documents_of(spark, sf_dir)
    refs = G.resolved(docs, _refs(spark, sf_dir)).withColumn("edge_type", F.lit("references"))
    return G.without_orphans(G.nodes(docs), refs, G.latest_versions(docs)).select("id", "node_type")


def graph_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by type, by group and by process, the latter without empty ones (AGG-06, ORD-05)."""
    d = documents_of(spark, sf_dir)
    sets = d.groupingSets([[F.col("type_name")], [F.col("group")], [F.col("process_id")]], F.col("type_name"), F.col("group"), F.col("process_id")).agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"))
    by = F.when(F.col("g") == 3, "type").when(F.col("g") == 5, "group").otherwise("process")
    return sets.select(by.alias("by"), F.coalesce("type_name", "group", "process_id").alias("value"), "n").where("value is not null")


def top_processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten processes of most documents (ORD-05)."""
    d = documents_of(spark, sf_dir).where("process_id is not null")
    return d.groupBy("process_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "process_id").limit(10)


def node_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming and outgoing edges of every process node (GRF-08, GRF-09)."""
    return G.neighbourhood(graph_nodes(spark, sf_dir), _edges(spark, sf_dir), F.col("node_type") == "process")


def node_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of one group that match a text (GRF-10)."""
    return G.search(G.of_group(graph_nodes(spark, sf_dir), "M"), "М1").select("id", "node_type", "label")


def node_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid cell of every node in the viewer (GRF-11)."""
    return G.layout(graph_nodes(spark, sf_dir))


def graph_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node and edge rows as JSON lines (SNK-03)."""
    n = graph_nodes(spark, sf_dir).select(F.lit("node").alias("part"), F.to_json(F.struct("id", "label", "node_type", "group", "process")).alias("json"))
    return n.unionByName(_edges(spark, sf_dir).select(F.lit("edge").alias("part"), F.to_json(F.struct("source", "target", "edge_type")).alias("json")))


def catalogue_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue row of every document: by key, else the first row whose key begins with the code without version (JOIN-12, SCL-11, SRC-15).

    A prefix is matched by an equi join on the key's parts up to each hyphen,
    so no theta join is needed; the later of equal catalogue keys counts.
    """
    rows = docx(spark, sf_dir).where("doc_number is not null").select(T.catalogue_key(F.col("doc_number")).alias("key"), "docx_id")
    cat = rows.groupBy("key").agg(F.max("docx_id").alias("docx_id"))
    docs = meta(spark, sf_dir).where("doc_id is not null").select("meta_id", T.catalogue_key(F.col("doc_id")).alias("code")).withColumn("base", F.regexp_replace("code", r"-\d+$", "-"))
    parts = cat.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("key", "-"))), lambda n: F.concat(F.array_join(F.slice(F.split("key", "-"), 1, n), "-"), F.lit("-")))).alias("base"), "docx_id")
    first = parts.groupBy("base").agg(F.min("docx_id").alias("by_prefix"))
    out = docs.join(cat.withColumnRenamed("key", "code"), "code", "left").join(first, "base", "left")
    return out.select("meta_id", F.coalesce("docx_id", "by_prefix").alias("docx_id"), F.when(F.col("docx_id").isNotNull(), "exact").when(F.col("by_prefix").isNotNull(), "prefix").otherwise("none").alias("how"))


def paired_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of the two forms of one document, with their similarity (JOIN-13, SCL-17, SCL-18, SET-02)."""
    a = meta(spark, sf_dir).select("meta_id", T.code_key(F.col("doc_id")).alias("key"), F.col("title").alias("t1"))
    b = docx(spark, sf_dir).select("docx_id", T.code_key(F.col("doc_number")).alias("key"), F.col("title").alias("t2"))
    s = T.jaccard(F.col("t1"), F.col("t2"))
    return a.where("key != ''").join(b, "key").select("meta_id", "docx_id", F.round(s, 6).alias("similarity"), (s >= 0.5).alias("valid"))


def written_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of approval in one form, figures and month names alike (SCL-15)."""
    d = F.col("approval_date")
    month = F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), F.regexp_extract(d, r"([а-я]+)\s+\d{4}", 1))
    plain = F.try_to_date(d, "dd.MM.yyyy")
    named = F.try_to_date(F.format_string("%s-%02d-%02d", F.regexp_extract(d, r"(\d{4})", 1), month.cast("int"), F.coalesce(F.regexp_extract(d, r"(\d{1,2})", 1).try_cast("int"), F.lit(0))), "yyyy-MM-dd")
    return docx(spark, sf_dir).where("approval_date is not null").select("docx_id", F.when(month > 0, named).otherwise(plain).cast("string").alias("approved"))


_MONTHS = ("января", "февраля", "марта", "апреля", "мая", "июня", "июля", "августа", "сентября", "октября", "ноября", "декабря")

QUERIES = {f.__name__: f for f in (document_codes, process_groups, file_listing, block_references, reference_pairs, graph_nodes, graph_edges, graph_degrees, latest_versions, pruned_nodes, graph_statistics, top_processes, node_info, node_search, node_layout, graph_json, catalogue_matches, paired_documents, written_dates)}

_CODE = "trim(regexp_replace(trim(replace(replace(trim(split_part(source_file, '^', 1)), '.pdf', ''), '.PDF', '')), '\\s*\\([^)]+\\)\\s*$', ''))"
_PROC = lambda g: f"case when {g} = '' then '' else translate(upper({g}[1]), 'MBV', 'МБВ') || upper({g}[2:]) end"


def _codes() -> str:
    cases = {"type": [], "process": [], "version": []}
    for p, k, proc, v in T._CODES:
        q = O.lit(P.re2(p))
        g = lambda n, q=q: f"regexp_extract(code, {q}, {n})"
        hit = f"when regexp_matches(code, {q}) then "
        cases["type"].append(hit + (f"upper({g(k)})" if isinstance(k, int) else O.lit(k)))
        cases["process"].append(hit + (f"({_PROC(g(proc[0]))}) || '.' || {g(proc[1])}" if isinstance(proc, tuple) else O.lit(proc)))
        cases["version"].append(hit + g(v))
    inner = ", ".join(f"case {' '.join(c)} end as {n}" for n, c in cases.items())
    return f"select meta_id, case when type is null then null else code end as code, type, process, version from (select meta_id, code, {inner} from (select meta_id, {_CODE} as code from meta))"


def _map(c: str, names: dict[str, str]) -> str:
    return f"case {c} " + " ".join(f"when {O.lit(k)} then {O.lit(v)}" for k, v in names.items()) + " else 'UNKNOWN' end"


_KEYED = lambda c: f"coalesce(translate(upper({O.strip(c)}), '{P.LOOKS_LATIN}', '{P.LOOKS_CYRILLIC}'), '')"
_DOCS = f"select *, 'doc_' || translate(code, '.-', '__') as id, case when process_id is null then 'UNKNOWN' else {_map('process_id[1]', G.GROUPS)} end as \"group\", {_map('type', G.TYPES)} as type_name from (select code, meta_id as ordinal, type, process, version, case when process != '' then split_part(process, '.', 1) end as process_id from codes where code is not null qualify row_number() over (partition by code order by meta_id) = 1)"
_NODES = (
    f"select '{G.ROOT[0]}' as id, '{G.ROOT[1]}' as label, 'root' as node_type, null as \"group\", null as process union all select distinct 'group_' || \"group\", \"group\", 'process_group', \"group\", null from docs where process_id is not null "
    "union all select distinct 'process_' || process_id, process_id, 'process', \"group\", process_id from docs where process_id is not null union all select distinct 'type_' || coalesce(process_id, 'UNKNOWN') || '_' || type_name, type_name, 'doc_type', \"group\", coalesce(process_id, 'UNKNOWN') from docs union all select id, code, 'document', \"group\", process_id from docs"
)
_ALL_REFS = "list_concat(" * 6 + f"regexp_extract_all(content, {O.lit(P.re2(P.REFERENCES[0]))})" + "".join(f", regexp_extract_all(content, {O.lit(P.re2(p))}))" for p in P.REFERENCES[1:])
_REFS = f"select distinct doc_id as code, ref from (select doc_id, upper(unnest({_ALL_REFS})) as ref from blocks where content is not null) where ref != upper(coalesce(doc_id, ''))"
_PAIRS = f"select distinct a.id as source, b.id as target from refs r join docs a on {_KEYED('r.code')} = {_KEYED('a.code')} join docs b on {_KEYED('r.ref')} = {_KEYED('b.code')} where a.id != b.id"
_EDGES = (
    "select * from (select distinct 'root_smk' as source, 'group_' || \"group\" as target, 'hierarchy' as edge_type from docs where process_id is not null union all select distinct 'group_' || \"group\", 'process_' || process_id, 'hierarchy' from docs where process_id is not null and \"group\" != 'UNKNOWN' "
    "union all select distinct coalesce('process_' || process_id, 'group_UNKNOWN'), 'type_' || coalesce(process_id, 'UNKNOWN') || '_' || type_name, 'hierarchy' from docs union all select 'type_' || coalesce(process_id, 'UNKNOWN') || '_' || type_name, id, 'contains' from docs union all select source, target, 'references' from ref_pairs) where source in (select id from nodes) and target in (select id from nodes)"
)
_G = {"codes": _codes(), "docs": _DOCS, "nodes": _NODES, "refs": _REFS, "ref_pairs": _PAIRS, "edges": _EDGES}
_LATEST = "select regexp_replace(code, '-\\d+$', '') as base, arg_max(code, {'v': try_cast(version as int), 'o': -ordinal}) as code, arg_max(version, {'v': try_cast(version as int), 'o': -ordinal}) as version from docs where try_cast(version as int) is not null group by 1"
_CKEY = lambda c: f"translate(replace(upper(trim({c})), ' ', ''), '/.', '--')"
_WORDS = lambda c: f"list_distinct(list_filter(regexp_split_to_array(lower(coalesce({c}, '')), {O.lit(P.BLANK + '+')}), lambda x: x != ''))"


def _g(body: str, **more: str) -> str:
    return O.sql(body, "meta", "blocks", **_G, **more)


SQL = {
    "document_codes": _g(f"select *, {_KEYED('code')} as key from codes"),
    "process_groups": _g("select code, process_id, \"group\", type_name, id from docs"),
    "file_listing": O.sql(f"select source_file, {_CODE} as code, meta_id from meta where ends_with(lower(source_file), '.pdf') and not contains(lower(source_file), 'для печати') order by source_file, meta_id limit 50", "meta"),
    "block_references": O.sql(f"select block_no, array_to_string(list_sort(list_distinct(r)), ',') as refs from (select block_no, list_filter(list_transform({_ALL_REFS}, lambda x: upper(x)), lambda x: x != upper(coalesce(doc_id, ''))) as r from blocks where content is not null) where len(r) > 0", "blocks"),
    "reference_pairs": _g("select * from ref_pairs"),
    "graph_nodes": _g("select * from nodes"),
    "graph_edges": _g("select * from edges"),
    "graph_degrees": _g("select id, count(*) as degree from (select source as id from edges union all select target from edges) group by 1"),
    "latest_versions": _g(_LATEST),
    "pruned_nodes": _g("select id, node_type from nodes where node_type != 'document' or id in (select 'doc_' || translate(code, '.-', '__') from lv) or id in (select source from ref_pairs) or id in (select target from ref_pairs)", lv=_LATEST),
    "graph_statistics": _g("select 'type' as by, type_name as value, count(*) as n from docs group by 2 union all select 'group', \"group\", count(*) from docs group by 2 union all select 'process', process_id, count(*) from docs where process_id is not null group by 2"),
    "top_processes": _g("select process_id, count(*) as n from docs where process_id is not null group by 1 order by n desc, process_id limit 10"),
    "node_info": _g("select source as start, target as id, 'out' as direction, edge_type from edges where source in (select id from nodes where node_type = 'process') union all select target, source, 'in', edge_type from edges where target in (select id from nodes where node_type = 'process')"),
    "node_search": _g("select id, node_type, label from nodes where (node_type = 'root' or (node_type != 'doc_type' and \"group\" = 'M')) and node_type != 'doc_type' and (contains(lower(label), 'м1') or contains(lower(coalesce(process, '')), 'м1'))"),
    "node_layout": _g("select id, band, k // 10 as row, k % 10 as col from (select id, case node_type when 'root' then 0 when 'process_group' then 1 when 'process' then 2 when 'doc_type' then 3 else 4 end as band, row_number() over (partition by node_type order by coalesce(process, ''), label, id) - 1 as k from nodes)"),
    "catalogue_matches": O.sql(f"select meta_id, coalesce(e, f) as docx_id, case when e is not null then 'exact' when f is not null then 'prefix' else 'none' end as how from (select d.meta_id, (select max(docx_id) from cat where key = d.code) as e, (select min(docx_id) from (select key, max(docx_id) as docx_id from cat group by 1) where starts_with(key || '-', d.base)) as f from d)", "meta", "docx", cat=f"select {_CKEY('doc_number')} as key, docx_id from docx where doc_number is not null", d=f"select meta_id, code, regexp_replace(code, '-\\d+$', '-') as base from (select meta_id, {_CKEY('doc_id')} as code from meta where doc_id is not null)"),
    "paired_documents": O.sql(f"select meta_id, docx_id, round(s, 6) as similarity, s >= 0.5 as valid from (select meta_id, docx_id, case when len(x) = 0 or len(y) = 0 then 0.0 else len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) end as s from (select meta_id, docx_id, {_WORDS('m.title')} as x, {_WORDS('d.title')} as y from meta m join docx d on {_KEYED('m.doc_id')} = {_KEYED('d.doc_number')} and {_KEYED('m.doc_id')} != ''))", "meta", "docx"),
    "written_dates": O.sql("select docx_id, cast(case when m > 0 then try_strptime(regexp_extract(approval_date, '(\\d{4})', 1) || '-' || m || '-' || regexp_extract(approval_date, '(\\d{1,2})', 1), '%Y-%m-%d') else try_strptime(approval_date, '%d.%m.%Y') end::date as varchar) as approved from (select docx_id, approval_date, coalesce(list_position([" + ", ".join(map(O.lit, _MONTHS)) + "], regexp_extract(approval_date, '([а-я]+)\\s+\\d{4}', 1)), 0) as m from docx where approval_date is not null)", "docx"),
}
