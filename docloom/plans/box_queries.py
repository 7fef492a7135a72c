"""Queries over boxes on pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import boxes as X
from docloom.plans import oracle as O
from docloom.plans.line_queries import blocks

# Names of diagram elements.
LABELS = {"paragraph": "task", "heading": "start_event", "list": "task", "table": "data_object", "image": "gateway", "figure": "gateway", "vector": "sequence_flow"}


def _boxes(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    b = blocks(spark, sf_dir, "doc_id", "page", "seq", "type", "content", "bbox").where("doc_id is not null and page is not null and bbox is not null")
    b = b.where(F.col("type").isin(*kinds)) if kinds else b
    return b.select("doc_id", "page", F.col("block_no").alias("id"), "seq", "type", F.coalesce("content", F.lit("")).alias("text"), "bbox")


def box_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of blocks with common area (JOIN-08)."""
    b = _boxes(spark, sf_dir)
    return X.overlapping(b, b).select("left_id", "right_id", F.round("common", 2).alias("common"), F.round("share", 6).alias("share"))


def blocks_outside_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text blocks that lie in no table (FLT-25)."""
    return X.outside(_boxes(spark, sf_dir, "paragraph", "text"), _boxes(spark, sf_dir, "table")).select("id")


def element_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with the texts inside them (JOIN-09)."""
    return X.inner_texts(_boxes(spark, sf_dir, "heading", "list", "table", "figure"), _boxes(spark, sf_dir, "paragraph", "text", "unknown")).select("id", "text")


def flow_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest nodes on both sides of every drawing (JOIN-10)."""
    return X.connections(_boxes(spark, sf_dir, "paragraph", "heading", "image", "figure"), _boxes(spark, sf_dir, "vector", "table"))


def element_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category of every block as a diagram element, and whether it is a node or a flow (FLT-26)."""
    c = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), F.col("type")), F.lit("unknown"))
    return _boxes(spark, sf_dir).select("id", c.alias("category"), (~c.isin("sequence_flow", "unknown")).alias("is_node"), (c == "sequence_flow").alias("is_flow"))


def drawing_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of drawings and pictures of every page (ITR-01)."""
    return X.clusters(_boxes(spark, sf_dir, "vector", "image", "figure", "table"))


def graphic_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures and clusters of drawings over 10000 square points (ITR-02, SRC-04)."""
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    c = X.clusters(_boxes(spark, sf_dir, "vector", "table")).where(area >= 10000).select("doc_id", "page", F.lit("drawing").alias("type"), "n", F.round(area, 2).alias("area"))
    i = _boxes(spark, sf_dir, "image", "figure").select("doc_id", "page", "bbox.*").where(area >= 10000).select("doc_id", "page", F.lit("image").alias("type"), F.lit(1).alias("n"), F.round(area, 2).alias("area"))
    return i.unionByName(c)


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(spark, sf_dir).select("doc_id", "page", F.substring(F.regexp_replace("text", r"\s+", " "), 1, 60).alias("text"), "bbox.*")


def token_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every page from its boxes (WIN-13)."""
    return X.page_token_boxes(_tokens(spark, sf_dir), boxes=False)


def token_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that the lines of every page stack to (WIN-14)."""
    return X.page_token_boxes(_tokens(spark, sf_dir))


def diagram_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of every page from left to right, in lanes (GRF-06, FLT-18)."""
    return X.lanes(token_boxes(spark, sf_dir))


def diagram_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and connections of every page as JSON and as a list (GRF-05)."""
    c = flow_connections(spark, sf_dir)
    line = F.concat(F.lit("- "), F.col("source").cast("string"), F.lit(" -> "), F.col("target").cast("string"))
    return c.groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("n_connections"), F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("markdown"))


def grounded_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and boxes read back from tagged OCR answers (SCL-24)."""
    t = _boxes(spark, sf_dir).where("text not like '%<|%'")
    num = lambda c: F.format_string("%.1f", F.col(f"bbox.{c}"))
    tagged = t.select("id", F.concat(F.lit("<|ref|>"), F.trim("text"), F.lit("<|/ref|><|det|>[["), F.concat_ws(", ", *[num(c) for c in ("x0", "y0", "x1", "y1")]), F.lit("]]<|/det|>")).alias("answer"))
    return tagged.select("id", F.explode(X.grounded(F.col("answer"))).alias("g")).select("id", "g.text", *[F.round(F.element_at("g.box", k + 1), 1).alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"))])


def yolo_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training labels of every block, with classes numbered by a dimension table (JOIN-18, SCL-35, SNK-12)."""
    b = _boxes(spark, sf_dir)
    classes = spark.createDataFrame([(k, n) for n, k in enumerate(sorted(LABELS))], "type string, number int")
    return b.join(classes, "type").select("id", X.yolo("bbox", F.lit(595.0), F.lit(842.0), F.col("number")).alias("label"))


QUERIES = {f.__name__: f for f in (box_overlaps, blocks_outside_tables, element_texts, flow_connections, element_labels, drawing_clusters, graphic_regions, token_lines, token_boxes, diagram_lanes, diagram_markdown, grounded_tokens, yolo_labels)}

_B = "select doc_id, page, block_no as id, seq, type, coalesce(content, '') as text, bbox.x0 as x0, bbox.y0 as y0, bbox.x1 as x1, bbox.y1 as y1 from blocks where doc_id is not null and page is not null and bbox is not null"
_COMMON = "greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0.0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0.0)"
_AREA_B = "((b.x1 - b.x0) * (b.y1 - b.y0))"
_FLOWS = "select f.doc_id, f.page, f.id as flow, arg_min(n.id, {'d': d, 's': n.seq, 'i': n.id}) filter (src) as source, arg_min(n.id, {'d': d, 's': n.seq, 'i': n.id}) filter (not src) as target from (select a as f, b as n, sqrt(pow((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2, 2) + pow((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2, 2)) as d, case when a.x1 - a.x0 > a.y1 - a.y0 then (b.x0 + b.x1) / 2 < (a.x0 + a.x1) / 2 else (b.y0 + b.y1) / 2 < (a.y0 + a.y1) / 2 end as src from b a join b b on a.doc_id = b.doc_id and a.page = b.page and a.id != b.id where a.type in ('vector', 'table') and b.type in ('paragraph', 'heading', 'image', 'figure')) group by 1, 2, 3 having source is not null and target is not null"
_LABEL = "coalesce(" + "case type " + " ".join(f"when '{k}' then '{v}'" for k, v in LABELS.items()) + " end, 'unknown')"

SQL = {
    "box_overlaps": O.sql(f"select a.id as left_id, b.id as right_id, round({_COMMON}, 2) as common, round({_COMMON} / {_AREA_B}, 6) as share from b a join b b on a.doc_id = b.doc_id and a.page = b.page and a.id != b.id where {_COMMON} > 0", "blocks", b=_B),
    "blocks_outside_tables": O.sql(f"select b.id from b where type in ('paragraph', 'text') and not exists (select 1 from b a where a.type = 'table' and a.doc_id = b.doc_id and a.page = b.page and a.id != b.id and {_COMMON} > 0 and {_COMMON} / {_AREA_B} >= 1.0 - 1e-9)", "blocks", b=_B),
    "element_texts": O.sql(f"select a.id, string_agg(b.text, ' ' order by b.seq, b.id) as text from b a join b b on a.doc_id = b.doc_id and a.page = b.page and a.id != b.id where a.type in ('heading', 'list', 'table', 'figure') and b.type in ('paragraph', 'text', 'unknown') and {_COMMON} > 0 and {_COMMON} / {_AREA_B} > 0.3 group by 1", "blocks", b=_B),
    "flow_connections": O.sql(_FLOWS, "blocks", b=_B),
    "element_labels": O.sql(f"select id, c as category, c not in ('sequence_flow', 'unknown') as is_node, c = 'sequence_flow' as is_flow from (select id, {_LABEL} as c from b)", "blocks", b=_B),
    "diagram_markdown": O.sql(f"select doc_id, page, count(*) as n_connections, string_agg('- ' || source || ' -> ' || target, chr(10) order by '- ' || source || ' -> ' || target) as markdown from ({_FLOWS}) group by 1, 2", "blocks", b=_B),
    "grounded_tokens": O.sql("select id, trim(text) as text, round(x0, 1) as x0, round(y0, 1) as y0, round(x1, 1) as x1, round(y1, 1) as y1 from b where not contains(text, '<|')", "blocks", b=_B),
    "yolo_labels": O.sql("select id, printf('%d %.6f %.6f %.6f %.6f', n, (x0 + x1) / 2 / 595.0, (y0 + y1) / 2 / 842.0, (x1 - x0) / 595.0, (y1 - y0) / 842.0) as label from (select *, case type " + " ".join(f"when '{k}' then {n}" for n, k in enumerate(sorted(LABELS))) + " end as n from b) where n is not null", "blocks", b=_B),
}
