"""Layout blocks: types, lists, parents, reading order, page measures, Markdown.

Block rows have doc_id, page, seq, block_no, type, content, bbox and metadata.
Order within a document is page, seq, block_no; null documents form one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators import ordered

ORDER = ["page", "seq", "block_no"]


def heading_types(rows: DataFrame) -> DataFrame:
    """Blocks with ``kind`` and ``level``: text blocks become headings by number, capitals, font size or bold type.

    The mean font size of a document counts only text and paragraph blocks and
    is 12 where none has one; a missing size counts as the mean.
    """
    size = F.col("metadata")["font_size"].try_cast("double")
    rows = rows.withColumn("font", F.when(size > 0, size))
    means = rows.where(F.col("type").isin("text", "paragraph") & F.col("font").isNotNull()).groupBy("doc_id").agg((F.sum("font") / F.count("font")).alias("mean_font")).withColumnRenamed("doc_id", "__d")
    rows = rows.join(means, F.col("doc_id").eqNullSafe(F.col("__d")), "left").drop("__d").withColumn("mean_font", F.coalesce("mean_font", F.lit(12.0)))
    t, mean, font = T.strip(F.coalesce("content", F.lit(""))), F.col("mean_font"), F.coalesce("font", "mean_font")
    numbered = t.rlike(P.either(P.HEADING_PATTERNS))
    level = F.when(numbered & t.rlike(r"^\d+\.\d+\.\d+"), 3).when(numbered & t.rlike(r"^\d+\.\d+"), 2).otherwise(1)
    large = font > mean * 1.2
    level = F.when(large, F.when(font > mean * 1.5, 1).when(font > mean * 1.3, 2).otherwise(3)).otherwise(level)
    bold = F.coalesce(F.lower(F.col("metadata")["is_bold"]) == "true", F.lit(False)) & (F.length(t) < 100)
    level = F.when(bold, F.least(level, F.lit(2))).otherwise(level)
    texts = F.col("type").isin("text", "paragraph", "heading")
    head = texts & (numbered | large | bold)
    return rows.withColumns({"kind": F.when(head, "heading").otherwise(F.col("type")), "level": F.when(head, level).when(F.col("type") == "heading", 1)})


def lists(rows: DataFrame) -> DataFrame:
    """Blocks with ``list_no`` and ``list_type``: neighbouring list items share a number, any other block ends a list."""
    t = T.strip(F.coalesce("content", F.lit("")))
    item = F.col("kind").isin("text", "paragraph") & (t.rlike(P.LIST_ORDERED) | t.rlike(P.LIST_UNORDERED))
    rows = rows.withColumn("item", item)
    rows = ordered.before(rows, "doc_id", "page", ORDER, F.col("item"), "was")
    rows = ordered.running_sum(rows, "doc_id", "page", ORDER, F.col("item") & ~F.coalesce("was", F.lit(False)), "n")
    return rows.withColumns({"list_no": F.when(F.col("item"), F.col("n")), "list_type": F.when(F.col("item"), F.when(t.rlike(P.LIST_ORDERED), "ordered").otherwise("unordered")), "kind": F.when(F.col("item"), "list").otherwise(F.col("kind"))}).drop("was", "n", "item")


def parents(rows: DataFrame) -> DataFrame:
    """Blocks with ``parent``: the nearest heading before of a smaller level; other blocks hang on the last heading."""
    rows = rows.withColumn("__level", F.when(F.col("kind") == "heading", F.col("level")))
    return ordered.nearest_lower(rows, "doc_id", "page", ORDER, "__level", F.col("id"), "parent", (1, 2, 3)).drop("__level")


def reading_order(rows: DataFrame, top_down: bool = False) -> DataFrame:
    """Blocks with ``rank`` in their document: page, then -y1 (or y0 when ``top_down``), then x0, then seq.

    Ranks are counted within pages and the sizes of the pages before are added.
    """
    y = F.col("bbox.y0") if top_down else -F.col("bbox.y1")
    rows = rows.withColumns({"__y": F.coalesce(y, F.lit(0.0)), "__x": F.coalesce("bbox.x0", F.lit(0.0))})
    return ordered.running_sum(rows, "doc_id", "page", ["page", "__y", "__x", "seq", "block_no"], F.lit(1), "rank").drop("__y", "__x")


def order_edges(rows: DataFrame) -> DataFrame:
    """doc_id, source, target, sequence: each block and the next in reading order, counted from 0."""
    r = reading_order(rows)
    nxt = r.select(F.col("doc_id").alias("__d"), (F.col("rank") - 1).alias("__r"), F.col("block_no").alias("target"))
    return r.join(nxt, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("rank") == F.col("__r"))).select("doc_id", F.col("block_no").alias("source"), "target", (F.col("rank") - 1).alias("sequence"))


def in_band(y0: Column, y1: Column, height: float, top: float = 0.08, bottom: float = 0.95, most: float = 0.12) -> Column:
    """Whether a box lies in the header or footer band of its page."""
    return (y1 - y0 <= height * most) & ((y1 <= height * top) | (y0 >= height * bottom))


def page_measures(rows: DataFrame, width: float = 595.0, height: float = 842.0, gap: float = 50.0) -> DataFrame:
    """One row per page: text layer, density, columns, layout, images, drawings, share of the page under graphics.

    Columns are the text boxes' x spans merged over gaps up to ``gap``.  Pages
    without boxes have no columns.
    """
    area = (F.col("bbox.x1") - F.col("bbox.x0")) * (F.col("bbox.y1") - F.col("bbox.y0"))
    is_text, graphic = F.col("type").isin("text", "paragraph", "heading", "list"), F.col("type").isin("image", "figure", "vector")
    chars = F.length(T.strip(F.coalesce("content", F.lit(""))))
    page = rows.groupBy("doc_id", "page").agg(
        F.sum(F.when(is_text, chars).otherwise(0)).alias("chars"),
        F.count_if(is_text & F.col("bbox").isNotNull()).alias("n_text"),
        F.count_if(F.col("type").isin("image", "figure")).alias("n_images"),
        F.count_if(F.col("type") == "vector").alias("n_drawings"),
        F.count_if(F.col("type") == "table").alias("n_tables"),
        F.coalesce(F.least(F.sum(F.when(graphic, area)) / (width * height), F.lit(1.0)), F.lit(0.0)).alias("coverage"),
    )
    x = rows.where(is_text & F.col("bbox").isNotNull()).select("doc_id", "page", F.col("bbox.x0").alias("x0"), F.col("bbox.x1").alias("x1"), "block_no")
    w = Window.partitionBy("doc_id", "page").orderBy("x0", "x1", "block_no")
    starts = x.withColumn("reach", F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))).groupBy("doc_id", "page").agg(F.count_if(F.col("reach").isNull() | (F.col("x0") - F.col("reach") > gap)).alias("n_columns"))
    starts = starts.select(F.col("doc_id").alias("__d"), F.col("page").alias("__p"), "n_columns")
    page = page.join(starts, F.col("doc_id").eqNullSafe(F.col("__d")) & F.col("page").eqNullSafe(F.col("__p")), "left").drop("__d", "__p").withColumn("n_columns", F.coalesce("n_columns", F.lit(0)))
    n = F.col("n_columns")
    layout = F.when(F.col("n_text") == 0, "unknown").when((F.col("n_text") < 2) | (n == 1), "single_column").when(n == 2, "multi_column").when(F.col("n_text") > 10, "newspaper").otherwise("complex")
    return page.withColumns({"has_text": F.col("chars") > 0, "density": F.floor(F.col("chars") * 0.25), "layout": layout})


def routed(measures: DataFrame, low: float = 0.3, high: float = 0.7, dense: int = 2000) -> DataFrame:
    """Pages with ``route`` (native, ocr, hybrid) and the number of the rule that decided, the first that holds."""
    c = F.col("coverage")
    rule = F.when(~F.col("has_text"), 1).when(F.col("layout") == "newspaper", 2).when(F.col("layout") == "complex", 3).when(c > high, 4).when((c > low) & ((F.col("n_images") > 0) | (F.col("n_drawings") > 5)), 5).when(F.col("density") > dense, 6).otherwise(7)
    return measures.withColumns({"rule": rule, "route": F.when(rule == 7, "native").when(rule == 5, "hybrid").otherwise("ocr")})


def identified(rows: DataFrame, prefix: str = "block") -> DataFrame:
    """Blocks with a ``uid`` that the same input always gets."""
    return rows.withColumn("uid", F.concat_ws("_", F.lit(prefix), "seq", F.substring(F.sha2(F.concat_ws("|", "doc_id", "type", F.col("seq").cast("string")), 256), 1, 8)))
