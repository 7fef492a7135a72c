"""Section trees: numbers, parents, texts, order.

Input rows are headings or lines with a key (one document), a position and a
text.  All operators keep one flat row per section; nesting happens at sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.shared import kept
from docloom.operators import ordered

HEADING = r"^(?:#{1,6}\s+)?(?:\*\*)?(\d+(?:\.\d+)*)\**\s+(.+?)$"


def headings(rows: DataFrame, key: str) -> DataFrame:
    """key, line_no, num, level, title, kind of the numbered, appendix and service headings among Markdown lines."""
    text = F.regexp_replace(T.strip(F.col("line")), r"^#{1,6}\s+", "")
    marked = T.strip(F.col("line")).rlike(r"^#{1,6}\s+")
    s = T.section(text)
    out = rows.where(marked & ~T.is_tree_garbage(text)).select(key, "line_no", s.alias("s"))
    return out.select(key, "line_no", "s.num", "s.level", "s.title", "s.kind").where("kind != 'unknown'")


def tree(heads: DataFrame, key: str, width: int = 200, levels: tuple[int, ...] = (0, 1, 2, 3, 4, 5, 6)) -> DataFrame:
    """key, pos, id, num, title, level, kind, parent_id of every section.

    The first heading of an id stays, service sections all stay and are
    numbered by the ids seen before them.  Sections of level 0 and 1 hang on
    the root (null); others on the nearest section before them of a smaller
    level, a service section too.
    """
    h = heads.withColumn("sid", T.section_id(F.col("num"), F.col("kind"))).withColumn("__chunk", F.floor(F.col("line_no") / width))
    first = h.where("kind != 'service'").groupBy(key, "sid").agg(F.min("line_no").alias("__first"))
    h = h.join(first, [key, "sid"], "left").where("kind = 'service' or line_no = __first").drop("__first")
    h = ordered.running_sum(h, key, "__chunk", ["line_no"], F.lit(1), "pos")
    h = h.withColumn("id", F.when(F.col("kind") == "service", F.concat(F.lit("service_"), (F.col("pos") - 1).cast("string"))).otherwise(F.col("sid")))
    h = ordered.nearest_lower(h, key, "__chunk", ["line_no"], "level", F.col("id"), "parent_id", levels)
    return h.select(key, F.col("line_no").alias("at"), "pos", "id", "num", "title", "level", "kind", F.when(F.col("level") > 1, F.col("parent_id")).alias("parent_id"))


def texts(rows: DataFrame, key: str, width: int = 200) -> DataFrame:
    """key, num, content: the lines from each numbered line to the next; the last of equal numbers stays.

    Lines before the first number are dropped.
    """
    t = rows.withColumn("__num", F.regexp_extract("line", HEADING, 1)).withColumn("__chunk", F.floor(F.col("line_no") / width))
    t = ordered.last_known(t, key, "__chunk", ["line_no"], F.when(F.col("__num") != "", F.struct(F.col("line_no").alias("at"), F.col("__num").alias("num"))), "__sec").where("__sec is not null")
    whole = t.groupBy(key, F.col("__sec.at").alias("at"), F.col("__sec.num").alias("num")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("content"))
    return whole.groupBy(key, "num").agg(F.max_by("content", "at").alias("content")).withColumn("content", T.strip(F.col("content")))


def with_content(sections: DataFrame, content: DataFrame, key: str) -> DataFrame:
    """Sections with the text of their number, '' without one, and whether it asks for an action."""
    c = content.select(F.col(key).alias("__k"), F.col("num").alias("__n"), "content")
    out = sections.join(c, (F.col(key) == F.col("__k")) & (F.col("num") == F.col("__n")), "left").drop("__k", "__n")
    return out.withColumn("content", F.coalesce("content", F.lit(""))).withColumn("actionable", T.is_actionable(F.col("content")))


def paths(sections: DataFrame, key: str, most_depth: int = 8) -> DataFrame:
    """Sections with ``path``, the positions from the root down, which sorts a tree in pre-order.

    Parents are looked up one level at a time: as many joins as the tree is
    deep, each on document and id.
    """
    sections = kept(sections)
    up = sections.select(F.col(key).alias("__k"), F.col("id").alias("__i"), F.col("parent_id").alias("__up"), F.col("pos").alias("__pos"))
    out = sections.withColumn("path", F.array("pos")).withColumn("__next", F.col("parent_id"))
    for _ in range(most_depth - 1):
        u = up.select("__k", "__i", F.col("__up").alias("__u2"), "__pos")
        out = out.join(u, (F.col(key) == F.col("__k")) & (F.col("__next") == F.col("__i")), "left")
        out = out.withColumn("path", F.when(F.col("__pos").isNotNull(), F.concat(F.array("__pos"), F.col("path"))).otherwise(F.col("path"))).withColumn("__next", F.col("__u2")).drop("__k", "__i", "__u2", "__pos")
    return out.drop("__next")


def statistics(sections: DataFrame, key: str) -> DataFrame:
    """Nodes, depth, nodes by level and actionable nodes of every tree."""
    per = sections.groupBy(key, "level").agg(F.count(F.lit(1)).alias("n"), F.count_if("actionable").alias("a"))
    return per.groupBy(key).agg(F.sum("n").alias("n_nodes"), F.max("level").alias("max_depth"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("level", "n"))), lambda x: F.concat_ws(":", x["level"], x["n"])), ",").alias("by_level"), F.sum("a").alias("n_actionable"))
