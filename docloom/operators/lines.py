"""Lines of pages: repeats, classes, reasons, cleaning.

Line tables have doc_id, page, line_no and line.  Null texts have no lines, an
empty text has one empty line; extra columns are carried along where a line is
returned and ignored where lines are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators import ordered


def lines(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per line of ``text`` with its 0-based number; a narrow operator."""
    return df.where(F.col(text).isNotNull()).select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def repeated(rows: DataFrame, doc: str = "doc_id", page: str = "page", line: str = "line", threshold: float = 0.5) -> DataFrame:
    """doc, line (normalised), n_pages, pages: lines on more than ``threshold`` of a document's pages.

    Distinct lines per page are counted with map-side combining; pages without
    lines still count.  Rows with a null document or page are left out, ties at
    the threshold are not repeats.
    """
    rows = rows.where(F.col(doc).isNotNull() & F.col(page).isNotNull()).select(F.col(doc).alias("doc"), F.col(page).alias("page"), T.normal_line(F.col(line)).alias("norm"))
    per_page = rows.where("norm is not null and norm != ''").distinct()
    counts = per_page.groupBy("doc", "norm").agg(F.count(F.lit(1)).alias("n_pages"))
    pages = rows.select("doc", "page").distinct().groupBy("doc").agg(F.count(F.lit(1)).alias("pages"))
    return counts.join(pages, "doc").where(F.col("n_pages") > F.col("pages") * threshold).select(F.col("doc").alias(doc), F.col("norm").alias("line"), "n_pages", "pages")


def with_reasons(rows: DataFrame, repeats: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The lines with ``reason``: why each is dropped or kept."""
    keys = repeats.select(F.col(doc).alias("__doc"), F.col("line").alias("__norm"))
    hit = rows.withColumn("__n", T.normal_line(F.col("line"))).join(keys, (F.col(doc) == F.col("__doc")) & (F.col("__n") == F.col("__norm")), "left")
    return hit.withColumn("reason", T.line_reason(F.col("line"), F.col("__norm").isNotNull())).drop("__doc", "__norm", "__n")


def cleaned(rows: DataFrame, key: str, width: int = 200) -> DataFrame:
    """key, line_no, line of Markdown lines that are content.

    Dropped are garbage lines, mostly Latin ones, the change log up to the next
    heading, and blank lines after a blank one.  Lines are cut into chunks of
    ``width`` so that no window spans a whole document.
    """
    t = T.strip(F.col("line"))
    rows = rows.withColumn("__chunk", F.floor(F.col("line_no") / width))
    mark = F.when(t.rlike(P.java(P.CHANGE_LOG)), F.lit(True)).when(t.rlike(P.java(P.MARKDOWN_HEADING)), F.lit(False))
    rows = ordered.last_known(rows, key, "__chunk", ["line_no"], mark, "__log").where(~F.coalesce("__log", F.lit(False)) & ~T.is_markdown_garbage(t))
    rows = ordered.before(rows, key, "__chunk", ["line_no"], t == "", "__blank")
    return rows.where(~((t == "") & F.coalesce("__blank", F.lit(False)))).drop("__chunk", "__log", "__blank")


def joined(rows: DataFrame, key: str, out: str = "text", order: Column | None = None) -> DataFrame:
    """key and all its lines in order as one text."""
    order = F.col("line_no") if order is None else order
    parts = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("line").alias("l"))))
    return rows.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["l"]), "\n").alias(out))


def typed(rows: DataFrame) -> DataFrame:
    """Markdown lines as typed blocks: type, level and content; blank lines are left out."""
    c = F.col("line")
    kind = F.when(c.startswith("#"), "heading").when(c.rlike(r"^[-*+] "), "list_item").when(c.startswith("|"), "table_row").when(c.startswith("```"), "code_block").when(c.startswith(">"), "quote").otherwise("paragraph")
    return rows.where(T.strip(c) != "").withColumns({"type": kind, "level": F.when(kind == "heading", F.length(F.regexp_extract(c, "^(#+)", 1))).otherwise(1), "content": T.strip(c)})
