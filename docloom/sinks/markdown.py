"""Markdown and JSON texts of documents, as columns that any writer can store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T


def in_order(order: Column | str, value: Column, between: str = "\n") -> Column:
    """The values of a group as one text in order."""
    o = F.col(order) if isinstance(order, str) else order
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(o.alias("o"), value.alias("v")))), lambda x: x["v"]), between)


def structure(sections: DataFrame, key: str) -> DataFrame:
    """key, markdown: the sections as headings, one level below their own depth, six at most."""
    hashes = F.repeat(F.lit("#"), F.least(F.greatest(F.col("level"), F.lit(1)) + 1, F.lit(6)))
    name = F.when(F.col("num").isNull() | (F.col("title") == F.col("num")), F.col("title")).otherwise(F.concat_ws(" ", "num", "title"))
    return sections.groupBy(key).agg(in_order("pos", F.concat(hashes, F.lit(" "), name)).alias("markdown"))


def tree_json(sections: DataFrame, key: str) -> DataFrame:
    """key, json: the nodes with their parents, in document order."""
    node = F.struct("pos", "id", "num", "title", "level", "kind", "parent_id")
    return sections.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(node))).alias("json"))


def block(kind: Column, content: Column, level: Column, ordered: Column, bold: Column | None = None, italic: Column | None = None) -> Column:
    """One block as Markdown by its type; unknown types as they are."""
    t = T.strip(content)
    item = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"^[-•·]\s+", ""), r"^\d+\)\s+", ""), r"^[а-я]\)\s+", "")
    para = F.when(F.coalesce(bold, F.lit(False)), F.concat(F.lit("**"), t, F.lit("**"))).otherwise(t) if bold is not None else t
    para = F.when(F.coalesce(italic, F.lit(False)), F.concat(F.lit("*"), para, F.lit("*"))).otherwise(para) if italic is not None else para
    heading = F.concat(F.repeat(F.lit("#"), level), F.lit(" "), t, F.lit(" {#"), T.anchor(t), F.lit("}"))
    out = F.when(kind == "heading", heading).when(kind == "list", F.when(ordered, F.concat(F.lit("1. "), item)).otherwise(F.concat(F.lit("- "), item)))
    return out.when(kind.isin("text", "paragraph"), para).when(kind == "table", F.concat(F.lit("\n"), content, F.lit("\n"))).when(kind.isin("image", "figure", "vector"), F.concat(F.lit("!["), kind, F.lit("]("), t, F.lit(")"))).otherwise(content)


def front_matter(fields: dict[str, Column]) -> Column:
    """Fields as YAML between rules; null ones are left out, texts are quoted as JSON."""
    parts = []
    for name, c in fields.items():
        quoted = F.concat(F.lit(f"{name}: "), F.regexp_replace(F.to_json(F.struct(c.alias("v"))), r'^\{"v":|\}$', ""))
        parts.append(F.when(c.isNotNull(), quoted))
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *parts), F.lit("\n---"))


def table(matrix: Column) -> Column:
    """array<array<string>> as a Markdown table: blank rows dropped, rows padded, first row as header; '' without rows."""
    rows = F.filter(matrix, lambda r: F.exists(r, lambda c: F.coalesce(T.strip(c) != "", F.lit(False))))
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(F.transform(r, lambda c: T.cell(c)), F.array_repeat(F.lit(" "), F.greatest(width - F.size(r), F.lit(0)))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    lines = F.transform(rows, line)
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, 1_000_000)), "\n")).otherwise("")


def html(matrix: Column) -> Column:
    """array<array<string>> as an HTML table: the first row as head, no escaping; '' without rows."""
    cells = lambda r, tag: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, lambda c: F.concat(F.lit(f"<{tag}>"), F.coalesce(c, F.lit("")), F.lit(f"</{tag}>"))), ""), F.lit("</tr>"))
    body = F.array_join(F.transform(F.slice(matrix, 2, 1_000_000), lambda r: cells(r, "td")), "")
    return F.when(F.size(matrix) > 0, F.concat(F.lit("<table><thead>"), cells(F.element_at(matrix, 1), "th"), F.lit("</thead><tbody>"), body, F.lit("</tbody></table>"))).otherwise("")
