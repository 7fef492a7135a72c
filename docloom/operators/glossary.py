"""Glossaries: term blocks from lines, their definitions, roles and tasks.

Lines have a key, line_no and line, and belong to one document per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators import ordered


def between(rows: DataFrame, key: str, start: str) -> DataFrame:
    """The lines after the first line that matches ``start`` and is no line of contents, up to the next '# N' line."""
    rows = rows.withColumn("__t", T.strip(F.col("line")))
    first = rows.where(F.col("__t").rlike(P.java(start)) & ~T.is_toc_line(F.col("__t"))).groupBy(key).agg(F.min("line_no").alias("__start"))
    end = rows.join(first, key).where((F.col("line_no") > F.col("__start")) & F.col("__t").rlike(r"^#\s+\d+[.\s]")).groupBy(key).agg(F.min("line_no").alias("__end"))
    out = rows.join(first, key).join(end, key, "left")
    return out.where((F.col("line_no") > F.col("__start")) & (F.col("__end").isNull() | (F.col("line_no") < F.col("__end")))).drop("__t", "__start", "__end")


def scoped(rows: DataFrame, key: str, skip: str, keep: str, width: int = 256) -> DataFrame:
    """The lines without the parts that ``skip`` headings open; all of them where neither heading occurs."""
    mark = F.when(F.col("line").rlike(P.java(keep)), F.lit(1)).when(F.col("line").rlike(P.java(skip)), F.lit(0))
    rows = ordered.last_known(rows.withColumn("__g", F.floor(F.col("line_no") / width)), key, "__g", ["line_no"], mark, "__in")
    return rows.where("coalesce(__in, 1) = 1").drop("__g", "__in")


def term_blocks(rows: DataFrame, key: str, doc: Column, width: int = 256) -> DataFrame:
    """key, block_no, block: lines joined to blocks; a line 'Term - text' that begins with no small letter opens one, a sub-heading ends one."""
    t = T.strip(F.col("line"))
    head = (F.length(F.coalesce(doc, F.lit(""))) > 0) & F.contains(F.col("line"), F.coalesce(doc, F.lit(""))) & (F.length(t) < 200)
    sub = t.rlike(r"^#{2,3} ")
    table = t.startswith("|")
    clean = F.when(table, T.strip(F.regexp_replace(t, r"^\||\|$", ""))).otherwise(t)
    rows = rows.withColumns({"__s": sub, "__cell": clean, "__tab": table}).where(~T.is_glossary_junk(F.col("line")) & ~head & (t != "") & ~(table & ((clean == "") | clean.startswith("-"))))
    rows = rows.withColumn("__g", F.floor(F.col("line_no") / width))
    rows = ordered.before(rows, key, "__g", ["line_no"], F.col("__s"), "__after")
    opens = F.col("__s") | F.coalesce("__after", F.lit(True)) | (F.col("__cell").rlike(P.TERM) & (F.col("__tab") | ~F.substring("__cell", 1, 1).rlike(r"\p{Ll}")))
    rows = ordered.running_sum(rows, key, "__g", ["line_no"], opens, "block_no").where(~F.col("__s"))
    return rows.groupBy(key, "block_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "__cell"))), lambda x: x["__cell"]), " ").alias("block"))


def definition(block: Column) -> Column:
    """term and definition of a block; null where it is no definition but a fragment, a number or garbled text."""
    term = F.regexp_replace(T.squeeze(F.regexp_extract(block, P.TERM, 1)), "^[•·▪►●■○◆★☆✓✔ ]+", "")
    text = T.squeeze(F.regexp_extract(block, P.TERM, 2))
    bad = (F.length(term) < 2) | (F.length(text) < 15) | term.rlike(r"^\d+[.)]\s") | term.rlike("^[–—(]") | term.rlike(r"^\d+\.?\s*$") | text.rlike(r"^\d+\.?\s*$")
    thrice = "([а-яА-ЯёЁ])\\1{2,}"
    bad = bad | term.rlike(thrice) | text.rlike(thrice) | term.rlike("[а-яА-ЯёЁ]{25,}")
    bad = bad | ((F.length(text) > 50) & (F.regexp_count(text, F.lit(" ")) / F.length(text) < 0.05))
    return F.when(~bad & block.rlike(P.TERM), F.struct(term.alias("term"), text.alias("definition")))


def english_term(text: Column) -> Column:
    """The term in an English definition: in brackets, before a dash, or the whole short text."""
    t = T.strip(text)
    inner = T.strip(F.regexp_extract(t, r"^\(([^)]*)\)", 1))
    dash = T.strip(F.regexp_extract(t, r"^(.+?)(?: [-–] |– |— )", 1))
    return F.when(t == "", "").when(t.rlike(r"^\(.*\)"), inner).when((F.length(dash) > 1) & (F.length(dash) < 100), dash).when(F.length(t) < 60, F.regexp_replace(t, r"[.,;: ]+$", "")).otherwise("")


def roles(text: Column) -> Column:
    """The distinct 'word role' phrases of a text, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(P.java(rf"([\p{{L}}\p{{N}}_]+\s+(?:{P.ROLES}))")), F.lit(1)), lambda x: T.squeeze(F.lower(x)))))


def tasks(text: Column) -> Column:
    """The distinct task phrases of a text, sorted: over five signs, at most 100."""
    found = F.regexp_extract_all(text, F.lit(P.java(rf"((?:{P.TASKS})\s+[а-я\s]+)")), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda x: F.substring(T.squeeze(F.lower(x)), 1, 100)), lambda x: F.length(x) > 5)))
