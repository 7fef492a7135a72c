"""Tables as matrices: validity, fill-down, headers, records across rows.

Cell rows have table_id, row, col and value.  A row-wise operator works on the
matrix column itself and stays in code generation; what crosses rows works on
cells, partitioned by table and column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T


def filled(c: Column) -> Column:
    """Whether a cell holds anything but blanks."""
    return F.coalesce(T.strip(c) != "", F.lit(False))


def valid(matrix: Column, most: float = 0.85) -> Column:
    """Two rows, two columns, and no column with more than ``most`` of all characters; false for null."""
    width = F.array_max(F.transform(matrix, lambda r: F.size(r)))
    chars = F.transform(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), lambda k: F.aggregate(matrix, F.lit(0), lambda a, r: a + F.coalesce(F.length(T.strip(F.get(r, k))), F.lit(0))))
    total = F.aggregate(chars, F.lit(0), lambda a, x: a + x)
    return F.coalesce((F.size(matrix) >= 2) & (width >= 2) & ((total == 0) | (F.array_max(chars) <= total * most)), F.lit(False))


def is_data_row(row: Column) -> Column:
    """Whether the first filled cell holds a figure and is no number sign."""
    first = F.get(F.filter(row, filled), F.lit(0))
    t = T.strip(first)
    return F.coalesce(~t.startswith("№") & t.rlike(r"\d") & (~t.contains("№") | t.rlike(r"\d{1,2}[./]\d{1,2}[./]\d{2,4}")), F.lit(False))


def cells(matrices: DataFrame, key: str, matrix: str) -> DataFrame:
    """One row per cell; rows are padded with null to the widest one."""
    width = F.array_max(F.transform(matrix, lambda r: F.size(r)))
    rows = matrices.where(F.size(matrix) > 0).select(key, width.alias("__w"), F.posexplode(matrix).alias("row", "__r"))
    return rows.select(key, "row", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("__w") - 1), lambda k: F.get(F.col("__r"), k))).alias("col", "value"))


def filled_down(rows: DataFrame, key: str) -> DataFrame:
    """Cells with null ones filled from the last filled cell above; blank ones stay and do not end a value."""
    w = Window.partitionBy(key, "col").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    above = F.last(F.when(filled(F.col("value")), F.col("value")), ignorenulls=True).over(w)
    return rows.withColumn("value", F.coalesce("value", above))


def collapsed_header(rows: DataFrame, key: str, header_rows: int = 2) -> DataFrame:
    """key, col, header: the distinct filled header cells of each column from the top, joined by ' / '; tables without any are left out."""
    h = rows.where((F.col("row") < header_rows) & filled(F.col("value"))).withColumn("v", T.strip(F.translate("value", "\n", " ")))
    first = h.groupBy(key, "col", F.lower("v").alias("l")).agg(F.min(F.struct("row", "v")).alias("f"))
    return first.groupBy(key, "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list("f")), lambda x: x["v"]), " / ").alias("header"))


def numbered_records(rows: DataFrame, key: str, cells_col: str = "cells", order: str = "row", repeats_open: bool = True) -> DataFrame:
    """Rows with ``number`` and ``record``: a row whose first cell is a number of one to four digits opens a record.

    Rows before the first number are dropped; of records with one number the
    last stays.  Without ``repeats_open`` the same number again opens none.
    """
    first = T.strip(F.coalesce(F.get(F.col(cells_col), F.lit(0)), F.lit("")))
    w = Window.partitionBy(key).orderBy(order)
    rows = rows.withColumn("__n", F.when(first.rlike(r"^\d{1,4}$"), first.cast("int")))
    opens = F.col("__n").isNotNull()
    if not repeats_open:
        rows = rows.withColumn("__p", F.last("__n", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        opens = opens & ~F.col("__n").eqNullSafe(F.col("__p"))
    rows = rows.withColumn("record", F.sum(opens.cast("int")).over(w)).where("record > 0")
    rows = rows.withColumn("number", F.first("__n").over(Window.partitionBy(key, "record").orderBy(order)))
    last = rows.groupBy(key, "number").agg(F.max("record").alias("record"))
    return rows.join(last, [key, "number", "record"], "left_semi").drop("__n", "__p")


def merged(rows: DataFrame, key: str, first_of: tuple[int, ...] = (4, 5, 6, 7, 8, 9), cells_col: str = "cells", order: str = "row") -> DataFrame:
    """key, number, cells: the rows of each record as one: the first value of code and amount columns, all of the others joined."""
    c = rows.select(key, "number", F.col(order).alias("__o"), F.posexplode(cells_col).alias("col", "v")).withColumn("v", T.null_tokens(F.col("v"))).where("v is not null")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__o", "v"))), lambda x: x["v"]), " ")
    one = c.groupBy(key, "number", "col").agg(F.when(F.col("col").isin(*first_of), F.min_by("v", "__o")).otherwise(joined).alias("v"))
    return one.groupBy(key, "number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "v"))), lambda x: F.concat_ws("=", x["col"], x["v"])), "; ").alias("cells"))


def shifted(row: Column, width: int) -> Column:
    """A row without its empty second cell where the first is a number; padded with null."""
    bad = (F.size(row) > 2) & T.strip(F.coalesce(F.get(row, F.lit(0)), F.lit(""))).rlike(r"^\d{1,4}$") & ~filled(F.get(row, F.lit(1)))
    moved = F.concat(F.slice(row, 1, 1), F.slice(row, 3, width), F.array(F.lit(None).cast("string")))
    return F.when(bad, moved).otherwise(row)


def table_kind(text: Column, markers: dict[str, tuple[str, ...]], other: str = "unknown") -> Column:
    """The first kind of which all markers stand in the text."""
    out = None
    for kind, words in markers.items():
        hit = text.isNotNull()
        for w in words:
            hit = hit & F.lower(text).contains(w.lower())
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise(other)


def html_rows(text: Column) -> Column:
    """array<array<string>> of the cells of all HTML table rows in a text, tags inside cells dropped."""
    rows = F.regexp_extract_all(text, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    return F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: T.strip(F.regexp_replace(c, r"<[^>]+>", ""))))


def pipe_cells(line: Column) -> Column:
    """The cells of a Markdown table row, without the outer bars."""
    return F.transform(F.split(F.regexp_replace(T.strip(line), r"^\||\|$", ""), r"\|"), lambda c: T.strip(c))
