"""Record assembly and audits: markers, as-of joins, state machine, completeness.

Event tables have a key (one document), a position and values.  Positions that
must cross chunks of a document are carried as one row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import ordered


def valid(address: Column, quantity: Column) -> Column:
    """Whether a record has an address and a positive quantity; false for nulls."""
    return F.coalesce((T.strip(address) != "") & (quantity > 0), F.lit(False))


def validation(rows: DataFrame, *by: str) -> DataFrame:
    """Totals of valid and invalid records; quantities over valid, missing parts over invalid ones."""
    v = valid(F.col("address"), F.col("quantity"))
    bad = ~v
    blank = F.coalesce(T.strip(F.col("address")) == "", F.lit(True))
    none = F.coalesce(F.col("quantity") <= 0, F.lit(True))
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if(v).alias("valid"), F.count_if(bad).alias("invalid"), F.coalesce(F.sum(F.when(v, F.col("quantity"))), F.lit(0)).alias("quantity"), F.count_if(bad & blank).alias("missing_address"), F.count_if(bad & none).alias("missing_quantity"))
    return out.withColumn("quality", F.when(F.col("total") > 0, F.round(F.col("valid") * 100.0 / F.col("total"), 2)).otherwise(0.0))


def duplicates(rows: DataFrame, by: str, value: str, most: int = 5) -> DataFrame:
    """by, n, examples: values of ``by`` on more than one row, with the smallest ``most`` values; nulls are left out."""
    first = F.slice(F.array_sort(F.collect_set(F.col(value))), 1, most)
    counted = rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranked = rows.join(counted.select(by), by, "left_semi").select(by, value).distinct().withColumn("__k", F.row_number().over(Window.partitionBy(by).orderBy(value))).where(F.col("__k") <= most)
    return counted.join(ranked.groupBy(by).agg(F.array_join(F.transform(first, lambda x: x.cast("string")), ",").alias("examples")), by, "left")


def most_complete(rows: DataFrame, key: str, fields: list[str], order: str) -> DataFrame:
    """One row per key: the one with most fields filled, the first of equals."""
    score = sum((F.coalesce(F.col(f).cast("string") != "", F.lit(False)).cast("int") for f in fields), F.lit(0))
    best = F.max_by(F.struct(*rows.columns), F.struct(score, -F.col(order)))
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(best.alias("r"), F.max(score).alias("score")).select("r.*", "score")


def asof(markers: DataFrame, tables: DataFrame, doc: str = "doc", width: int = 256, forward: int = 5000, backward: int = 3000) -> DataFrame:
    """Markers with ``qty``: the first table after a marker and before the next one (at most ``forward`` on after the last),
    else the last table before it and after the one before (at most ``backward`` back from the first).

    Both tables are laid in one order and values carried along, so a document
    needs no join of all its markers with all its tables.  Inequalities are
    strict; a neighbouring marker at position 0 counts as missing.  Markers and
    tables at one position do not see each other.
    """
    m = markers.select(doc, "pos", F.lit(1).alias("is_marker"), F.lit(None).cast("bigint").alias("q"), "owner")
    t = tables.select(doc, "pos", F.lit(0).alias("is_marker"), F.col("qty").cast("bigint").alias("q"), F.lit(None).cast("string").alias("owner"))
    both = m.unionByName(t).withColumn("chunk", F.floor(F.col("pos") / width))
    mark = F.when(F.col("is_marker") == 1, F.col("pos"))
    table = F.when(F.col("is_marker") == 0, F.struct(F.col("pos").alias("p"), F.col("q").alias("q")))
    # a table at the marker's own position sorts after it going back and before it going on
    back = ordered.last_all(both.withColumn("o", 1 - F.col("is_marker")), doc, "chunk", ["pos", "o"], {"prev_m": mark, "prev_t": table}, strict=True)
    back = ordered.next_known(back, doc, "chunk", ["pos", "is_marker"], mark, "next_m")
    back = ordered.next_known(back, doc, "chunk", ["pos", "is_marker"], table, "next_t").where("is_marker = 1")
    end = F.when(F.col("next_m") != 0, F.col("next_m")).otherwise(F.col("pos") + forward)
    start = F.when(F.col("prev_m") != 0, F.col("prev_m")).otherwise(F.col("pos") - backward)
    on = F.when((F.col("next_t.p") > F.col("pos")) & (F.col("next_t.p") < end), F.col("next_t.q"))
    before = F.when((F.col("prev_t.p") > start) & (F.col("prev_t.p") < F.col("pos")), F.col("prev_t.q"))
    return back.select(doc, "pos", "owner", F.coalesce(on, before).alias("qty"), F.col("next_t.q").alias("qty_next"), F.when(on.isNotNull(), "forward").when(before.isNotNull(), "backward").otherwise("none").alias("how"))


def zipped(left: DataFrame, right: DataFrame, doc: str, order: str) -> DataFrame:
    """The i-th row of the left with the i-th of the right of one document; left rows beyond get null."""
    number = lambda df: ordered.running_sum(df.withColumn("__c", F.floor(F.col(order) / 256)), doc, "__c", ["__c", order], F.lit(1), "i").drop("__c")
    r = number(right).select(F.col(doc).alias("__d"), F.col("i").alias("__i"), F.col("value").alias("right_value"))
    l = number(left)
    return l.join(r, (l[doc] == r["__d"]) & (l["i"] == r["__i"]), "left").drop("__d", "__i")


def state_machine(events: DataFrame, doc: str, chunk: str, order: list[str]) -> DataFrame:
    """doc, record, address, quantity, complete: START opens a record and closes the one before, QUANTITY closes it.

    The last PERSONAL of a record gives its address; events outside a record
    are ignored; a record without quantity, or without address, is incomplete.
    """
    e = ordered.running_sum(events, doc, chunk, order, F.col("kind") == "START", "record").where("record > 0")
    e = ordered.running_sum(e, doc, chunk, order, F.col("kind") == "QUANTITY", "__closed")
    base = e.where("kind = 'START'").select(F.col(doc).alias("__d"), F.col("record").alias("__r"), F.col("__closed").alias("__base"))
    e = e.join(base, F.col(doc).eqNullSafe(F.col("__d")) & (F.col("record") == F.col("__r")))
    n = F.col("__closed") - F.col("__base")
    at = F.struct(*order)
    live = e.where((n == 0) | ((n == 1) & (F.col("kind") == "QUANTITY")))
    out = live.groupBy(doc, "record").agg(F.max_by("value", F.when(F.col("kind") == "PERSONAL", at)).alias("address"), F.max_by("value", F.when(F.col("kind") == "QUANTITY", at)).alias("quantity"))
    return out.withColumn("quantity", F.col("quantity").try_cast("bigint")).withColumn("complete", F.col("address").isNotNull() & F.col("quantity").isNotNull())


def compared(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """key, side, old_value, new_value: keys on one side only, and keys whose totals differ."""
    a = old.groupBy(key).agg(F.sum(value).alias("old_value"))
    b = new.groupBy(key).agg(F.sum(value).alias("new_value"))
    j = a.join(b, key, "full_outer")
    side = F.when(F.col("new_value").isNull(), "old").when(F.col("old_value").isNull(), "new").otherwise("both")
    return j.withColumn("side", side).where("side != 'both' or old_value != new_value")
