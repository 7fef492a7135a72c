"""Running values over rows in order, in two levels.

A document may hold a third of all rows, so no window runs over the rows of a
whole document.  The rows of one chunk (a page) are one window partition; what
must cross chunks is reduced to one row per chunk first, and only these rows
are put in order per document.  Keys are compared null-safely: rows without a
document or chunk form a group of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _join(df: DataFrame, sums: DataFrame, doc: str, chunk: str, *names: str) -> DataFrame:
    s = sums.select(F.col(doc).alias("__ord_d"), F.col(chunk).alias("__ord_c"), *names)
    return df.join(s, df[doc].eqNullSafe(s["__ord_d"]) & df[chunk].eqNullSafe(s["__ord_c"]), "left").drop("__ord_d", "__ord_c")


def running_sum(df: DataFrame, doc: str, chunk: str, order: Sequence[str], value: Column, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the rows up to this one; the order must be total and begin with the chunk."""
    df = df.withColumn("__v", F.coalesce(value.cast("bigint"), F.lit(0)))
    inner = F.sum("__v").over(Window.partitionBy(doc, chunk).orderBy(*order))
    sums = df.groupBy(doc, chunk).agg(F.sum("__v").alias("__s"))
    sums = sums.withColumn("__base", F.coalesce(F.sum("__s").over(Window.partitionBy(doc).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return _join(df.withColumn("__in", inner), sums, doc, chunk, "__base").withColumn(out, F.col("__in") + F.col("__base")).drop("__v", "__in", "__base")


def last_all(df: DataFrame, doc: str, chunk: str, order: Sequence[str], values: dict[str, Column], strict: bool = False) -> DataFrame:
    """Every output of ``values``: its last value that is not null up to this row, or before it when ``strict``; one join for all."""
    w = Window.partitionBy(doc, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    df = df.withColumn("__at", F.struct(*order)).withColumns({f"__v_{n}": c for n, c in values.items()})
    tails = df.groupBy(doc, chunk).agg(*[F.max_by(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), F.col("__at"))).alias(f"__s_{n}") for n in values])
    chunks = Window.partitionBy(doc).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    tails = tails.withColumns({f"__b_{n}": F.last(f"__s_{n}", ignorenulls=True).over(chunks) for n in values})
    out = df.withColumns({f"__i_{n}": F.last(f"__v_{n}", ignorenulls=True).over(w) for n in values})
    out = _join(out, tails, doc, chunk, *[f"__b_{n}" for n in values])
    return out.withColumns({n: F.coalesce(f"__i_{n}", f"__b_{n}") for n in values}).drop("__at", *[f"__{k}_{n}" for k in "vib" for n in values])


def last_known(df: DataFrame, doc: str, chunk: str, order: Sequence[str], value: Column, out: str, strict: bool = False) -> DataFrame:
    """``out``: the last value that is not null up to this row, or before it when ``strict``."""
    return last_all(df, doc, chunk, order, {out: value}, strict)


def next_known(df: DataFrame, doc: str, chunk: str, order: Sequence[str], value: Column, out: str) -> DataFrame:
    """``out``: the first value that is not null after this row."""
    df = df.withColumn("__v", value).withColumn("__at", F.struct(*order))
    inner = F.first("__v", ignorenulls=True).over(Window.partitionBy(doc, chunk).orderBy(*order).rowsBetween(1, Window.unboundedFollowing))
    sums = df.groupBy(doc, chunk).agg(F.min_by("__v", F.when(F.col("__v").isNotNull(), F.col("__at"))).alias("__s"))
    sums = sums.withColumn("__base", F.first("__s", ignorenulls=True).over(Window.partitionBy(doc).orderBy(chunk).rowsBetween(1, Window.unboundedFollowing)))
    return _join(df.withColumn("__in", inner), sums, doc, chunk, "__base").withColumn(out, F.coalesce("__in", "__base")).drop("__v", "__at", "__in", "__base")


def before(df: DataFrame, doc: str, chunk: str, order: Sequence[str], value: Column, out: str) -> DataFrame:
    """``out``: the value of the row just before this one, whatever it is; null for the first row."""
    boxed = last_known(df.withColumn("__x", F.struct(value.alias("v"))), doc, chunk, order, F.col("__x"), "__y", strict=True)
    return boxed.withColumn(out, F.col("__y.v")).drop("__x", "__y")


def nearest_lower(df: DataFrame, doc: str, chunk: str, order: Sequence[str], level: str, value: Column, out: str, levels: Sequence[int]) -> DataFrame:
    """``out``: ``value`` of the nearest row before this one whose level is smaller; rows without a level take any level.

    One running value per level, so the work does not depend on how far the
    parent lies; ``levels`` lists the levels that can be parents.
    """
    at = F.struct(*order)
    df = last_all(df, doc, chunk, order, {f"__l{k}": F.when(F.col(level) == k, F.struct(at.alias("at"), value.alias("v"))) for k in levels}, strict=True)
    names = [F.when(F.col(level).isNull() | (F.col(level) > k), F.col(f"__l{k}")) for k in levels]
    best = F.greatest(*names) if len(names) > 1 else names[0]
    return df.withColumn(out, best["v"]).drop(*[f"__l{k}" for k in levels])
