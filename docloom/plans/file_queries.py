"""Queries that go through office files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.plans import oracle as O
from docloom.plans.record_queries import owners
from docloom.sinks import workbook as W
from docloom.sources import office


def workbook_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner records written to one workbook per register and read back (SNK-05, SNK-06, SRC-10, SRC-15)."""
    o = owners(spark, sf_dir).where("register_id is not null").select("register_id", "record_id", "quantity", F.trim("address").alias("address"))
    books = W.workbooks(o, "register_id", "record_id", ["record_id", "quantity", "address"])
    r = office.sheet_records(office.xlsx(books))
    return r.select(F.col("fields")["record_id"].cast("bigint").alias("record_id"), F.col("fields")["quantity"].try_cast("double").cast("bigint").alias("quantity"), F.coalesce(F.nullif(F.trim(F.col("fields")["address"]), F.lit("")), F.lit("-")).alias("address"))


QUERIES = {f.__name__: f for f in (workbook_records,)}
SQL = {"workbook_records": O.sql("select record_id, quantity, coalesce(nullif(trim(address), ''), '-') as address from owners where register_id is not null", "owners")}
