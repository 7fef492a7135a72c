"""Queries over nested bank-control statements (problem 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import nested
from docloom.sources.tables import latest, table


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.nodes(latest(table(spark, sf_dir, "vbk_statements").select("statement_id", "xml", "received_at"), "statement_id", "received_at"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of every well-formed statement with its path and parent."""
    return nested.occurrences(_flat(spark, sf_dir)).select("statement_id", "node_path", "parent_path", "rec_id")


def p6_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per statement header; unnamed fields stay in the map."""
    flat = _flat(spark, sf_dir).where("kind = 'THEADER'")
    return flat.select("statement_id", *[F.element_at("attributes", F.lit(a)).alias(f"attr_{a}") for a in ("date", "time", "regn", "file")], *[F.element_at("fields", F.lit(f)).alias(f.lower()) for f in ("RepType", "Bank", "Pasport", "Date")], F.to_json("fields").alias("fields"))


def p6_resident(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per resident section."""
    flat = _flat(spark, sf_dir).where("role = 'section' and node_path = 'R1'")
    names = ("Resident", "Subject", "Rajon", "Gorod", "Ulica", "Dom", "Korpus", "Ofis", "RegNum", "RegDate", "Inn")
    return flat.select("statement_id", *[F.element_at("fields", F.lit(f)).alias(f.lower()) for f in names], F.size("children").alias("n_children"))


def p6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat record table: kind, attributes and fields of every record with its link to statement and parent."""
    flat = _flat(spark, sf_dir).where("role = 'record'")
    return flat.select("statement_id", "kind", "node_path", "parent_path", "ordinal", "rec_id", "object_id", F.to_json("attributes").alias("attributes"), F.to_json("fields").alias("fields"))


def p6_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct objects by Merkle identity, each stored once."""
    out = nested.objects(_flat(spark, sf_dir))
    return out.select("object_id", "kind", "role", F.to_json("attributes").alias("attributes"), F.to_json("fields").alias("fields"), F.size("children").alias("n_children"), "n_occurrences")


def p6_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent object to child object, with ordinals."""
    return nested.object_links(_flat(spark, sf_dir))


def p6_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with their attributes."""
    return _flat(spark, sf_dir).where("role = 'table'").select("statement_id", "kind", "node_path", "parent_path", "ordinal", F.to_json("attributes").alias("attributes"))


def p6_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that the records of each kind of table have."""
    return nested.columns_of(_flat(spark, sf_dir))


def p6_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of every kind of table as rows of (kind, column, value): the flat tables in one long form."""
    flat = _flat(spark, sf_dir).where("role = 'record'")
    pairs = F.concat(F.transform(F.map_entries("attributes"), lambda x: F.struct(F.concat(F.lit("@"), x["key"]).alias("name"), x["value"].alias("value"))), F.transform(F.map_entries("fields"), lambda x: F.struct(x["key"].alias("name"), x["value"].alias("value"))))
    return flat.select("kind", "statement_id", "node_path", "parent_path", F.explode(pairs).alias("c")).select("kind", "statement_id", "node_path", "parent_path", "c.name", "c.value")


def p6_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables whose announced number of records differs from the records found."""
    return nested.audit(_flat(spark, sf_dir))


def kind_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One flat table per kind of Table, with named columns; kinds and columns are read from the data first, a list as small as the schema."""
    from docloom.functions.shared import kept

    flat = kept(_flat(spark, sf_dir))
    names: dict[str, tuple[list[str], list[str]]] = {}
    for r in nested.columns_of(flat).orderBy("kind", "name").toLocalIterator():
        names.setdefault(r["kind"], ([], []))[0 if r["is_attribute"] else 1].append(r["name"])
    return {k: nested.flat_table(flat, k, a, f) for k, (a, f) in names.items()}


QUERIES = {f.__name__: f for f in (p6_found, p6_header, p6_resident, p6_records, p6_tables, p6_columns, p6_table_rows, p6_audit, p6_objects, p6_links)}
SQL: dict[str, str] = {}
