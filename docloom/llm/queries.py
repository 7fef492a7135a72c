"""The pN_ queries of the training-data operators, and SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.shared import kept
from docloom.llm.addresses import locations, pairs
from docloom.llm.encodings import repaired
from docloom.llm.leaks import leaks, without_spans
from docloom.llm.markup import clean_blocks, markup
from docloom.llm.names import owners
from docloom.llm.noise import noise, repaired_pages
from docloom.llm.packing import packed
from docloom.llm.sentences import sentence_units
from docloom.sources.tables import latest, table


def _owners(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return latest(table(spark, sf_dir, "owner_records").select("record_id", *columns, "loaded_at"), "record_id", "loaded_at")


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts of scanned pages; far: the block's box keeps off the upper and lower edge of an A4 page in points."""
    far = F.coalesce((F.col("bbox.y0") >= 110) & (F.col("bbox.y1") <= 760), F.lit(False))
    out = None
    for src, key, page, column, time in (("ir_blocks", "block_no", "page", "content", "loaded_at"), ("page_contents", "content_id", "page_num", "text", "loaded_at"), ("ocr_responses", "page_id", "page", "markdown", "received_at")):
        rows = table(spark, sf_dir, src)
        one = latest(rows.select(key, "doc_id", page, column, (far if src == "ir_blocks" else F.lit(False)).alias("far"), time), key, time)
        one = one.select(F.lit(src).alias("src"), F.col(key).alias("rec_id"), "doc_id", F.col(page).alias("page"), F.col(column).alias("text"), "far")
        out = one if out is None else out.union(one)
    return out.where("text is not null and text != ''")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of noise in every scanned text."""
    return noise(_scanned(spark, sf_dir))


def p1_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scanned text repaired into readable paragraphs."""
    return repaired_pages(kept(_scanned(spark, sf_dir)))


def p2_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location of every record with an address, and how many records share it."""
    found = locations(_owners(spark, sf_dir, "address"))
    return found.join(found.groupBy("location").agg(F.count(F.lit(1)).alias("n_records")), "location").select("record_id", "location", "n_records")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records whose addresses name one location."""
    return pairs(locations(_owners(spark, sf_dir, "address")), "record_id", "location")


def _marked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for src, key, column, time in (("ocr_responses", "page_id", "markdown", "received_at"), ("full_parse_results", "result_id", "full_markdown", "parsed_at")):
        one = latest(table(spark, sf_dir, src).select(key, column, time), key, time)
        parts.append(one.select(F.lit(src).alias("src"), F.col(key).alias("rec_id"), F.col(column).alias("text")))
    return parts[0].union(parts[1])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of markup in every parsed document."""
    return markup(_marked_up(spark, sf_dir))


def p3_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean text of every parsed document, block by block."""
    return clean_blocks(_marked_up(spark, sf_dir))


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for src, key, time in (("document_metadata", "meta_id", "processed_date"), ("docx_metadata", "docx_id", "extracted_at")):
        one = latest(table(spark, sf_dir, src).select(key, "title", time), key, time)
        parts.append(one.select(F.lit(src).alias("src"), F.col(key).alias("rec_id"), F.lit(f"{src}.title").alias("grp"), F.col("title").alias("text")))
    return parts[0].union(parts[1])


def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled titles with the chain of wrong decodings and the restored text."""
    return repaired(_titles(spark, sf_dir)).select("src", "rec_id", "chain", "lost", "original")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of which all or a part was decoded with a wrong encoding."""
    return repaired(_titles(spark, sf_dir)).select("src", "rec_id")


def p5_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner of every named record, and how many records name it."""
    found = owners(_owners(spark, sf_dir, "full_name"))
    return found.join(found.groupBy("owner").agg(F.count(F.lit(1)).alias("n_records")), "owner").select("record_id", "owner", "n_records")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records that name one person or organisation."""
    return pairs(owners(_owners(spark, sf_dir, "full_name")), "record_id", "owner")


def p7_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens."""
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and pieces of every sequence, and the share of the capacity that is used."""
    rows = p7_sequences(spark, sf_dir)
    return rows.groupBy("sequence_id").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_pieces")).withColumn("fill", F.round(F.col("n_tokens") / 2048, 6))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the held-out items that leaked into them."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")
    return leaks(docs.select("doc_id", "text"), items).select("doc_id", "item_id").distinct()


def p8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the leaked passages in every document."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")
    return leaks(docs.select("doc_id", "text"), items).select("doc_id", "item_id", F.explode("spans").alias("s")).select("doc_id", "item_id", F.col("s.start").alias("start_pos"), F.col("s.end").alias("end_pos")).distinct()


def p8_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affected documents without the leaked passages."""
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "eval_items")
    return without_spans(docs, leaks(docs, items))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence units of every document."""
    return sentence_units(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The registered queries by name."""
    return {f.__name__: f for f in (p1_found, p1_text, p2_found, p2_locations, p3_found, p3_text, p4_found, p4_repaired, p5_found, p5_owners, p7_sequences, p7_fill, p8_found, p8_spans, p8_clean, p9_found)}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express."""
    return {}
