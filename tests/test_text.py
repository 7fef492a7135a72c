"""Text functions against cases worked out by hand."""

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("x")).first()[0]


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("ДП-М1.020-06 ^6923", ("ДП-М1.020-06", "ДП", "М1.020", "06")),
        ("КД-ДП-Б1.002-04 ^7B1A", ("КД-ДП-Б1.002-04", "ДП", "Б1.002", "04")),
        ("РК01-2017-07 (Эталон № 13 для печати).pdf", ("РК01-2017-07", "РК", "", "07")),
        ("ИОТ-001-02 ^0E02", ("ИОТ-001-02", "ИОТ", "В7", "02")),
        ("КД-РГ-039-05 ^9892", ("КД-РГ-039-05", "РГ", "", "05")),
        ("заметки.pdf", (None, None, None, None)),
    ],
)
def test_document_code(spark, name, want):
    assert tuple(one(spark, T.document_code, name)) == want


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("ЮШКОВ КОНСТАНТИН МИХАЙЛОВИЧ", "Юшков Константин Михайлович"),
        ("Киселёв Евгений Юрьевич", "Киселев Евгений Юрьевич"),
        ("Кубышко  Тимофей  Александрович", "Кубышко Тимофей Александрович"),
        ("Иванов Владимир Васильевич (Красноярск)", "Иванов Владимир Васильевич"),
        ("Общество с ограниченной ответственностью «ИнфоЛада»", 'ООО "ИнфоЛада"'),
        (None, None),
    ],
)
def test_owner_name(spark, name, want):
    assert one(spark, T.owner_name, name) == want


@pytest.mark.parametrize(("text", "want"), [("8653634 (восемь миллионов)", 8653634), ("некорректный текст", None), ("12 345 (двенадцать)", 12345)])
def test_amount(spark, text, want):
    assert one(spark, T.amount_before_words, text) == want


def test_numbers(spark):
    assert one(spark, T.number_strip, "1 234,56") == 123456.0
    assert [one(spark, T.number_auto, x) for x in ("1 234,56", "1.234,56", "1,234,567", "abc", "")] == [1234.56, 1234.56, 1234567.0, None, None]


@pytest.mark.parametrize(("text", "want"), [("5.1.2 Порядок", ("5.1.2", 3, "Порядок", "numeric")), ("Приложение 1", ("Приложение 1", 1, "Приложение 1", "appendix")), ("ВВЕДЕНИЕ", (None, 0, "ВВЕДЕНИЕ", "service")), ("просто текст", (None, 0, "просто текст", "unknown"))])
def test_section(spark, text, want):
    assert tuple(one(spark, T.section, text)) == want


def test_section_key(spark):
    assert [list(one(spark, T.section_key, x)) for x in ("5.1.2", "Приложение 1", "")] == [[5, 1, 2], [9999, 1], [0]]


def test_jaccard_and_languages(spark):
    row = spark.createDataFrame([("a b c", "b c d", "ANI - aeronautical information")], "a string, b string, c string")
    assert row.select(T.jaccard(F.col("a"), F.col("b"))).first()[0] == 0.5
    assert row.select(T.split_languages(F.col("c"))["en"]).first()[0] == "ANI - aeronautical information"


def test_nulls_empty_and_long(spark):
    long = "слово " * 50_000
    for f in (T.normal_line, T.squeeze, T.line_class, T.markdown_heading, T.anchor, T.cell, T.artefacts, T.for_export, T.owner_name, T.title):
        for value in (None, "", long):
            one(spark, f, value)
    assert one(spark, T.cell, None) == " " and one(spark, T.line_class, "") == "garbage"
