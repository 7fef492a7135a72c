import random

from pyspark.sql import functions as F

from docloom.llm.names import _joined, cells, distance, owners, radius_pairs, read_name


def test_typos_of_one_abbreviated_name_share_an_owner(spark):
    short = spark.createDataFrame([(1, "g", "иванова"), (2, "g", "иваново"), (3, "g", "ивановы")], "record_id long, grp string, word string")
    known = spark.createDataFrame([], "owner string, grp string, word string, n long")
    got = _joined(short, known, radius_pairs(short.select("grp", "word"))).collect()
    assert len(got) == 3 and len({r["owner"] for r in got}) == 1


def test_radius_join_against_all_pairs(spark):
    random.seed(5)
    words = sorted({"".join(random.choice("абв") for _ in range(random.randrange(4, 8))) for _ in range(400)})
    df = spark.createDataFrame([("g", w) for w in words], "grp string, word string")
    got = {(r["word_1"], r["word_2"]) for r in radius_pairs(df).collect()}
    plain = df.select(F.col("word").alias("a")).crossJoin(df.select(F.col("word").alias("b"))).where("a < b and levenshtein(a, b) <= 2")
    assert got == {(r["a"], r["b"]) for r in plain.collect()}
    assert cells(df).where("at_home").count() == len(words)


def test_readings():
    assert read_name("Ахметов Нурлан Серикович")["kind"] == "P"
    assert read_name("ООО «Вега-2»")["kind"] == "O" and read_name("???") is None
    assert distance("иванов", "иавнов", 2) == 1


def test_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1, "Иванов Иван Петрович"), (2, "ИВАНОВ ИВАН ПЕТРОВИЧ"), (3, None), (4, ""), (5, "Иванов Пётр Иванович")], "record_id bigint, full_name string")
    got = {r["record_id"]: r["owner"] for r in owners(df).collect()}
    assert got.keys() == {1, 2, 5} and got[1] == got[2] != got[5]
