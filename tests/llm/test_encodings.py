from docloom.llm.encodings import readings, repaired

CLEAN = ["Порядок выдачи журнала", "Регламент передачи паспорта сделки", "Überprüfung der Liste", "Ішкі бақылау нұсқаулығы", "Реестр владельцев облигаций", "Порядок учёта паспорта", "État détaillé des relevés"]


def garbled(text, a, b):
    return text.encode(a).decode(b, "replace")


def test_chains_may_repeat():
    twice = garbled(garbled("Порядок", "utf-8", "cp1251"), "utf-8", "cp1251")
    assert ("utf-8>cp1251+utf-8>cp1251", "Порядок") in readings(twice)


def test_repair_and_clean_titles(spark):
    rows = [(n, t) for n, t in enumerate(CLEAN * 12)]
    bad = [(1000 + n, garbled(t, "utf-8", "latin-1")) for n, t in enumerate(CLEAN[:2] * 2)] + [(2000, garbled(CLEAN[4], "cp1251", "latin-1")), (2001, "Порядок ����"), (3000, None), (3001, "")]
    df = spark.createDataFrame([("s", n, "g", t) for n, t in rows + bad], "src string, rec_id bigint, grp string, text string")
    got = {r["rec_id"]: r for r in repaired(df).collect()}
    assert {1000, 1001, 1002, 1003, 2000, 2001} == set(got)
    assert got[1001]["original"] == CLEAN[1] and got[2000]["original"] == CLEAN[4] and got[2001]["lost"] and got[2001]["original"] is None
    assert repaired(df.limit(0)).count() == 0
