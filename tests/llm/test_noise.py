from docloom.llm.noise import CUT, PAGE_MARKED, PAGE_NO, repaired_text


def test_repair():
    text = "ООО «Акт» — документ   стр. 4\nКонтролёр сверяет доку-\nменты и план-\nграфик. Пaспорт сделки хра- нят.\n\n— 4 —"
    got = repaired_text(text, {4}, {0}, {"доку-менты", "хра-нят"}, {"пaспорт": "паспорт"})
    assert got == "ООО «Акт» — документ\nКонтролёр сверяет документы и план-график. Паспорт сделки хранят."
    assert repaired_text("СВОДНЫЙ АРХИВ", {0}, set(), set(), {}) == ""


def test_capital_of_a_cut_word():
    assert repaired_text("Нерези-\nдент перечислил", set(), set(), {"нерези-дент"}, {}) == "Нерезидент перечислил"
    for pattern in (CUT, PAGE_NO, PAGE_MARKED):
        assert pattern.startswith("(?iu)")  # else Java folds no Cyrillic letter


def test_registered():
    import __spark_entry__

    assert {"p1_found", "p1_text"} <= set(__spark_entry__.queries())


def test_frequent_misreading_is_found(spark):
    from docloom.llm.noise import noise

    right, wrong, mixed = "Опись документа хранят", "Опись докумеита хранят", "Опись вложений и pdf-файлы"
    rows = [("page_contents", n, None, n, right if n < 300 else wrong if n < 320 else mixed, False) for n in range(340)]
    pages = spark.createDataFrame(rows, "src string, rec_id bigint, doc_id string, page int, text string, far boolean")
    found = {(r["rec_id"], r["noise"]) for r in noise(pages).collect()}
    assert found == {(n, "misread") for n in range(300, 320)}
