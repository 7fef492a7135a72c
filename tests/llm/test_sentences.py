from docloom.llm.sentences import sentence_units, units, words


def cut(text):
    return [text[a:b] for a, b in units(text)]


def test_word_lattice_prefers_whole_words():
    assert words("说明书") == ("说明", "书") and words("说道") == ("说", "道") or words("说道")[0] in ("说", "说道")


def test_quotation_and_the_word_after_it():
    assert cut("“已经齐全！”审计员一边查找一边说。请提交。") == ["“已经齐全！”审计员一边查找一边说。", "请提交。"]
    assert cut("担当者は「足りません。」と言って保管しました。次です。") == ["担当者は「足りません。」と言って保管しました。", "次です。"]


def test_abbreviations_figures_and_brackets():
    assert cut("См. рис. 3 и табл. 2. Решение принял И. И. Иванов. Срок 5 г. с даты.") == ["См. рис. 3 и табл. 2.", "Решение принял И. И. Иванов.", "Срок 5 г. с даты."]
    assert cut("Он сказал: «Да. Нет.» и ушёл. Потом всё.") == ["Он сказал: «Да. Нет.» и ушёл.", "Потом всё."]


def test_long_quotation_is_one_unit():
    assert len(cut("Он сказал: «" + "Слово за словом. " * 60 + "» и ушёл. Конец.")) == 2


def test_thai_blanks_and_figures():
    assert cut("ในปี 2552 นายทะเบียนลงทะเบียน ทำไมไม่ส่ง") == ["ในปี 2552 นายทะเบียนลงทะเบียน", "ทำไมไม่ส่ง"]


def test_nulls_repeats_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "Раз. Два.", "x"), (1, "Раз. Два.", "x"), (2, None, None), (3, " ", None)], "doc_id bigint, text string, start_pos string")
    assert sorted(tuple(r) for r in sentence_units(df).collect()) == [(1, 0, 4), (1, 0, 4), (1, 5, 9), (1, 5, 9)]
    assert sentence_units(df.limit(0)).count() == 0


def test_final_particle_and_opening_word_at_narrow_terminators():
    assert cut("资料齐全了吗?如果不齐请补交.首先核对编号。") == ["资料齐全了吗?", "如果不齐请补交.", "首先核对编号。"]
    assert cut("資料はありますか?確認します.次に保管します。") == ["資料はありますか?", "確認します.", "次に保管します。"]
    assert cut("附件第三.的内容已核对。") == ["附件第三.的内容已核对。"]
