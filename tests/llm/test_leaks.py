from docloom.llm.leaks import Index, _Keys, tokens


def leaked(items, text):
    index = Index(list(enumerate(items)))
    keys = _Keys(index.classes)
    return sorted(n for n, *_ in index.leaked([keys[t] for t in tokens(text)], 0.4, 10, 20))


W = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def test_exchanged_word_in_the_middle():
    assert leaked([" ".join(W) + "."], " ".join(["so", *W[:6], "other", *W[7:], "then"])) == [0]


def test_scattered_short_sentences():
    item = "Alpha beta gamma delta. Epsilon zeta eta theta. Iota kappa lambda mu."
    assert leaked([item], "Intro words. Alpha beta gamma delta. Some filler here. Iota kappa lambda mu.") == [0]
    assert leaked(["One two wrong four five. Six seven."], "start one two three four five end") == [0]


def test_chinese_sign_changed():
    item = "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉。"
    assert leaked([item], "前" + item[:10] + "变" + item[11:20] + "后") == [0]


def test_part_shared_with_another_item():
    assert leaked([" ".join(W), " ".join([*W, "nu", "xi", "omicron"])], " ".join([*W, "nu", "xi", "omicron"])) == [0, 1]
    assert leaked([" ".join(W)], "nothing of this recurs here at all") == []


def test_confusable_pairs_have_one_class():
    from docloom.llm.leaks import _ALIKE, CONFUSABLE

    assert all(a.translate(_ALIKE) == b.translate(_ALIKE) for a, b in CONFUSABLE.split())
    item = "Ещё раз всё проверено и учтено надёжно сегодня утром при всех."
    assert leaked([item], item.replace("ё", "е")) == [0]


def test_spans_are_removed(spark):
    from docloom.llm.leaks import leaks, without_spans

    text = "Before it. " + " ".join(W) + ". After it."
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(W) + "."), (8, None)], "item_id bigint, text string")
    found = leaks(docs, items)
    assert [(r["doc_id"], r["item_id"]) for r in found.collect()] == [(1, 7)]
    assert without_spans(docs, found).first()["text"] == "Before it. . After it."


def _covered(index, n, seq, stretch):
    """Share of an item by plain comparison of every diagonal."""
    item, mark = index.words[n], set()
    for d in range(-len(item), len(seq)):
        same = [0 <= k + d < len(seq) and item[k] == seq[k + d] for k in range(len(item))]
        runs, at = [], 0
        while at < len(item):
            end = at
            while end < len(item) and same[end]:
                end += 1
            if end - at >= 2:
                if runs and at - runs[-1][1] <= 2 and not any(c in index.figures for c in item[runs[-1][1] : at]):
                    runs[-1] = [runs[-1][0], end, runs[-1][2] + end - at]
                else:
                    runs.append([at, end, end - at])
            at = max(end, at + 1)
        for a, b, hit in runs:
            if b - a >= stretch and b - a - hit <= (b - a) // 9 + 1:
                mark.update(range(a, b))
            elif hit >= 3 and b - a - hit <= 1:
                mark.update(k for x, y in index.sentences[n] if a <= x and y <= b for k in range(x, y))
    return len(mark) / len(item)


def test_many_documents_at_once_as_by_plain_comparison():
    import random

    rnd = random.Random(5)
    word = lambda: rnd.choice("abcdefgh") * 2 if rnd.random() < 0.95 else rnd.choice("12")
    items = [" ".join(word() if rnd.random() > 0.15 else word() + ". Aa" for _ in range(rnd.randint(6, 40))) for _ in range(30)]
    index = Index(list(enumerate(items)))
    keys = _Keys(index.classes)
    texts = [""]
    for _ in range(200):
        parts = []
        for _ in range(rnd.randint(1, 3)):
            words = rnd.choice(items).split()
            at = rnd.randrange(len(words))
            parts += [w if rnd.random() > 0.08 else "other" for w in words[at : at + rnd.randint(4, 30)]] + ["some", "filler"]
        texts.append(" ".join(parts))
    seqs = [[keys[t] for t in tokens(x)] for x in texts]
    got = [{n: share for n, share, _ in found} for found in index.all_leaked(seqs, 0.4, 10, 20, most=3000)]
    plain = [{n: c for n in range(len(items)) if (c := _covered(index, n, s, 10)) >= 0.4} for s in seqs]
    assert sum(map(len, plain)) > 100 and got == plain
