import numpy as np

from docloom.llm.markup import clean_blocks, fit, found_kinds, labels, markup
from docloom.llm.nodes import decoded, tree
from docloom.llm.trees import fitted


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, (2000, 5)).astype(float)
    y = ((x[:, 1] > 1) ^ (x[:, 3] > 1)).astype(float)
    m = fitted(x[:1000], y[:1000])
    assert ((m.log_odds(x[1000:]) > 0) == y[1000:]).mean() > 0.98
    assert len(fitted(x[:0], y[:0]).log_odds(x)) == 2000


def test_nothing_inside_code_is_accepted():
    nodes = tree("```\n<b>x</b>\n```\n\n<i>y</i>")
    got = decoded(nodes, np.array([9.0 if n.name == "fence" else 3.0 for n in nodes]))
    assert sorted(nodes[k].name for k in got) == ["fence", "tag", "tag"] and all(nodes[k].parent < 0 for k in got)
    # when the code block is unlikely, what is in it counts
    got = decoded(nodes, np.array([-9.0 if n.name == "fence" else 3.0 for n in nodes]))
    assert sum(nodes[k].name == "tag" for k in got) == 4


def test_labels_of_the_grammar():
    text = "a < b, цена $5, C:\\new\\x, см. <b>x</b> и $x_1^2$"
    nodes = tree(text)
    assert {nodes[k].kind for k, y in enumerate(labels(text, nodes)) if y} == {"html", "latex"}


def test_markup_over_a_table(spark):
    data = [("s", n, t) for n, t in enumerate(["# Заголовок\n\nтекст **жирный**", "== Раздел ==\n[[ссылка]]", "\\section{Раз}\n\\item x", "<p>x</p>", "• пункт\n1. два\n3 < 5", None, "", "<p>y</p>"] * 20)]
    rows = spark.createDataFrame(data, "src string, rec_id bigint, text string")
    got = {(r["rec_id"] % 8, r["markup"]) for r in markup(rows).collect()}
    assert got == {(0, "markdown"), (1, "wiki"), (2, "latex"), (3, "html"), (7, "html")}
    kinds = {r["kind"] for r in clean_blocks(rows.where("rec_id = 0")).collect()}
    assert kinds == {"heading", "paragraph"}
    assert markup(rows.limit(0)).count() == 0
    assert found_kinds(["", "a < b"], fit(rows)) == [[], []]
