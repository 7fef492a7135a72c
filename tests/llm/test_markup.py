from docloom.llm.markup import read


def test_kinds():
    for text, kinds in (
        ("<p>a &laquo;b&raquo;</p>", ["html"]), ("## Акт ##", ["markdown"]), ("Акт\n======", ["markdown"]), ("== Акт ==", ["wiki"]), ("нет\\footnote{да} слова", ["latex"]),
        ("см. $x_1$ и [[акт|схему]]", ["latex", "wiki"]), ("слово[^6] и *другое*", ["markdown"]),
        ("Сумма $ 84 и $ 539 за лист.", []), ("Значение x < 5 и y > 3", []), ("Файл лежит в D:\\archive\\scan\\box_49_v2.txt [3].", []), ("Поле: <не указано>, # 68.", []),
        ("R&D, 100% & более; {вариант} 5.", []), ("Коды A|B|C и [1; 33].", []), ("• акт\n– лист", []), ("равен 5 * 3 * 2 м", []),
    ):
        assert read(text)[0] == kinds, text


def test_code_counts_only_its_own_marks():
    assert read("```python\n<td>*a* \\foo{b}\n```")[0] == ["markdown"]
    assert read("<pre><code># **x** [[y]]</code></pre>")[0] == ["html"]
    assert read("\\begin{verbatim}\n<td> ## x\n\\end{verbatim}")[0] == ["latex"]


def test_structure_stays_recognisable():
    text = "<h2>4.1 Лист</h2>\nОдин **два** три\n\n| a | b |\n|---|---:|\n| c | 5 |\n\n- [ ] акт\n\n```\nx = 1\n```\n\n\\[ \\sqrt{x} \\]"
    assert read(text)[1] == [("heading", 2, "4.1 Лист"), ("paragraph", 0, "Один два три"), ("row", 0, "a\tb"), ("row", 0, "c\t5"), ("item", 0, "акт"), ("code", 0, "x = 1"), ("formula", 0, "\\sqrt{x}")]
    assert read("\\begin{tabular}{lr}\nакт & 64 \\\\\nлист & 3\n\\end{tabular}")[1] == [("row", 0, "акт\t64"), ("row", 0, "лист\t3")]
    assert read('{| class="d"\n|-\n| акт || 9\n|}\n* [[лист]]')[1] == [("row", 0, "акт\t9"), ("item", 0, "лист")]
