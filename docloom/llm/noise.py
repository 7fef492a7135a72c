"""Noise that scanning leaves in text: cut words, misread letters, running lines, page numbers.

One pass over the texts takes out the words, cut words and edge lines of every
record; all else is joined in SQL.  A word's anagram hash is the sum of the fifth
powers of its code points, so exchanging one string of letters for another
changes it by a fixed difference.  Adding the differences of the confusable
strings to the hashes of the frequent words and joining on the hash finds their
rare misread variants; ranked by frequency the best one is the correction.
Words cut at line ends are joined when the corpus knows the joined word better
than the hyphenated one.  Lines at page edges that pages of a document repeat
are running lines.  The repaired text leaves running lines and page numbers
out, joins cut words, puts the right words in and joins wrapped lines.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrow import chunked
from docloom.functions.shared import kept
from docloom.llm.sentences import paragraphs

# Strings that scanning confuses, the right one and what it is read as.
CONFUSED = """а>a е>с е>e т>m т>г о>с р>p о>o о>0 н>п и>u н>и и>н к>н л>п к>k л>ji в>8 в>b п>n п>л д>л д>g з>3 з>э г>1 ч>4 г>r ы>ьi ы>bi б>6 ю>io ю>10 ш>щ ш>ni ж>к
с>c у>y х>x с>е щ>ш э>з п>н и>й й>и ц>u м>rn ь>b ъ>b
e>c t>f s>5 a>o n>ri o>0 d>cl i>1 u>ii i>l l>1 m>rn l>i g>q h>b g>9 c>e rn>m cl>d b>6 z>2"""
# Look-alike letters and figures, and the one sign that stands for each of them when lines are compared.
_LOOKS = ("ёaeopcyxkmugrbn0834613э0іhtв", "еаеорсухктигрвпозвчбгззоинтв")
LETTERS = "a-zа-яёәғқңөұүһі"
WORD = rf"(?U)[{LETTERS}0-9]+(?:-[{LETTERS}0-9]+)*"
#: Java folds the case of Cyrillic letters only with the flag u.  A hyphen or hyphen-like sign right after a letter, then a line break or blanks, then a small letter
CUT = rf"(?iu)([{LETTERS}0-9]+(?:-[{LETTERS}0-9]+)*)([-‐‑–¬\x{{ad}}])([ \t]*(?:\r?\n)[ \t]*|[ \t]+)(?-i)([{LETTERS}]+)"
PAGE_NO = r"(?iu)(?:[-—–|\[(] ?)?(?:(?:стр|с|лист|page|p|бет)\.?\s*)?(\d{1,4})(?:\s*(?:из|/|of)\s*\d{1,4}|\s+листов\s+\d{1,4})?(?: ?[-—–|\])])?"
PAGE_MARKED = r"(?iu)(?:стр|с|лист|page|p|бет)\.?\s*\d|^\s*[-—–|\[(]|[-—–|\])]\s*$|\d\s*(?:из|/|of)\s*\d"


def anagram_hash(word: Column) -> Column:
    """Sum of the fifth powers of the code points."""

    def fifth(c: Column) -> Column:
        n = F.ascii(c).cast("bigint")
        return n * n * n * n * n

    return F.aggregate(F.filter(F.split(word, ""), lambda c: c != ""), F.lit(0).cast("bigint"), lambda acc, c: acc + fifth(c))


def differences(confused: str = CONFUSED) -> list[tuple[str, str, int]]:
    """(right, misread, hash difference)."""
    pairs = [p.split(">") for p in confused.split()]
    return [(a, b, sum(ord(c) ** 5 for c in b) - sum(ord(c) ** 5 for c in a)) for a, b in pairs]


def vocabulary(seen: DataFrame) -> DataFrame:
    """word, n over all texts; cut words are left out, they are what is judged."""
    return seen.where("counted is not null").select(F.explode("counted").alias("x")).groupBy(F.col("x.word").alias("word")).agg(F.sum("x.n").alias("n"))


def misread_words(vocab: DataFrame, ratio: int = 12, least: int = 8, share: float = 2e-6) -> DataFrame:
    """word -> right: rare words that one confusable string turns into a frequent word.

    Frequent words hold at least ``share`` of all words (so there are at most
    1 / share) and ``least`` occurrences; a misread word is ``ratio`` times
    rarer.  Several right words are ranked by frequency.
    """
    spark = vocab.sparkSession
    pairs = spark.createDataFrame(differences(), "right_part string, misread_part string, delta bigint")
    total = vocab.agg(F.sum("n").alias("total"))
    frequent = vocab.join(F.broadcast(total)).where((F.col("n") >= least) & (F.col("n") >= F.col("total") * share) & (F.length("word") >= 4) & ~F.col("word").rlike("^[0-9-]+$"))
    keys = frequent.select(F.col("word").alias("right"), F.col("n").alias("right_n"), anagram_hash(F.col("word")).alias("h")).join(F.broadcast(pairs), F.instr("right", F.col("right_part")) > 0).withColumn("key", F.col("h") + F.col("delta"))
    rare = vocab.where("length(word) >= 4").select("word", "n", anagram_hash(F.col("word")).alias("key"))
    hit = rare.join(keys, "key").where((F.col("n") * ratio <= F.col("right_n")) & (F.instr("word", F.col("misread_part")) > 0))
    # the same letters in another order are no misreading: one replacement must do
    spots = F.transform(F.sequence(F.lit(1), F.length("right") - F.length("right_part") + 1), lambda p: F.when(F.substring("right", p, F.length("right_part")) == F.col("right_part"), F.concat(F.substring("right", F.lit(1), p - 1), F.col("misread_part"), F.substring("right", p + F.length("right_part"), F.length("right")))))
    exact = hit.where(F.array_contains(F.array_compact(spots), F.col("word")))
    return exact.groupBy("word").agg(F.max_by("right", F.struct("right_n", "right")).alias("right"))


_BLANKS = r"[ \t\n\x0b\f\r]"
_ANY_CASE = LETTERS + LETTERS.upper()
#: CUT without backtracking into a word
_CUT = re.compile(rf"(?<![{_ANY_CASE}0-9])([{_ANY_CASE}0-9]++(?:-[{_ANY_CASE}0-9]++)*+)([-‐‑–¬\xad])([ \t]*(?:\r?\n)[ \t]*|[ \t]+)([{LETTERS}]+)")
_WORD = re.compile(WORD.replace("(?U)", ""), re.I)
_LOW_WORD = re.compile(rf"[{LETTERS}0-9]++(?:-[{LETTERS}0-9]++)*+")
#: No text without a match holds a cut word
_MAY_CUT = re.compile(rf"[-‐‑–¬\xad](?<=[{_ANY_CASE}0-9].)[ \t\r\n]")
_HYPHENED = re.compile(rf"[-‐‑–¬\xad](?<=[{LETTERS}].)[ \t]*(?:\r?\n[ \t]*|[ \t]+)(?=[{LETTERS}])")
_MIXED_SIGNS = re.compile(r"[a-z0-9а-яё-]*")
_MIXED_PART = re.compile(r"[a-z]|[а-яё][0-9]+[а-яё]|^[0-9][а-яё]{4,}$|[а-яё]{4,}[0-9]{1,2}$")
_MIXED_NOT = re.compile(r"[0-9]+-?(?:я|й|ая|ый|ой|го|му|ти|х|ю|е|кг|мм|см|км|руб|млн|тыс|лет|шт)")
_CYRILLIC = re.compile("[а-яё]{2}")


def _mixed(word: str) -> bool:
    """Latin letters or figures inside a Cyrillic word."""
    return bool(_CYRILLIC.search(word) and _MIXED_PART.search(word) and _MIXED_SIGNS.fullmatch(word) and not _MIXED_NOT.fullmatch(word))


def _java(pattern: str) -> re.Pattern:
    """A pattern of Java, where figures and blanks are those of ASCII."""
    return re.compile(pattern.replace("(?iu)", "").replace(r"\d", "[0-9]").replace(r"\s", _BLANKS), re.I)


_NUMBER = r"(?:(?:стр|с|лист|page|p)\.?\s*)(\d{1,4})(?:\s*(?:из|/|of)\s*\d{1,4})?"
_ALONE = _java(rf"\s*{PAGE_NO}\s*")
_MARKED = _java(PAGE_MARKED)
_AT_END = _java(rf"(?:\s{{2,}}|\t|\s\|\s?){_NUMBER}\s*$")
_AT_START = _java(rf"{_NUMBER}(?:\s{{2,}}|\t|\s\|\s)[^ \t\n\x0b\f\r]")
_UNIT = re.compile(r"(?:шт|руб|кг|ед)\.?$")
_NO_HEADER = re.compile(r"[•–▪◦*#>|\\<`~={\[-]")
_ANY_BLANK = re.compile(r"[ \t\n\x0b\f\r\xa0]+")
#: No right one is another's look-alike, so one after the other gives what all at once would
_LOOK = [(a, b) for a, b in {a: b for a, b in reversed([*zip(*_LOOKS)])}.items() if a != b]


def _looks(line: str) -> str:
    for a, b in _LOOK:
        line = line.replace(a, b)
    return line


def _edge_lines(src: str, doc_id: str | None, page: int | None, far: bool, text: str, edge: int = 3) -> tuple[list[tuple], list[tuple]]:
    """Page numbers (line, whether alone) and lines that could be running ones (line, norm, raw).

    Looked at are the first and last non-blank lines of every page and all lines
    of every block (a block can span pages).  Running lines are compared without
    the page number, look-alikes as one sign.
    """
    lines = [x.strip(" \t\n\x0b\f\r\xa0") for x in text.replace("\r\n", "\n").split("\n") if x.strip(" ")]
    size, own = len(lines), None if page is None else str(page)
    block = src == "ir_blocks"
    far = far and size == 1
    numbers, edges = [], []
    for at in range(size) if block or size <= 2 * edge else (*range(edge), *range(size - edge, size)):
        line = lines[at]
        if len(line) > 160:
            continue
        number = m.group(1) if (m := _ALONE.fullmatch(line)) else ""
        tail = _AT_END.search(line) if line[-1:] in _FIGURES else None
        lead = m if line[:1] in _PAGE_FIRST and (m := _AT_START.match(line)) else None
        if own is not None:
            alone = number == own and not far
            if alone and not _MARKED.search(line):
                after, before = lines[at + 1] if at + 1 < size else "", lines[at - 1] if at else ""
                alone = not (after.startswith("(") or _UNIT.search(before)) and (not block or size == 1)
            if alone or tail and tail.group(1) == own or lead and lead.group(1) == own:
                numbers.append((at, alone))
        if doc_id is not None and not far and not number:
            bare = (line[: tail.start()] if tail else line).strip(" ")
            if len(bare) >= 5 and not _NO_HEADER.match(bare):
                edges.append((at, _looks((raw := _ANY_BLANK.sub(" ", bare)).lower()), raw))
    return numbers, edges


_FIGURES = frozenset("0123456789")
_PAGE_FIRST = frozenset("сСлЛpP")
_STRINGS = pa.list_(pa.string())
_SEEN = pa.schema(
    [("src", pa.string()), ("rec_id", pa.int64()), ("doc_id", pa.string()), ("page", pa.int64()), ("words", _STRINGS), ("mixed", _STRINGS)]
    + [("cuts", pa.list_(pa.struct([("own", pa.string()), ("joined", pa.string()), ("broken", pa.bool_())])))]
    + [("numbers", pa.list_(pa.struct([("at", pa.int32()), ("alone", pa.bool_())])))]
    + [("edges", pa.list_(pa.struct([("at", pa.int32()), ("norm", pa.string()), ("raw", pa.string())])))]
    + [("counted", pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))]
)
_SEEN_DDL = (
    "src string, rec_id bigint, doc_id string, page bigint, words array<string>, mixed array<string>, cuts array<struct<own:string,joined:string,broken:boolean>>, "
    "numbers array<struct<at:int,alone:boolean>>, edges array<struct<at:int,norm:string,raw:string>>, counted array<struct<word:string,n:bigint>>"
)


def _counted(counts: Counter, rows: int = 5000) -> Iterator[pa.RecordBatch]:
    """Rows that hold nothing but words and their numbers."""
    pairs = [(w, n) for w, n in counts.items() if len(w) > 1]
    for at in range(0, len(pairs), rows):
        words, ns = zip(*pairs[at : at + rows])
        both = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(ns, pa.int64())], names=["word", "n"])
        one = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), both)
        yield pa.RecordBatch.from_arrays([one if f.name == "counted" else pa.nulls(1, f.type) for f in _SEEN], schema=_SEEN)
    counts.clear()


def _lists(rows: list, kind: pa.ListType) -> pa.ListArray:
    """Rows of strings or tuples as a column."""
    ends, flat = [0], []
    for r in rows:
        flat.extend(r)
        ends.append(len(flat))
    if pa.types.is_struct(kind.value_type):
        fields = list(kind.value_type)
        columns = zip(*flat) if flat else [()] * len(fields)
        values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], fields=fields)
    else:
        values = pa.array(flat, kind.value_type)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _see(batches: Iterator[pa.RecordBatch], rows: int = 512, most: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Words, mixed words, cut words, page numbers and edge lines of every record; word counts in rows of their own, whenever ``most`` words have gathered."""
    counts: Counter = Counter()
    known: set[str] = set()
    long: set[str] = set()
    odd: set[str] = set()
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            part = batch.slice(first, rows)
            lists: dict[str, list] = {k: [] for k in ("words", "mixed", "cuts", "numbers", "edges")}
            for src, _, doc_id, page, far, text in zip(*[c.to_pylist() for c in part.columns]):
                cuts = []
                if _MAY_CUT.search(text):
                    whole, at = [], 0
                    for m in _CUT.finditer(text):
                        a, b = m.group(1).lower(), m.group(4).lower()
                        if len(b) > 1:
                            cuts.append((f"{a}-{b}", a + b, "\n" in m.group(3)))
                        whole.append(text[at : m.start()])
                        at = m.end()
                    counts.update(_LOW_WORD.findall(" ".join([*whole, text[at:]]).lower()))
                    own = set(_LOW_WORD.findall(_HYPHENED.sub("", text).lower()))
                else:
                    every = _LOW_WORD.findall(text.lower())
                    counts.update(every)
                    own = set(every)
                fresh = own - known
                if fresh:
                    if len(known) > most:
                        known, long, odd, fresh = set(), set(), set(), own
                    known |= fresh
                    long.update(w for w in fresh if len(w) > 3 and not w.isdigit())
                    odd.update(w for w in fresh if len(w) > 2 and _mixed(w))
                lists["words"].append(own & long)
                lists["mixed"].append(own & odd)
                lists["cuts"].append(cuts)
                numbers, edges = _edge_lines(src, doc_id, page, far or False, text)
                lists["numbers"].append(numbers)
                lists["edges"].append(edges)
            by = {k: _lists(v, _SEEN.field(k).type) for k, v in lists.items()} | {k: part.column(k).cast(_SEEN.field(k).type) for k in ("src", "rec_id", "doc_id", "page")}
            yield pa.RecordBatch.from_arrays([by[f.name] if f.name in by else pa.nulls(part.num_rows, f.type) for f in _SEEN], schema=_SEEN)
            if len(counts) > most:
                yield from _counted(counts)
    yield from _counted(counts)


@dataclass
class _Evidence:
    """Where the noise is: records with cut words (own, joined), misread words (word), page numbers and running lines (at)."""

    vocab: DataFrame
    bad: DataFrame
    cuts: DataFrame
    direct: DataFrame
    misread: DataFrame
    pageno: DataFrame
    same: DataFrame
    variant: DataFrame
    off: DataFrame


def _evidence(pages: DataFrame, least_pages: int, page_share: float) -> _Evidence:
    texts = pages.where("text is not null and text != ''")
    seen = kept(texts.select("src", F.col("rec_id").cast("bigint").alias("rec_id"), "doc_id", F.col("page").cast("bigint").alias("page"), "far", "text").mapInArrow(_see, _SEEN_DDL))
    vocab = kept(vocabulary(seen))
    bad = kept(misread_words(vocab))
    each = lambda column: seen.where(F.size(column) > 0).select("src", "rec_id", "doc_id", "page", F.explode(column).alias("x"))

    # cut words: the corpus must not know the hyphenated form better than the joined one
    cuts = each("cuts").select("src", "rec_id", "x.*")
    n = lambda c: vocab.select(F.col("word").alias(c), F.col("n").alias(f"n_{c}"))
    judged = cuts.select("joined", "own").distinct().join(n("joined"), "joined", "left").join(n("own"), "own", "left").select("joined", "own", F.coalesce("n_joined", F.lit(0)).alias("n_joined"), F.coalesce("n_own", F.lit(0)).alias("n_own"))
    cut = cuts.join(judged, ["joined", "own"]).where("n_own <= n_joined and (broken or n_joined > 0)").select("src", "rec_id", "own")

    # misread words, however often the same misreading recurs; words of mixed letters that are frequent and no misreading are words of the corpus
    misread = each("words").select("src", "rec_id", F.col("x").alias("word")).join(bad, "word").select("src", "rec_id", "word", "right")
    mixed = each("mixed").select("src", "rec_id", F.col("x").alias("word"))
    total = vocab.agg(F.sum("n").alias("total"))
    usual = mixed.select("word").distinct().join(vocab, "word").join(F.broadcast(total)).where("n >= greatest(8, total * 2e-6)").select("word").join(bad, "word", "left_anti")
    direct = mixed.join(usual, "word", "left_anti")

    pageno = each("numbers").select("src", "rec_id", "x.at", "x.alone")

    edge = each("edges").select("src", "rec_id", "doc_id", "page", "x.at", "x.norm", "x.raw")
    spread = edge.select("src", "doc_id", "page").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"))
    repeats = edge.select("doc_id", "norm", "src", "page").distinct().groupBy("doc_id", "norm").agg(F.count(F.lit(1)).alias("n")).join(spread, "doc_id")
    running = repeats.where((F.col("n") >= least_pages) & (F.col("n") >= F.col("n_pages") * page_share) | (F.col("n") == 2) & (F.col("n_pages") <= 4)).select("doc_id", "norm", "n")
    running = kept(running)
    same = edge.join(running.select("doc_id", "norm"), ["doc_id", "norm"])
    rest = edge.join(running.select("doc_id", "norm"), ["doc_id", "norm"], "left_anti").where("length(norm) >= 8")
    variant = rest.join(running.select("doc_id", F.col("norm").alias("right")), "doc_id").where("abs(length(norm) - length(right)) <= 3").where(F.levenshtein("norm", "right", 3).between(1, 3)).where("length(right) >= 12 or levenshtein(norm, right) <= 1")
    raw = same.groupBy("doc_id", "norm", "raw").agg(F.count(F.lit(1)).alias("n")).groupBy("doc_id", "norm").agg(F.max_by("raw", F.struct("n", "raw")).alias("usual"))
    off = same.join(raw, ["doc_id", "norm"]).where(F.lower("raw") != F.lower("usual"))
    return _Evidence(vocab, bad, cut, direct, misread, pageno, same, variant, off)


def noise(pages: DataFrame, least_pages: int = 3, page_share: float = 0.12) -> DataFrame:
    """src, rec_id, noise: one row per record and kind of noise.

    ``pages`` has src, rec_id, doc_id, page, text and far (true where a block's
    box lies inside the page, so that it can be no running line).  Kinds are
    'hyphen', 'misread', 'running' and 'pageno'.  Null and empty texts have no
    rows, repeated records give one row, a document of null name has no running
    lines.
    """
    e = _evidence(pages, least_pages, page_share)
    out = None
    for df, kind in ((e.cuts, "hyphen"), (e.direct, "misread"), (e.misread, "misread"), (e.pageno, "pageno"), (e.same, "running"), (e.variant, "running"), (e.variant, "misread"), (e.off, "misread")):
        one = df.select("src", "rec_id", F.lit(kind).alias("noise"))
        out = one if out is None else out.union(one)
    return out.distinct()


def _mixed_right(direct: DataFrame, vocab: DataFrame, least: int = 3) -> DataFrame:
    """word -> right: words with foreign look-alikes and the most frequent pure word of the same looks."""
    words = direct.select("word").distinct().withColumn("looks", F.translate("word", *_LOOKS))
    pure = vocab.where((F.col("n") >= least) & F.col("word").rlike("^[а-яёәғқңөұүһі-]+$")).select(F.translate("word", *_LOOKS).alias("looks"), F.col("word").alias("right"), "n")
    return words.join(pure, "looks").groupBy("word").agg(F.max_by("right", F.struct("n", "right")).alias("right"))


def repaired_pages(pages: DataFrame, least_pages: int = 3, page_share: float = 0.12) -> DataFrame:
    """src, rec_id, text: every non-empty text as readable paragraphs, one per line.

    ``pages`` as in ``noise``.  Running lines and page numbers are left out
    (a record that holds nothing else has the text ''), cut words are joined,
    misread words with a known right one are replaced, wrapped lines go on in
    one paragraph.  A word cut between two records stays cut.
    """
    e = _evidence(pages, least_pages, page_share)
    empty = F.lit(None)
    fix = e.misread.select("src", "rec_id", "word", "right").union(e.direct.join(e.bad, "word", "left_anti").join(_mixed_right(e.direct, e.vocab), "word").select("src", "rec_id", "word", "right"))
    parts = [
        e.cuts.select("src", "rec_id", F.lit("join").alias("what"), F.col("own").alias("a"), empty.cast("string").alias("b")),
        fix.select("src", "rec_id", F.lit("fix").alias("what"), F.col("word").alias("a"), F.col("right").alias("b")),
        e.pageno.select("src", "rec_id", F.when(F.col("alone"), "drop").otherwise("strip").alias("what"), F.col("at").cast("string").alias("a"), empty.cast("string").alias("b")),
        e.same.select("src", "rec_id", F.lit("drop").alias("what"), F.col("at").cast("string").alias("a"), empty.cast("string").alias("b")),
        e.variant.select("src", "rec_id", F.lit("drop").alias("what"), F.col("at").cast("string").alias("a"), empty.cast("string").alias("b")),
    ]
    orders = parts[0]
    for p in parts[1:]:
        orders = orders.union(p)
    # at most one order per word or line of the record
    orders = orders.groupBy("src", "rec_id").agg(F.collect_set(F.struct("what", "a", "b")).alias("orders"))
    texts = pages.where("text is not null and text != ''").select("src", "rec_id", "text").join(orders, ["src", "rec_id"], "left")
    return texts.select("src", F.col("rec_id").cast("bigint").alias("rec_id"), "text", "orders").mapInArrow(chunked(_repair_batch, _REPAIRED, 128), "src string, rec_id bigint, text string")


_REPAIRED = pa.schema([("src", pa.string()), ("rec_id", pa.int64()), ("text", pa.string())])
_PAGE = r"(?:стр|с|лист|page|p)\.?\s*\d{1,4}(?:\s*(?:из|/|of)\s*\d{1,4})?"
_TAIL = re.compile(rf"(?:\s{{2,}}|\t|\s\|\s?){_PAGE}\s*$", re.I)
_LEAD = re.compile(rf"^\s*{_PAGE}(?:\s{{2,}}|\t|\s\|\s)(?=\S)", re.I)
_ENDS_CUT = re.compile(rf"[{LETTERS}0-9][-‐‑–¬\xad]$", re.I)
_GOES_ON = re.compile(rf"[{LETTERS}]")
_ITEM = re.compile(r"[•–▪◦*#>|-]|\d+[.)]\s")
_PROSE = re.compile(r"[.!?,;] ")


def _cased(like: str, word: str) -> str:
    if len(like) > 1 and like.upper() == like and like.lower() != like:
        return word.upper()
    return word[0].upper() + word[1:] if like[0].isupper() else word


def _goes_on(line: str, after: str, least: int = 40) -> bool:
    """Whether a line break inside a text of mixed widths is no paragraph's end."""
    if len(line) < least or _ITEM.match(line) or _ITEM.match(after):
        return False
    return line[-1] not in ".!?…:;»\")" and (after[0].islower() or bool(_PROSE.search(line)))


def repaired_text(text: str, drop: set[int], strip: set[int], joins: set[str], fixes: dict[str, str]) -> str:
    """One text without the lines ``drop`` and the page numbers in the lines ``strip`` (counted without blank lines), its words joined and fixed."""
    lines, at = [], 0
    for line in re.split(r"\r?\n", text):
        if line.strip(" ") == "":
            lines.append("")
            continue
        if at not in drop:
            lines.append(_LEAD.sub("", _TAIL.sub("", line)) if at in strip else line)
        at += 1
    text = "\n".join(lines)
    spans: list[list[int]] = []
    for a, b, _ in paragraphs(text):
        last = text[spans[-1][0] : spans[-1][1]].rsplit("\n", 1)[-1] if spans else ""
        if last and text[spans[-1][1] : a].count("\n") == 1 and (_ENDS_CUT.search(last) and _GOES_ON.match(text, a) or _goes_on(last, text[a:b])):
            spans[-1][1] = b
        else:
            spans.append([a, b])

    def join(m: re.Match) -> str:
        first, gap, rest = m.group(1), m.group(3), m.group(4)
        if f"{first}-{rest}".lower() in joins:
            return first + rest
        return f"{first}-{rest}" if "\n" in gap and m.group(2) != "–" else m.group()

    out = []
    for a, b in spans:
        part = re.sub(r"[ \t]*\n[ \t]*", " ", _CUT.sub(join, text[a:b]))
        out.append(_WORD.sub(lambda m: _cased(m.group(), fixes[m.group().lower()]) if m.group().lower() in fixes else m.group(), part).replace("\xad", ""))
    return "\n".join(out)


def _repair_batch(batch: pa.RecordBatch) -> dict[str, list]:
    out: dict[str, list] = {n: [] for n in _REPAIRED.names}
    for src, rec, text, orders in zip(*[c.to_pylist() for c in batch.columns]):
        by: dict[str, dict[str, str]] = {k: {} for k in ("drop", "strip", "join", "fix")}
        for o in orders or ():
            by[o["what"]][o["a"]] = o["b"]
        out["src"].append(src)
        out["rec_id"].append(rec)
        out["text"].append(repaired_text(text, {int(x) for x in by["drop"]}, {int(x) for x in by["strip"]}, set(by["join"]), by["fix"]))
    return out
