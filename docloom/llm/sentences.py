"""Sentence units of texts in spaced and spaceless scripts.

A text is cut in three steps.  Lines are joined back into paragraphs where the
break is a hard wrap (the next word would not have fitted the text's line
width).  Inside a paragraph every terminator, and every closing mark after one,
opens a gap.  The gaps of a paragraph form a lattice: at each one the unit ends
or goes on, and the cheapest way through it is taken.  The costs are evidence
beside the gap (abbreviation kinds, initials, figures and the opening of what
follows in spaced scripts) and in the unit that would end there (it must hold a
word and close its brackets).  Spaceless text beside a gap is segmented by a
word lattice over a dictionary.  A wide terminator ends a sentence there unless
the clause goes on; a gap at a narrow one is classified by the final particle
before it and the opening word after it.  Thai has no terminator, its gaps are
blanks between Thai signs that stand next to no figure.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.functions.arrow import chunked

# Abbreviations that never end a sentence, by the word before the full stop.
NEVER = frozenset(
    """см прил рис табл разд корп каб тыс п ул пр стр гл ст им напр оф кв пер наб пл обл р-н пос ср т.е т.к
    dr mr mrs ms prof fig sec para vol no e.g i.e cf art pp eq ch jan feb mar apr jun jul aug sept sep oct nov dec st vs viz
    abschn nr gem lt inkl evtl ggf sog bzw ca vgl str z.b d.h u.a
    sr sra srta pág núm cap ej av
    mme mlle chap fig env
    млн млрд т.б
    डॉ रु श्री प्रो د أ ص""".split()
)
# Abbreviations that end a sentence when a capital or a figure follows.
MAYBE = frozenset("""г гг руб коп т.д т.п др пр.а ж etc ltd inc co corp p.m a.m usw etc. м ч мин чел шт экз jr م ه""".split())
# Words after a German ordinal, which keep its full stop inside the sentence.
ORDINAL = frozenset("""januar februar märz april mai juni juli august september oktober november dezember stock jahrhundert quartal auflage kapitel etage""".split())
# What follows a closing quotation mark when the sentence goes on (Japanese, Chinese), and words that end the clause before a quotation.
GO_ON = ("と", "を", "が", "は", "に", "の", "で", "も", "や", "へ", "から", "まで", "など", "って", "的", "是", "和", "与", "等", "，", "、", "；", "：", "说", "道", "问", "写道")
SAYING = ("说", "道", "问", "写道", "表示", "指出", "一边")
# Final particles, words that open a sentence, and words that begin like a particle but are none.
FINAL = ("吗", "呢", "吧", "了", "啊", "か", "ね", "よ", "です", "ます", "でした", "ました", "ません", "だ", "た", "ない")
OPENING = ("为什么", "如果", "但是", "因为", "所以", "然后", "首先", "其次", "最后", "同时", "此外", "请", "なぜ", "しかし", "また", "そして", "それから", "まず", "次に", "さらに", "この", "その", "彼", "私")
PLAIN = ("说明", "说法", "道路", "道理", "问题", "问答", "是否", "和平", "与会", "等级", "等待", "的确", "的士", "とき", "ところ", "とても", "はじめ", "がんばる", "のち", "もの", "もう", "でも", "ではない", "にわか", "へや", "やっと")
LEADS = ("：", ":", "，", "、", ",")

OPEN = {"«": "»", "„": "“”", "“": "”", '"': '"', "(": ")", "（": "）", "「": "」", "『": "』", "[": "]", "‹": "›", "‘": "’"}
_TOKEN = re.compile(r"[.!?…。！？؟।۔॥]+|[«„“\"(（「『\[‹]")
_MARK = re.compile(r"[ \t]*(?:[*•–‣▪◦·-]|\(?(?:\d{1,3}(?:\.\d{1,3})*[.)]|[^\W\d_]\)))[ \t]+\S")
_BULLET = re.compile(r"[ \t]*(?:[*•–‣▪◦·-]|\(?(?:\d{1,3}|[^\W\d_])\))[ \t]+\S")
_WORD_BEFORE = re.compile(r"(?:[^\W\d_]\.\s?)*[^\s.,;:!?…()«»„“”\"\[\]]+$")
_THAI = re.compile("[฀-๿]")
_THAI_GAP = re.compile(r"(?<=[^\s\d.,%])[  ]+(?=[^\s\d.,%])")
_DIGIT_END = re.compile(r"\d[\s ]*$")
_BLANK = re.compile(r"\s*")
_CJK_END = frozenset("。！？")
_CLOSERS = "»”“\"')）」』]›’"


def _wide(c: str) -> bool:
    return "぀" <= c <= "鿿" or "＀" <= c <= "￯" or "　" <= c <= "〿"


_DICTIONARY = frozenset((*GO_ON, *SAYING, *FINAL, *OPENING, *PLAIN))
_LONGEST = max(map(len, _DICTIONARY))


@lru_cache(50_000)
def words(run: str) -> tuple[str, ...]:
    """A spaceless run as words: the cheapest way through the lattice of dictionary words, a sign that no word covers costing more than a word."""
    cost, back = [0.0], [0]
    for end in range(1, len(run) + 1):
        best = (cost[end - 1] + 2.0, end - 1)
        for size in range(1, min(end, _LONGEST) + 1):
            if run[end - size : end] in _DICTIONARY:
                # of equally cheap ways the one with the longer last word
                best = min(best, (cost[end - size] + 1.0, end - size))
        cost.append(best[0])
        back.append(best[1])
    out, at = [], len(run)
    while at:
        out.append(run[back[at] : at])
        at = back[at]
    return tuple(reversed(out))


def _words_at(text: str, at: int, wanted: tuple[str, ...], window: int = 12) -> str:
    """The word of the lattice that starts at a place when it is one of those wanted, or ''."""
    run = words(text[at : at + window])
    return run[0] if run and run[0] in wanted else ""


def _word_before(text: str, at: int, window: int = 12) -> str:
    """The word of the lattice that ends at a place."""
    run = words(text[max(at - window, 0) : at])
    return run[-1] if run else ""


def paragraphs(text: str, least_wrap: int = 30, most_wrap: int = 120) -> list[tuple[int, int, bool]]:
    """(start, end, is list item) of the paragraphs; a hard-wrapped line goes on in the next one.

    A break is a wrap when the line plus the next word would exceed the text's
    longest line, for texts whose longest line has between ``least_wrap`` and
    ``most_wrap`` characters.
    """
    lines, at = [], 0
    for line in text.split("\n"):
        lines.append((at, at + len(line), line))
        at += len(line) + 1
    width = max(len(x[2].rstrip()) for x in lines)
    wraps = least_wrap <= width <= most_wrap
    out: list[list] = []
    before = None
    for start, end, line in lines:
        body = line.strip()
        if not body:
            before = None
            continue
        s = start + len(line) - len(line.lstrip())
        e = start + len(line.rstrip())
        item = bool(_MARK.match(line))
        if before is not None and wraps:
            tail = before.rstrip()
            first = 1 if _wide(body[0]) else len(body.split(None, 1)[0])
            if len(tail) + 1 + first > width and not (item and (_BULLET.match(line) or tail[-1] in ".:;!?")):
                out[-1][1] = e
                before = line
                continue
        out.append([s, e, item])
        before = line
    return [tuple(x) for x in out]


def _ends(text: str, start: int, at: int, end: int, stop: int) -> bool:
    """Whether the terminator text[at:end] ends the unit that began at start."""
    n = _BLANK.match(text, end, stop).end()
    if n >= stop:
        return True
    c, mark = text[n], text[at]
    if mark in "。！？":
        return c not in "，、；："
    if mark in ".!?" and n == end and at > start and _wide(c) and _wide(text[at - 1]):
        # a narrow terminator inside spaceless text may stand for anything: the words beside it decide
        return _word_before(text, at) in FINAL or bool(_words_at(text, n, OPENING))
    if mark == "…" and (_wide(c) or _wide(text[at - 1])):
        return True
    if mark in "।॥؟۔":
        return True
    if c.islower() or c in ",;:—–-)»”%/":
        return False
    if mark == "…":
        return True
    if mark != "." or end - at > 1:
        return n > end or c.isupper() or not c.isalpha() or mark in "!?" and not c.isalnum()
    # a single full stop
    m = _WORD_BEFORE.search(text, max(start, at - 24), at)
    word = m.group() if m else ""
    glued = n == end
    if glued:
        if not c.isupper() or not (n + 1 < stop and (text[n + 1].islower() or text[n + 1] in " «\"") or c in "«(\""):
            return False
        if not (word[-1:].islower() or word[-1:].isdigit() or not word or re.search(r"[^\W\d_]\.[^\W\d_]$", word)):
            return False
    if not word:
        return True  # after a closing mark or a sign
    low = re.sub(r"[\s ]", "", word).lower()
    if word.isdigit() or word.replace(".", "").isdigit():
        if m.start() <= start:
            return False  # number at the head of a heading or item
        if len(word) <= 2 and c.isalpha():
            nxt = re.match(r"[^\W\d_]+", text[n : n + 20])
            return not (nxt and nxt.group().lower() in ORDINAL)
        return True
    last = low.rsplit(".", 1)[-1]
    if low in MAYBE or (last in MAYBE and "." not in low):
        if last in ("г", "м", "ж", "م", "ه", "ч"):
            return bool(_DIGIT_END.search(text, max(start, m.start() - 4), m.start()))
        return True
    if low in NEVER or last in NEVER and len(last) > 1:
        return False
    if len(last) == 1:
        if re.search(r"[^\W\d_]\.[^\W\d_]$", word) and word[-1].isupper():
            return bool(re.search(r"[^\W\d_]{2,}[\s ]$", text[max(start, m.start() - 20) : m.start()])) and c.isupper()
        return not word[-1].isalpha() or low in ("т.д", "т.п")
    return True


def _after_close(text: str, start: int, opened: int, close: int, stop: int) -> bool:
    """Whether a quotation or bracket that closes right after a terminator ends the unit."""
    n = _BLANK.match(text, close + 1, stop).end()
    if n >= stop:
        return True
    c = text[n]
    if c in ".!?…。！？؟।,;:，、；：—–-)）":
        return False
    at_start = _BLANK.match(text, start, stop).end() == opened
    if text[opened] in "([（":
        return at_start and not c.islower()
    if _wide(text[opened]) or _wide(text[opened + 1]) or _wide(c):
        if text[opened] in "「『":
            return not _words_at(text, n, GO_ON) and text[opened - 1] in LEADS
        if at_start or _words_at(text, n, SAYING):
            return False
        return text[opened - 1] in LEADS and not _words_at(text, n, GO_ON)
    if at_start and not c.isupper() and not c.isdigit() and c not in '«„“"([¿¡':
        return False
    return not c.islower()


def units(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentence units of one text, in order."""
    out: list[tuple[int, int]] = []
    if not text or text.isspace():
        return out
    for start, stop, item in paragraphs(text):
        if item and _BULLET.match(text, start, stop):
            out.append((start, stop))
            continue
        if _THAI.search(text, start, stop):
            at = start
            for m in _THAI_GAP.finditer(text, start, stop):
                if _THAI.match(text, m.start() - 1) or _THAI.match(text, m.end()):
                    out.append((at, m.start()))
                    at = m.end()
            out.append((at, stop))
            continue
        out.extend(_cheapest(text, start, stop, _gaps(text, start, stop)))
    return out


def _closing(text: str, a: int, stop: int) -> int:
    """Where the quotation or bracket that opens at a closes, -1 where it does not."""
    c = text[a]
    closes = OPEN[c]
    e = text.find(closes[0], a + 1, stop)
    if len(closes) > 1 and e < 0:
        e = text.find(closes[1], a + 1, stop)
    if c == "«" and e > 0:
        inner = text.find("«", a + 1, e)
        while inner > 0:
            nxt = text.find("»", e + 1, stop)
            if nxt < 0:
                break
            inner = text.find("«", inner + 1, nxt) if inner + 1 < e else text.find("«", e, nxt)
            e = nxt
    elif e > 0 and c not in closes and text.find(c, a + 1, e) > 0:
        return -1  # the closing mark belongs to a later opening one
    return e


def _gaps(text: str, start: int, stop: int) -> list[tuple[int, int, int, int]]:
    """(place of the terminator, its end, end of a unit that ends here, place of the opening mark or -1) of every gap; closed quotations are passed over."""
    out = []
    pos = start
    while pos < stop:
        m = _TOKEN.search(text, pos, stop)
        if m is None:
            break
        a, b = m.span()
        if text[a] in OPEN:
            e = _closing(text, a, stop)
            if e < 0:
                pos = b
                continue
            inner_end = text[a + 1 : e].rstrip()[-1:]
            pos = e + 1
            if inner_end and inner_end in ".!?…。！？؟।":
                out.append((e, e + 1, e + 1, a))
            continue
        pos = end = b
        while end < stop and text[end] in _CLOSERS and text[end] not in '"“„':
            end += 1
        out.append((a, b, end, -1))
    return out


#: Costs of going against the evidence beside a gap, of a unit without a word, and of a unit that leaves a bracket open.
AGAINST, NO_WORD, UNCLOSED = 4.0, 6.0, 1.0


def _unit_cost(text: str, start: int, end: int) -> float:
    cost = 0.0 if _SIGN.search(text, start, end) else NO_WORD
    for a, b in ("()", "[]", "（）"):
        if text.count(a, start, end) > text.count(b, start, end):
            cost += UNCLOSED
    return cost


def _cheapest(text: str, start: int, stop: int, gaps: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """The units of the cheapest way through the gaps of a paragraph.

    A state is whether a unit ended at the last gap or goes on, with the start
    of the unit that is open; two states a gap, so the work grows with the
    number of gaps.  Of equally cheap ways the one that goes on is taken.
    """
    # cost, start of the open unit, link to the last unit: (start, end, link)
    ways: list[tuple[float, int, tuple | None]] = [(0.0, start, None)]
    for a, b, end, opened in gaps:
        on, over = None, None
        for cost, at, units_ in ways:
            if at > a:
                on = min(on or (cost, at, units_), (cost, at, units_), key=lambda w: w[0])
                continue
            here = _after_close(text, at, opened, b - 1, stop) if opened >= 0 else _ends(text, at, a, b, stop)
            go = (cost + (AGAINST if here else 0.0), at, units_)
            end_cost = cost + (0.0 if here else AGAINST) + _unit_cost(text, at, end)
            if on is None or go[0] < on[0]:
                on = go
            if over is None or end_cost < over[0]:
                over = (end_cost, _BLANK.match(text, end, stop).end(), (at, end, units_))
        ways = [w for w in (on, over) if w is not None]
        least = min(w[0] for w in ways)
        ways = [w for w in ways if w[0] <= least + 2 * AGAINST]
    best = None
    for cost, at, units_ in ways:
        total = cost + (_unit_cost(text, at, stop) if at < stop else 0.0)
        if best is None or total < best[0]:
            best = (total, (at, stop, units_) if at < stop else units_)
    out = []
    link = best[1]
    while link is not None:
        out.append((link[0], link[1]))
        link = link[2]
    return out[::-1]


_SIGN = re.compile(r"\w")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start_pos", pa.int32()), ("end_pos", pa.int32())])


def _cut(batch: pa.RecordBatch) -> dict[str, list]:
    ids: list[int] = []
    starts: list[int] = []
    ends: list[int] = []
    for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        for a, b in units(t or ""):
            ids.append(d)
            starts.append(a)
            ends.append(b)
    return {"doc_id": ids, "start_pos": starts, "end_pos": ends}


def sentence_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start_pos, end_pos of every sentence unit; offsets are code points.

    A narrow operator: no shuffle, one pass over the two columns read.  Null,
    empty and blank texts give no unit; repeated rows give repeated units;
    further columns are ignored.
    """
    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(chunked(_cut, _SCHEMA), "doc_id bigint, start_pos int, end_pos int")
