"""Markup left in parsed documents: its kinds, and the text without it.

Which pieces of a text are markup is decided by gradient-boosted trees over the
nodes of its tree (see ``nodes``): subtree density, attribute tokens, depth and
siblings.  Decoding is hierarchical, so nothing inside an accepted code block
or formula is accepted itself.  The trees are fitted on nodes of at most
``FIT_ROWS`` texts; the tables hold no labels, so a node of these is labelled
by the grammar below, read on the node alone.  The clean text is made by the
grammar for the kinds that the trees found in it: code blocks and displayed
formulas are set aside first, so nothing inside them is read as markup; then
HTML and LaTeX structure becomes block marks, lines become blocks (heading,
paragraph, item, row, quote, code, formula), and inline marks are taken off the
text of each block.  Signs that are no markup (comparison signs, prices, file
paths, bare bullets, numbering) stay as they are.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrow import chunked
from docloom.llm.nodes import HOLDS, Node, decoded, features, tree
from docloom.llm.trees import Trees, fitted

#: How many texts the trees are fitted on at most, and how many of their nodes.
FIT_ROWS, FIT_NODES = 1200, 40_000
KINDS = ("html", "latex", "markdown", "wiki")
# HTML elements; other words in angle brackets are text.
_TAGS = frozenset(
    """a abbr acronym address area article aside audio b base bdi bdo big blockquote body br button canvas caption center cite code col colgroup dd del details dfn dialog dir div dl dt em
    embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark menu meta nav nobr
    noscript object ol optgroup option p param picture pre q s samp script section select small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th
    thead time title tr track tt u ul var video wbr""".split()
)
_BLOCKS = frozenset("p div ul ol dl dt dd table thead tbody tfoot caption hr section article header footer blockquote center body html head title form figure figcaption main nav aside".split())
_WIKI_TAGS = frozenset("ref references nowiki gallery noinclude includeonly onlyinclude".split())
_LEVELS = {"part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4, "subparagraph": 5}
# LaTeX commands that stand without braces.
_BARE = "item|hline|toprule|midrule|bottomrule|maketitle|tableofcontents|centering|newpage|clearpage|pagebreak|noindent|par|bigskip|medskip|smallskip|LaTeX|TeX|ldots|dots|quad|qquad|appendix|bfseries|itshape|large|Large|small"
_MATH_ENVS = "equation|align|gather|multline|eqnarray|displaymath|math|flalign"
_CODE_ENVS = "verbatim|lstlisting|minted|alltt"

_HELD = re.compile(
    rf"""^[ \t]*(?P<fence>`{{3,}}|~{{3,}})[^\n`]*\n(?P<fenced>.*?)(?:^[ \t]*(?P=fence)[`~]*[ \t]*$|\Z)
    |(?P<wikitag><(?P<wt>syntaxhighlight|source|nowiki)\b[^>]*>(?P<wikicode>.*?)</(?P=wt)\s*>)
    |<pre\b[^>]*>(?P<pre>.*?)(?:</pre\s*>|\Z)
    |<script\b[^>]*>(?P<script>.*?)</script\s*>
    |\\begin\{{(?P<env>(?:{_CODE_ENVS})\*?)\}}(?P<verbatim>.*?)(?:\\end\{{(?P=env)\}}|\Z)
    |\\begin\{{(?P<menv>(?:{_MATH_ENVS})\*?)\}}(?P<formula>.*?)\\end\{{(?P=menv)\}}
    |(?<![\\$])\$\$(?P<dollars>[^$]+?)\$\$
    |\\\[(?P<square>.+?)\\\]""",
    re.M | re.S | re.X | re.I,
)
_PATH = re.compile(r"(?<!\w)[A-Za-z]:\\[^\s{}<>|*?\"]+(?![^\s]*\{)|(?<!\S)\\\\[\w.$-]+(?:\\[\w.$-]+)+")
_INLINE_CODE = re.compile(r"(?<!`)(`{1,2})(?!`)(?=\S)([^`\n]+?)\1(?!`)|<code\b[^>]*>(.*?)</code\s*>", re.S | re.I)
_INLINE_MATH = re.compile(r"(?<![\\$\w])\$(?=[^\s$])([^$\n]{0,200}?[\\^_{][^$\n]{0,200}?)(?<=[^\s$])\$(?![\d$])|(?<![\\$\w])\$([A-Za-z])\$(?!\w)|\\\((.+?)\\\)", re.S)
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)((?:\s+[A-Za-z_:][\w:.-]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'<>]+))?)*)\s*/?>")
_DOCTYPE = re.compile(r"<!doctype[^>]*>", re.I)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_BRACED = r"\{((?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*)\}"
_HEADING_TEX = re.compile(rf"\\({'|'.join(_LEVELS)})\*?(?:\[[^\]\n]*\])?{_BRACED}(?:\s*\\label\{{[^{{}}]*\}})?")
_TABULAR = re.compile(r"\\begin\{(tabularx?\*?|longtable|array)\}(?:\[[^\]\n]*\])?(?:\{[^{}]*\})*(.*?)\\end\{\1\}", re.S)
_ENV = re.compile(r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\])?(?:\{[^{}\n]*\})?")
_ITEM_TEX = re.compile(r"(?<![\w:\\])\\item\b(?:\[([^\]\n]*)\])?[ \t]*")
_HREF = re.compile(rf"\\href\{{[^{{}}]*\}}{_BRACED}")
_NOTE_TEX = re.compile(rf"\\(?:footnote|thanks){_BRACED}")
_LABEL = re.compile(r"\\(?:label|index|vspace\*?|hspace\*?|usepackage|documentclass|pagestyle)(?:\[[^\]\n]*\])?\{[^{}]*\}")
_COMMAND = re.compile(rf"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?{_BRACED}")
_BARE_TEX = re.compile(rf"(?<![\w:\\])\\(?:{_BARE})(?![A-Za-z])|^[ \t]*\\[A-Za-z]{{2,}}(?![A-Za-z\\/.])", re.M)
_TITLE_WIKI = re.compile(r"^\s*(={2,6})\s*([^=\s].*?)\s*\1\s*$")
_TITLE_MD = re.compile(r"^ {0,3}(#{1,6})[ \t]+(\S.*?)(?:[ \t]+#+)?[ \t]*$")
_UNDER = re.compile(r"^ {0,3}(={3,}|-{3,})\s*$")
_RULE = re.compile(r"^ {0,3}(?:---|\*\*\*|\* \* \*|- - -)\s*$")
_PARTED = re.compile(r"^\s*\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)*\|?\s*$")
_QUOTE = re.compile(r"^ {0,3}>+[ \t]*(?=\S)(?!\s*[\d=])")
_TASK = re.compile(r"^\s*[-*+] \[[ xXхХ]\]\s+")
_BULLET = re.compile(r"^\s*(?:[-*+•–▪◦·]|#(?=\s*\[\[))\s+(?=\S)")
_NOTE_AT = re.compile(r"^ {0,3}\[\^[^\]\s]+\]:\s*")
_HIDDEN_WIKI = re.compile(r"\[\[(?:категория|category|санат)\s*:[^\[\]]*\]\][ \t]*|__(?:NO)?TOC__|\{\{[^{}]*\}\}", re.I)
_INLINE_WIKI = (
    re.compile(r"\[\[(?:[^\[\]|]*\|)*([^\[\]|]+)\]\]"),
    re.compile(r"\[(?:https?|ftp)://[^\s\]]+\s+([^\]]+)\](?!\()"),
    re.compile(r"'''''(?=\S)(.{1,300}?)'''''", re.S),
    re.compile(r"'''(?=\S)(.{1,300}?)'''", re.S),
    re.compile(r"(?<!')''(?=[^\s'])(.{1,300}?)''(?!')", re.S),
)
_INLINE_MD = (
    re.compile(r"!\[([^\]\n]*)\]\([^()\s]+(?:\s+\"[^\"]*\")?\)"),
    re.compile(r"(?<!!)\[([^\]\n]+)\]\((?:[^()\s]+)(?:\s+\"[^\"]*\")?\)"),
    re.compile(r"<((?:https?|ftp|mailto):[^\s<>]+)>"),
    re.compile(r"\[\^[^\]\s]+\]()"),
    re.compile(r"(?<!\*)\*\*(?=[^\s*])(.{1,300}?)(?<=\S)\*\*(?!\*)", re.S),
    re.compile(r"(?<![\w_])__(?=[^\s_])(.{1,300}?)(?<=[^\s_])__(?![\w_])", re.S),
    re.compile(r"(?<!~)~~(?=[^\s~])(.{1,300}?)(?<=[^\s~])~~(?!~)", re.S),
    re.compile(r"(?<![\w*])\*(?=[^\s*])([^*\n]{1,300}?)(?<=[^\s*])\*(?![\w*])"),
    re.compile(r"(?<![\w_])_(?=[^\s_])([^_\n]{1,300}?)(?<=[^\s_])_(?![\w_])"),
)
_MARK = re.compile("\ue000(\\d+)\ue001")
_OWN = re.compile("[\ue000-\ue003]")


def _named(entity: str) -> bool:
    return entity[1] == "#" or entity[1:] in html.entities.html5


class _Reader:
    """Blocks and markup kinds of one text."""

    def __init__(self, allowed: frozenset[str] = frozenset(KINDS)) -> None:
        self.allowed = allowed
        self.kinds: set[str] = set()
        self.held: list[tuple[str, str]] = []
        self.blocks: list[tuple[str, int, str]] = []

    def hold(self, kind: str, text: str) -> str:
        self.held.append((kind, text))
        return f"\ue000{len(self.held) - 1}\ue001"

    def _hold_block(self, m: re.Match) -> str:
        g = m.groupdict()
        if g["script"] is not None:
            self.kinds.add("html")
            return "\n"
        for name, kind in (("fenced", "markdown"), ("wikicode", "wiki"), ("pre", "html"), ("verbatim", "latex")):
            if g[name] is not None:
                self.kinds.add(kind)
                body = g[name]
                if name == "pre":
                    body = html.unescape(re.sub(r"</?code\b[^>]*>", "", body, flags=re.I))
                if name == "wikicode" and g["wt"].lower() == "nowiki":
                    return self.hold("text", body)
                return f"\n{self.hold('code', body.strip(chr(10)))}\n"
        self.kinds.add("latex")
        return f"\n{self.hold('formula', next(g[n] for n in ('formula', 'dollars', 'square') if g[n] is not None).strip())}\n"

    def _tag(self, m: re.Match) -> str:
        name = m.group(2).lower()
        if name in _WIKI_TAGS:
            self.kinds.add("wiki")
            return " "
        if name not in _TAGS:
            return m.group()
        self.kinds.add("html")
        closing = bool(m.group(1))
        if re.fullmatch("h[1-6]", name):
            return "\n" if closing else f"\n\ue002h{name[1]}\ue003"
        if name in ("li", "tr"):
            return "\n" if closing else f"\n\ue002{name}\ue003"
        if name in ("td", "th"):
            return "" if closing else "\ue002td\ue003"
        if name in _BLOCKS:
            return "\n"
        return " " if name == "br" else ""

    def _take(self, pattern: re.Pattern, kind: str, by, text: str) -> str:
        if kind not in self.allowed:
            return text
        out, n = pattern.subn(by, text)
        if n:
            self.kinds.add(kind)
        return out

    def inline(self, text: str) -> str:
        """The text of one block without inline marks."""
        text = self._take(_HIDDEN_WIKI, "wiki", "", text)
        for p in _INLINE_WIKI:
            text = self._take(p, "wiki", r"\1", text)
        for p in _INLINE_MD:
            text = self._take(p, "markdown", r"\1", text)
        text = self._take(_NOTE_TEX, "latex", r" (\1)", text)
        text = self._take(_HREF, "latex", r"\1", text)
        text = self._take(_LABEL, "latex", "", text)
        for _ in range(3):
            text = self._take(_COMMAND, "latex", r"\1", text)
        if _BARE_TEX.search(text):
            text = self._take(_BARE_TEX, "latex", "", text)
        if "latex" in self.kinds:
            text = re.sub(r"\\([%&$#_{}])", r"\1", re.sub(r"(?<=\S)~(?=\S)", " ", text))
        found = [e for e in _ENTITY.findall(text) if _named(e)]
        if found:
            self.kinds.add("html")
            text = html.unescape(text)
        text = _MARK.sub(lambda m: self.held[int(m.group(1))][1], text)
        return re.sub(r"[ \t\xa0]+", " ", _OWN.sub("", text)).strip()

    def _table_tex(self, m: re.Match) -> str:
        self.kinds.add("latex")
        rows = [r for r in re.split(r"\\\\(?:\[[^\]]*\])?", re.sub(r"\\(?:hline|toprule|midrule|bottomrule)\b", "", m.group(2))) if r.strip()]
        return "\n" + "\n".join("\ue002tr\ue003" + "".join("\ue002td\ue003" + " ".join(c.split()) for c in re.split(r"(?<!\\)&", r)) for r in rows) + "\n"

    def _put(self, kind: str, level: int, text: str) -> None:
        if text:
            self.blocks.append((kind, level, text))

    def _row(self, cells: list[str]) -> None:
        cells = [self.inline(c) for c in cells]
        if any(cells):
            self.blocks.append(("row", 0, "\t".join(cells)))

    def read(self, text: str) -> None:
        text = _OWN.sub("", text.replace("\r\n", "\n"))
        text = _HELD.sub(self._hold_block, text)
        text = _PATH.sub(lambda m: self.hold("text", m.group()), text)
        text = _INLINE_CODE.sub(self._hold_code, text)
        text = _INLINE_MATH.sub(self._hold_math, text)
        text = self._take(_COMMENT, "html", "", text)
        text = self._take(_DOCTYPE, "html", "", text)
        text = _TAG.sub(self._tag, text)
        text = _TABULAR.sub(self._table_tex, text)
        text = self._take(_HEADING_TEX, "latex", lambda m: f"\n\ue002h{_LEVELS[m.group(1)]}\ue003{m.group(2)}\n", text)
        text = self._take(_ENV, "latex", "\n", text)
        text = self._take(_ITEM_TEX, "latex", lambda m: f"\n\ue002li\ue003{m.group(1) + ' ' if m.group(1) else ''}", text)
        self._lines(text.split("\n"))

    def _hold_code(self, m: re.Match) -> str:
        if m.group(3) is not None:
            self.kinds.add("html")
            return self.hold("text", html.unescape(m.group(3)))
        self.kinds.add("markdown")
        return self.hold("text", m.group(2))

    def _hold_math(self, m: re.Match) -> str:
        self.kinds.add("latex")
        return self.hold("text", m.group())

    def _lines(self, lines: list[str]) -> None:
        part: list[str] = []
        wiki = table = False

        def flush() -> None:
            if part:
                self._put("paragraph", 0, self.inline("\n".join(part)))
                part.clear()

        for at, line in enumerate(lines):
            body = line.strip()
            after = lines[at + 1] if at + 1 < len(lines) else ""
            if not body:
                flush()
                table = False
                continue
            if (m := _MARK.fullmatch(body)) and self.held[int(m.group(1))][0] != "text":
                flush()
                kind, held = self.held[int(m.group(1))]
                self._put(kind, 0, held)
                continue
            if body.startswith("\ue002"):
                flush()
                name, rest = body[1:].split("\ue003", 1)
                if name[0] == "h":
                    self._put("heading", int(name[1:]), self.inline(rest))
                elif name == "li":
                    self._put("item", 0, self.inline(rest))
                else:
                    self._row((rest if name == "tr" else body).split("\ue002td\ue003")[1:])
                continue
            if body.startswith("{|"):
                flush()
                self.kinds.add("wiki")
                wiki = True
                continue
            if wiki:
                if body.startswith("|}"):
                    wiki = False
                elif body.startswith("|+"):
                    self._put("paragraph", 0, self.inline(body[2:]))
                elif body[0] in "|!" and not body.startswith("|-"):
                    self._row([c for c in re.split(r"\|\||!!", body[1:])])
                elif body[0] not in "|!":
                    self._put("paragraph", 0, self.inline(body))
                continue
            if m := _TITLE_WIKI.match(line):
                flush()
                self.kinds.add("wiki")
                self._put("heading", len(m.group(1)), self.inline(m.group(2)))
                continue
            if m := _TITLE_MD.match(line):
                flush()
                if m.group(1) == "#" and m.group(2).startswith("[["):
                    self._put("item", 0, self.inline(m.group(2)))
                else:
                    self.kinds.add("markdown")
                    self._put("heading", len(m.group(1)), self.inline(m.group(2)))
                continue
            if part and (m := _UNDER.match(line)):
                self.kinds.add("markdown")
                title = part.pop()
                flush()
                self._put("heading", 1 if m.group(1)[0] == "=" else 2, self.inline(title))
                continue
            if _RULE.match(line):
                flush()
                self.kinds.add("markdown")
                continue
            if "|" in body and not table and _PARTED.match(after) and "|" in after:
                flush()
                table = True
            if table:
                if "|" not in body:
                    table = False
                else:
                    self.kinds.add("markdown")
                    if not _PARTED.match(line):
                        self._row(re.split(r"(?<!\\)\|", body.removeprefix("|").removesuffix("|")))
                    continue
            if m := _QUOTE.match(line):
                flush()
                self.kinds.add("markdown")
                self._put("quote", 0, self.inline(line[m.end() :]))
                continue
            if m := (_TASK.match(line) or _NOTE_AT.match(line)):
                flush()
                self.kinds.add("markdown")
                self._put("item", 0, self.inline(line[m.end() :]))
                continue
            if m := _BULLET.match(line):
                flush()
                self._put("item", 0, self.inline(line[m.end() :]))
                continue
            part.append(line)
        flush()


def read(text: str, allowed: frozenset[str] = frozenset(KINDS)) -> tuple[list[str], list[tuple[str, int, str]]]:
    """(kinds of markup, (kind, level, clean text) of the blocks) of one text by the grammar."""
    reader = _Reader(allowed)
    reader.read(text)
    return sorted(reader.kinds), reader.blocks


def labels(text: str, nodes: list[Node]) -> list[int]:
    """1 for the nodes that the grammar reads as markup of their kind, 0 for others and for all inside code and formulas."""
    out: list[int] = []
    for n in nodes:
        up, held = n.parent, False
        while up >= 0 and not held:
            held = bool(out[up]) and nodes[up].name in HOLDS
            up = nodes[up].parent
        around = text[max(n.start - 1, 0) : n.end + 1] if n.name in ("stress", "strong", "formula", "bare", "quotes") else text[n.start : n.end]
        out.append(int(not held and n.kind in read(around)[0]))
    return out


def fit(texts: DataFrame, rows: int = FIT_ROWS) -> Trees:
    """Trees fitted on the nodes of at most ``rows`` texts, taken by the hash of the text so that any size of table gives as many."""
    import numpy as np

    xs, ys, left = [], [], FIT_NODES
    for (text,) in texts.where("text is not null").select("text").orderBy(F.xxhash64("text"), "text").limit(rows).toLocalIterator():
        nodes = tree(text)[:left]
        nodes = [n for n in nodes if n.parent < len(nodes)]
        for n in nodes:
            n.children = [c for c in n.children if c < len(nodes)]
        if nodes:
            xs.append(features(text, nodes))
            ys.extend(labels(text, nodes))
            left -= len(nodes)
        if left <= 0:
            break
    x = np.concatenate(xs) if xs else np.zeros((0, features("", []).shape[1]), dtype=np.float32)
    return fitted(x, np.array(ys, dtype=np.float64), rounds=50)


def found_kinds(texts: list[str], model: Trees) -> list[list[str]]:
    """For every text the kinds of the nodes that the trees and the decoding accept; the nodes of all texts are scored together."""
    import numpy as np

    trees = [tree(t) for t in texts]
    marked = [k for k, nodes in enumerate(trees) if nodes]
    out: list[list[str]] = [[] for _ in texts]
    if not marked:
        return out
    odds = model.log_odds(np.concatenate([features(texts[k], trees[k]) for k in marked]))
    at = 0
    for k in marked:
        nodes = trees[k]
        out[k] = sorted({nodes[n].kind for n in decoded(nodes, odds[at : at + len(nodes)])} - {""})
        at += len(nodes)
    return out


_KINDS = pa.schema([("src", pa.string()), ("rec_id", pa.int64()), ("markup", pa.string())])
_BLOCKS_OUT = pa.schema([("src", pa.string()), ("rec_id", pa.int64()), ("seq", pa.int32()), ("kind", pa.string()), ("level", pa.int32()), ("text", pa.string())])


def _texts(texts: DataFrame) -> DataFrame:
    return texts.select("src", F.col("rec_id").cast("bigint").alias("rec_id"), "text").where("text is not null and trim(text) != ''")


def markup(texts: DataFrame) -> DataFrame:
    """src, rec_id, markup: one row per text of ``texts`` (src, rec_id, text) and kind of markup in it.

    Null and blank texts have none; repeated texts give repeated rows; an empty
    table gives none.
    """
    rows = _texts(texts)
    shared = rows.sparkSession.sparkContext.broadcast(fit(rows))

    def one(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in _KINDS.names}
        src_of, rec_of, text_of = (c.to_pylist() for c in batch.columns)
        for src, rec, kinds in zip(src_of, rec_of, found_kinds(text_of, shared.value)):
            for kind in kinds:
                for name, value in zip(_KINDS.names, (src, rec, kind)):
                    out[name].append(value)
        return out

    return rows.mapInArrow(chunked(one, _KINDS, 128), "src string, rec_id bigint, markup string")


def clean_blocks(texts: DataFrame) -> DataFrame:
    """src, rec_id, seq, kind, level, text: the blocks of every text in order, without markup of the kinds found in it.

    kind is 'heading' (with its level), 'paragraph', 'item', 'row' (cells parted
    by tabs), 'quote', 'code' or 'formula'; the last two keep their own source.
    """
    rows = _texts(texts)
    shared = rows.sparkSession.sparkContext.broadcast(fit(rows))

    def one(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in _BLOCKS_OUT.names}
        src_of, rec_of, text_of = (c.to_pylist() for c in batch.columns)
        for src, rec, text, kinds in zip(src_of, rec_of, text_of, found_kinds(text_of, shared.value)):
            for seq, (kind, level, clean) in enumerate(read(text, frozenset(kinds))[1]):
                for name, value in zip(_BLOCKS_OUT.names, (src, rec, seq, kind, level, clean)):
                    out[name].append(value)
        return out

    return rows.mapInArrow(chunked(one, _BLOCKS_OUT, 128), "src string, rec_id bigint, seq int, kind string, level int, text string")
