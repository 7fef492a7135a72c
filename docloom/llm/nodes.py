"""The tree of possible markup in a text, and the features of its nodes.

Whatever could be markup is a node: tags, entities, emphasis, links, commands,
environments, formulas, headings, table rows, fences.  Nodes hang on the
smallest node around them, so a text is a tree like a document object model.
Shapes are loose on purpose; which nodes are markup is for a model to say.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np

KINDS = ("html", "latex", "markdown", "wiki")
# Shapes of nodes with the language they belong to; True for those that hold text as it is.
SHAPES: tuple[tuple[str, str, bool, str], ...] = (
    ("fence", "markdown", True, r"^[ \t]*(`{3,}|~{3,})[^\n`]*\n(?:.*?\n)??[ \t]*\1[ \t]*$"),
    ("pre", "html", True, r"<pre\b[^>]*>.*?</pre\s*>"),
    ("script", "html", True, r"<script\b[^>]*>.*?</script\s*>"),
    ("source", "wiki", True, r"<(syntaxhighlight|source|nowiki)\b[^>]*>.*?</\1\s*>"),
    ("verbatim", "latex", True, r"\\begin\{((?:verbatim|lstlisting|minted|alltt)\*?)\}.*?\\end\{\1\}"),
    ("math", "latex", True, r"\\begin\{((?:equation|align|gather|multline|eqnarray|displaymath|math|flalign)\*?)\}.*?\\end\{\1\}"),
    ("display", "latex", True, r"\$\$[^$]+?\$\$|\\\[.+?\\\]"),
    ("formula", "latex", True, r"\$[^\s$](?:[^$\n]{0,200}?[^\s$])?\$|\\\([^\n]+?\\\)"),
    ("ticks", "markdown", True, r"(?<!`)(`{1,2})(?!`)[^`\n]+?\1(?!`)"),
    ("path", "", True, r"(?<!\w)[A-Za-z]:\\[^\s{}<>|*?\"]+|(?<!\S)\\\\[\w.$-]+(?:\\[\w.$-]+)+"),
    ("comment", "html", True, r"<!--.*?-->"),
    ("tag", "html", False, r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>\n]*)?/?>|<!doctype[^>]*>"),
    ("entity", "html", False, r"&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"),
    ("wikitag", "wiki", False, r"</?(?:ref|references|nowiki|gallery|noinclude|includeonly|onlyinclude)\b[^<>]*/?>"),
    ("environment", "latex", False, r"\\(?:begin|end)\{[A-Za-z]+\*?\}"),
    ("command", "latex", False, r"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{[^{}\n]*(?:\{[^{}\n]*\}[^{}\n]*)*\}"),
    ("bare", "latex", False, r"\\[A-Za-z]+(?![A-Za-z{\\])"),
    ("wikilink", "wiki", False, r"\[\[[^\[\]\n]+\]\]"),
    ("template", "wiki", False, r"\{\{[^{}]*\}\}|__[A-Z]{3,}__"),
    ("outlink", "wiki", False, r"\[(?:https?|ftp)://[^\s\]]+\s+[^\]\n]+\](?!\()"),
    ("quotes", "wiki", False, r"(?<!')'{2,5}(?=[^\s'])[^\n]{1,300}?(?<=[^\s'])'{2,5}(?!')"),
    ("wikititle", "wiki", False, r"^[ \t]*(={2,6})[ \t]*[^=\s][^\n]*?\1[ \t]*$"),
    ("wikitable", "wiki", False, r"^[ \t]*\{\|[^\n]*$|^[ \t]*\|\}[ \t]*$|^[ \t]*\|-[^\n]*$"),
    ("title", "markdown", False, r"^ {0,3}#{1,6}[ \t]+\S[^\n]*$"),
    ("under", "markdown", False, r"^[^\n]*\S[^\n]*\n {0,3}(?:={3,}|-{3,})[ \t]*$"),
    ("rule", "markdown", False, r"^ {0,3}(?:---|\*\*\*|\* \* \*|- - -)[ \t]*$"),
    ("parted", "markdown", False, r"^[^\n]*\|[^\n]*\n[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)*\|?[ \t]*$"),
    ("quote", "markdown", False, r"^ {0,3}>+[ \t]*\S[^\n]*$"),
    ("task", "markdown", False, r"^[ \t]*[-*+] \[[ xXхХ]\][ \t]+\S[^\n]*$"),
    ("note", "markdown", False, r"\[\^[^\]\s]+\]:?"),
    ("image", "markdown", False, r"!\[[^\]\n]*\]\([^()\s]+(?:\s+\"[^\"]*\")?\)"),
    ("link", "markdown", False, r"(?<!!)\[[^\]\n]+\]\([^()\s]+(?:\s+\"[^\"]*\")?\)"),
    ("auto", "markdown", False, r"<(?:https?|ftp|mailto):[^\s<>]+>"),
    ("strong", "markdown", False, r"\*\*(?=[^\s*])[^\n]{1,300}?(?<=\S)\*\*|__(?=[^\s_])[^\n]{1,300}?(?<=[^\s_])__|~~(?=[^\s~])[^\n]{1,300}?(?<=[^\s~])~~"),
    ("stress", "markdown", False, r"(?<!\*)\*(?=[^\s*])[^*\n]{1,300}?(?<=[^\s*])\*(?!\*)|(?<!_)_(?=[^\s_])[^_\n]{1,300}?(?<=[^\s_])_(?!_)"),
)
NAMES = tuple(s[0] for s in SHAPES)
HOLDS = frozenset(s[0] for s in SHAPES if s[2])
_FIND = tuple(re.compile(p, re.M | re.S | re.I if name != "template" else re.M | re.S) for name, _, _, p in SHAPES)
_FIRST = re.compile(r"[\\<>\[\]{}$&*_`~#|=']|---|''")


@dataclass
class Node:
    """One possible piece of markup."""

    start: int
    end: int
    shape: int
    depth: int = 0
    parent: int = -1
    children: list[int] = field(default_factory=list)

    @property
    def name(self) -> str:
        return NAMES[self.shape]

    @property
    def kind(self) -> str:
        return SHAPES[self.shape][1]


def tree(text: str) -> list[Node]:
    """The nodes of a text, parents before children; of nodes that cross, the later one hangs on what is around its start."""
    if not _FIRST.search(text):
        return []
    found = [Node(m.start(), m.end(), k) for k, p in enumerate(_FIND) for m in p.finditer(text) if m.end() > m.start()]
    found.sort(key=lambda n: (n.start, -n.end, n.shape))
    stack: list[int] = []
    for at, n in enumerate(found):
        while stack and found[stack[-1]].end <= n.start:
            stack.pop()
        if stack:
            n.parent, n.depth = stack[-1], found[stack[-1]].depth + 1
            found[stack[-1]].children.append(at)
        stack.append(at)
    return found


_ATTRIBUTE = re.compile(r"[\w:-]+\s*=")
_HTML = frozenset("a abbr b blockquote body br button caption center code col dd del div dl dt em figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd li link main mark meta nav ol option p q s samp section small span strike strong style sub sup svg table tbody td tfoot th thead title tr u ul var".split())
_TEX = frozenset("section subsection subsubsection paragraph chapter textbf textit emph texttt underline href url footnote cite ref label item begin end frac sum cdot sqrt caption includegraphics hline maketitle tableofcontents centering par newpage".split())


def features(text: str, nodes: list[Node]) -> np.ndarray:
    """One row per node: its shape, tokens, attributes, density, depth, siblings and surroundings."""
    shapes = Counter(n.shape for n in nodes)
    kinds = Counter(n.kind for n in nodes)
    rows = np.zeros((len(nodes), len(NAMES) + 32), dtype=np.float32)
    lower = text.lower()
    for at, n in enumerate(nodes):
        body = text[n.start : n.end]
        size = len(body)
        before, after = text[n.start - 1] if n.start else "\n", text[n.end] if n.end < len(text) else "\n"
        letters = sum(c.isalpha() for c in body)
        inner = sum(nodes[c].end - nodes[c].start for c in n.children)
        word = re.search(r"[A-Za-z]+\d?", body)
        token = word.group().lower() if word else ""
        line = text[text.rfind("\n", 0, n.start) + 1 : (text.find("\n", n.end) + 1 or len(text) + 1) - 1]
        siblings = nodes[n.parent].children if n.parent >= 0 else ()
        holder, up = -1, n.parent
        while up >= 0 and holder < 0:
            holder = nodes[up].shape if NAMES[nodes[up].shape] in HOLDS and nodes[up].start < n.start else -1
            up = nodes[up].parent
        rows[at, n.shape] = 1
        rows[at, len(NAMES) :] = (
            n.depth, len(n.children), len(siblings), shapes[n.shape], kinds[n.kind], holder + 1, size, letters / size, inner / size, sum(c.isdigit() for c in body) / size, body.count(" "), body.count("\n"),
            len(_ATTRIBUTE.findall(body)), token in _HTML, token in _TEX, body.startswith("</"), body.count("\\"), body.count("{"), body.count("^") + body.count("_"), body.count("|"), body.count("="), before.isalnum(), before.isspace(), after.isalnum(), after.isspace(),
            n.start == 0 or before == "\n", after == "\n", len(line), size / max(len(line), 1), any("а" <= c.lower() <= "я" for c in body), lower.count(f"</{token}") if token in _HTML else 0, before in "([«\"",
        )
    return rows


def decoded(nodes: list[Node], odds: np.ndarray) -> set[int]:
    """The nodes that are markup: the likeliest choice in which no node lies inside an accepted one that holds its text as it is.

    Children are settled before parents.  Accepting a holding node rules its
    descendants out, which costs what they would have gained.
    """
    yes, no = (-np.logaddexp(0, -odds)).tolist(), (-np.logaddexp(0, odds)).tolist()
    best: list[float] = [0.0] * len(nodes)
    without: list[float] = [0.0] * len(nodes)
    take = [False] * len(nodes)
    for at in range(len(nodes) - 1, -1, -1):
        n = nodes[at]
        free = sum(best[c] for c in n.children)
        none = sum(without[c] for c in n.children)
        without[at] = no[at] + none
        accepted = yes[at] + (none if n.name in HOLDS else free)
        take[at] = accepted > no[at] + free
        best[at] = max(accepted, no[at] + free)
    out: set[int] = set()
    barred: set[int] = set()
    for at, n in enumerate(nodes):
        if n.parent in barred:
            barred.add(at)
            continue
        if take[at]:
            out.add(at)
            if n.name in HOLDS:
                barred.add(at)
    return out
