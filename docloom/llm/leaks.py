"""Passages of held-out items inside a corpus.

A generalised suffix automaton of the normalised items is built once and sent
to the executors.  Every document streams through it, which gives the longest
match that ends at each token; where it is three tokens or longer, the state's
shortest suffix of three names all items and places that hold it.  Items whose
places could add up to the required share are aligned with the document
exactly: matching runs on one diagonal are joined over a few exchanged words,
runs of the required length or over a whole sentence of the item count, and an
item leaked when they cover its share.  Places and runs of many documents are
sorted and joined together, as arrays.  The spans that count are given with
their places, and can be removed from the text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docloom.functions.arrow import chunked
from docloom.llm.sentences import units

# Pairs of signs that scans confuse or that are written for each other.
CONFUSABLE = "ёе еe ес сc оo о0 аa рp уy хx кk тm мm нh пn иu ий иц з3 ч4 б6 бb вb ьb ъb l1 i1 і1 |1 шщ шw qg дл ґг үy ұy"


def _classes(pairs: str) -> dict[int, str]:
    """Sign -> the least sign that chains of pairs lead to."""
    up: dict[str, str] = {}

    def top(x: str) -> str:
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs.split():
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {ord(x): top(x) for x in list(up)}


_ALIKE = _classes(CONFUSABLE)
_TOKENS = re.compile(r"[一-鿿]|[^\W_一-鿿]+")
_HAN = re.compile("[一-鿿]")


def _lower(text: str) -> str:
    """Lower case of the same length, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def tokens(text: str) -> list[str]:
    """Words in lower case, Han signs one by one."""
    return _TOKENS.findall(_lower(text))


class _Keys(dict):
    """Token -> number of its look-alike class among the items' tokens, 0 for words that no item has; remembers what it met."""

    def __init__(self, classes: dict[str, int], most: int = 200_000) -> None:
        super().__init__()
        self.classes, self.most = classes, most

    def __missing__(self, token: str) -> int:
        if len(self) > self.most:
            self.clear()
        got = self[token] = self.classes.get(token.translate(_ALIKE), 0)
        return got


class Index:
    """Generalised suffix automaton over token numbers of the items, and the places of its runs of three."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.classes: dict[str, int] = {}
        self.ids = [i for i, _ in items]
        self.words: list[list[int]] = []
        self.sentences: list[list[tuple[int, int]]] = []
        self.han: list[bool] = []
        self.figures: set[int] = set()
        for _, text in items:
            found = tokens(text)
            seq = [self.classes.setdefault(t.translate(_ALIKE), len(self.classes) + 1) for t in found]
            self.words.append(seq)
            self.figures.update(k for k, t in zip(seq, found) if any(c.isdigit() for c in t))
            self.han.append(len(_HAN.findall(text)) * 2 > len(seq))
            spans, at = [], 0
            for a, b in units(text):
                n = len(tokens(text[a:b]))
                spans.append((at, at + n))
                at += n
            self.sentences.append(spans)
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        ends: list[list[int]] = []
        for seq in self.words:
            last = 0
            ends.append([last := self._extend(last, c) for c in seq])
        # the state of the last three tokens of every state: up the suffix links while they still hold three
        self.three = [-1] * len(self.length)
        for s in sorted(range(1, len(self.length)), key=lambda s: self.length[s]):
            if self.length[s] >= 3:
                self.three[s] = s if self.length[self.link[s]] < 3 else self.three[self.link[s]]
        places: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for n, seq in enumerate(self.words):
            state = 0
            for at, c in enumerate(seq):
                state = self.next[state][c]
                if at >= 2:
                    places[self.three[state]].append((n, at - 2, at - 2))
        # two and two tokens around an exchanged one, for sentences too short to hold three in a row
        split: dict[tuple, list[tuple[int, int, int]]] = defaultdict(list)
        for n, seq in enumerate(self.words):
            for a in sorted({a for x, y in self.sentences[n] if 0 < y - x <= 5 for a in range(max(0, y - 5), min(x, len(seq) - 5) + 1)}):
                split[seq[a], seq[a + 1], seq[a + 3], seq[a + 4]].extend(((n, a, a), (n, a + 1, a)))
        # the places row by row: item number, place, what the document's place exceeds the diagonal by
        rows = {s: k for k, s in enumerate(places)}
        self.row = [rows.get(s, -1) for s in self.three]
        self.split = {four: len(rows) + k for k, four in enumerate(split)}
        lists = [*places.values(), *split.values()]
        self.count = np.array([len(x) for x in lists], np.int64)
        self.begin = np.cumsum(self.count) - self.count
        self.place = np.array([p for x in lists for p in x], np.int64).reshape(-1, 3).T.copy()
        self.counts = self.count.tolist()
        # all items in one array: tokens, figures so far, the end of the first whole sentence from each token on, tokens in whole sentences of three tokens, of these and three before, of these and three after
        self.size = np.array([len(x) for x in self.words], np.int64)
        self.offset = np.cumsum(self.size) - self.size
        self.flat = np.array([k for seq in self.words for k in seq], np.int64)
        self.figured = np.isin(self.flat, np.array(sorted(self.figures), np.int64))
        self.figures_to = np.concatenate([[0], np.cumsum(self.figured)])
        whole, short = [], []
        for seq, spans in zip(self.words, self.sentences):
            ends = [len(seq) + 1] * len(seq)
            for x, y in reversed(spans):
                if y > x:
                    ends[: x + 1] = [y] * (x + 1)
            whole.extend(ends)
            sums = np.zeros((3, len(seq) + 6), np.int64)
            for x, y in spans:
                for k, (before, after) in enumerate(((0, 3), (3, 3), (0, 6))):
                    if 0 < y - x <= before + after:
                        sums[k, max(0, y - after) : x + before + 1] += y - x
            short.append(sums[:, : len(seq)])
        self.whole, self.short = np.array(whole, np.int64), np.concatenate([np.zeros((3, 0), np.int64), *short], axis=1)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, q, c)
        cur = len(length)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return cur

    def _clone(self, p: int, q: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(length)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def _seeds(self, seq: list[int]) -> tuple[list[int], list[int]]:
        """Rows of places and the places of the document where they stand, by the longest match at every token."""
        nxt, link, length, row = self.next, self.link, self.length, self.row
        rows: list[int] = []
        at_doc: list[int] = []
        state = size = 0
        for at, c in enumerate(seq):
            if not c:
                state = size = 0
                continue
            while state and c not in nxt[state]:
                state = link[state]
                size = length[state]
            to = nxt[state].get(c)
            if to is None:
                state = size = 0
                continue
            state = to
            size += 1
            if size >= 3:
                rows.append(row[state])
                at_doc.append(at - 2)
        if self.split:
            get = self.split.get
            for j, four in enumerate(zip(seq, seq[1:], seq[3:], seq[4:])):
                if (r := get(four)) is not None:
                    rows.append(r)
                    at_doc.append(j)
        return rows, at_doc

    def leaked(self, seq: list[int], share: float, words: int, signs: int) -> list[tuple[int, float, list[tuple[int, int]]]]:
        """(item number, covered share, token spans) of the items that leaked into one token stream."""
        return next(self.all_leaked([seq], share, words, signs))

    def all_leaked(self, seqs: list[list[int]], share: float, words: int, signs: int, most: int = 500_000) -> Iterator[list[tuple[int, float, list[tuple[int, int]]]]]:
        """``leaked`` of every stream; streams are taken together until they have ``most`` places."""
        at = 0
        while at < len(seqs):
            found, room, first = [], most, at
            while at < len(seqs) and room > 0:
                found.append(self._seeds(seqs[at]))
                room -= sum(map(self.counts.__getitem__, found[-1][0]))
                at += 1
            yield from self._leaked(seqs[first:at], found, share, words, signs)

    def _leaked(self, seqs: list[list[int]], found: list[tuple[list[int], list[int]]], share: float, words: int, signs: int) -> list[list[tuple[int, float, list[tuple[int, int]]]]]:
        out: list[list] = [[] for _ in seqs]
        long = int(self.size.max(initial=0))
        sizes = np.array([len(x) for x in seqs], np.int64)
        # documents lie so far apart that no diagonal reaches two of them
        base = np.cumsum(sizes + long) - sizes
        rows = np.array([r for x, _ in found for r in x], np.int64)
        if not len(rows):
            return out
        where = np.array([j for _, x in found for j in x], np.int64) + np.repeat(base, [len(x) for x, _ in found])
        times = self.count[rows]
        entry = np.arange(int(times.sum())) + np.repeat(self.begin[rows] - (np.cumsum(times) - times), times)
        n, at, less = self.place[0, entry], self.place[1, entry], self.place[2, entry]
        d = np.repeat(where, times) - less
        a_bits, d_bits = max(long, 1).bit_length(), int(base[-1] + sizes[-1]).bit_length()
        if a_bits + d_bits + len(self.words).bit_length() < 63:
            key = (n << d_bits | d) << a_bits | at
            key.sort()
            key = key[np.concatenate([[True], key[1:] != key[:-1]])]
            n, d, at = key >> (a_bits + d_bits), key >> a_bits & (1 << d_bits) - 1, key & (1 << a_bits) - 1
        else:
            order = np.lexsort((at, d, n))
            n, d, at = n[order], d[order], at[order]
            new = np.concatenate([[True], (n[1:] != n[:-1]) | (d[1:] != d[:-1]) | (at[1:] != at[:-1])])
            n, d, at = n[new], d[new], at[new]
        seq = np.array([c for x in seqs for c in x], np.int64)
        starts = np.cumsum(sizes) - sizes
        doc = np.searchsorted(base - long, d, "right") - 1
        here = starts[doc] - base[doc] + d  # what a place of the stream exceeds that of the item by
        able, first, last = self._reachable(n, d, at, here, seq)
        # pairs of item and document, then the groups of those that can reach the share
        n, doc, here, at, end = n[first], doc[first], here[first], at[first], at[last] + 3
        stretch = np.where(self.han, signs, words)
        begin, stop = starts[doc] - here, starts[doc] + sizes[doc] - here

        def enough(tokens: np.ndarray) -> np.ndarray:
            pair = np.flatnonzero(np.concatenate([[True], (n[1:] != n[:-1]) | (doc[1:] != doc[:-1])]))
            return np.repeat(np.add.reduceat(tokens, pair) >= share * self.size[n[pair]], np.diff(np.append(pair, len(n))))

        keep = enough(able) & (able > 0)
        n, doc, here, at, end, begin, stop = (x[keep] for x in (n, doc, here, at, end, begin, stop))
        if not len(n):
            return out
        # a stretch that counts goes at most eight tokens beyond its group, so all of them are among those found this near
        near = np.zeros(len(n))
        for k, a, b, _ in self._spans(n, here, np.maximum(np.maximum(0, begin), at - 14), np.minimum(np.minimum(self.size[n], stop), end + 14), seq, stretch):
            np.add.at(near, k, b - a)
        keep = enough(near) & np.concatenate([[True], (n[1:] != n[:-1]) | (here[1:] != here[:-1]) | (doc[1:] != doc[:-1])])
        n, doc, here, begin, stop = (x[keep] for x in (n, doc, here, begin, stop))
        marks: dict[tuple[int, int], tuple[bytearray, list[tuple[int, int]]]] = {}
        for line, *ends, full in self._spans(n, here, np.maximum(0, begin), np.minimum(self.size[n], stop), seq, stretch):
            for k, a, b, counts in zip(line.tolist(), ends[0].tolist(), ends[1].tolist(), full.tolist()):
                item, document, by = int(n[k]), int(doc[k]), int(-begin[k])
                mark, places = marks.setdefault((document, item), (bytearray(len(self.words[item])), []))
                for x, y in [(a, b)] if counts else [(x, y) for x, y in self.sentences[item] if y > x and a <= x and b >= y]:
                    mark[x:y] = b"\1" * (y - x)
                    places.append((x + by, y + by))
        for (document, item), (mark, places) in marks.items():
            if (got := sum(mark) / len(mark)) >= share:
                out[document].append((item, got, places))
        return out

    def _reachable(self, n: np.ndarray, d: np.ndarray, at: np.ndarray, here: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """At most how many tokens of the item each group of places can cover; its first and last place.

        A stretch of L tokens that counts has at most L / 9 + 1 exchanged ones,
        none of them a figure.  With r of its runs three tokens or longer, C
        tokens in them and the other runs two long, L <= 1.5 * (C + 5 - 2 r).
        Its runs of three lie at most six tokens apart, and there are two places
        of three at least; a single place can only count for sentences in its
        three tokens, or in these and two more beside an exchanged one.
        """
        step = np.diff(at, prepend=0)
        on = np.concatenate([[False], (n[1:] == n[:-1]) & (d[1:] == d[:-1])]) & (step <= 9)
        wide = np.flatnonzero(on & (step > 3))
        for back in range(1, 7):
            some = wide[step[wide] - back >= 3]
            k = at[some] - back
            flat = self.offset[n[some]] + k
            # outside of the document nothing is equal
            on[some[self.figured[flat] & (self.flat[flat] != seq[np.clip(k + here[some], 0, len(seq) - 1)])]] = False
        first = np.flatnonzero(~on)
        last = np.append(first[1:], len(at)) - 1
        tokens = 3 + np.add.reduceat(np.where(on, np.minimum(3, step), 0), first)
        able = np.minimum(at[last] + 11 - at[first], 1.5 * (tokens + 3))
        single = np.flatnonzero(last == first)
        flat, j = self.offset[n[first[single]]] + at[first[single]], at[first[single]] + here[first[single]]
        able[single] = self.short[0, flat]
        for side, by in ((1, (-3, -2)), (2, (4, 5))):
            some = np.flatnonzero(self.short[side, flat] > self.short[0, flat])
            both = np.logical_and.reduce([self.flat[np.clip(flat[some] + x, 0, len(self.flat) - 1)] == seq[np.clip(j[some] + x, 0, len(seq) - 1)] for x in by])
            able[single[some[both]]] = np.maximum(able[single[some[both]]], self.short[side, flat[some[both]]])
        return able, first, last

    def _spans(self, n: np.ndarray, here: np.ndarray, low: np.ndarray, high: np.ndarray, seq: np.ndarray, stretch: np.ndarray, gap: int = 2, most: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(diagonal, start, end, whether it counts of itself, else for its whole sentences) of the stretches on parts of diagonals, in places of the item.

        Inside a stretch one word in nine may differ, but no figure or code:
        texts made from the same forms agree in all but these.
        """
        sizes = high - low + 1  # one more than the tokens, so that no run reaches the next diagonal
        part = np.cumsum(sizes) // most
        cut = np.flatnonzero(np.diff(part)) + 1
        for first_line, last_line in zip([0, *cut], [*cut, len(n)]):
            if first_line < last_line:
                at = slice(int(first_line), int(last_line))
                line, a, b, full = self._stretches(n[at], here[at], low[at], sizes[at], seq, stretch, gap)
                yield line + at.start, a, b, full

    def _stretches(self, n: np.ndarray, here: np.ndarray, low: np.ndarray, sizes: np.ndarray, seq: np.ndarray, stretch: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        stops = np.cumsum(sizes)
        back = low - (stops - sizes)  # what a token's number in the item exceeds its place here by
        k = np.arange(int(stops[-1]))
        i = k + np.repeat(back + self.offset[n], sizes)
        j = k + np.repeat(back + here, sizes)
        i[stops - 1] = j[stops - 1] = 0
        same = self.flat[i] == seq[j]
        same[stops - 1] = False
        edge = np.flatnonzero(same[1:] != same[:-1]) + 1
        if len(same) and same[0]:
            edge = np.append(0, edge)
        begin, end = edge[::2], edge[1::2]
        run = end - begin >= 2
        begin, end = begin[run], end[run]
        if not len(begin):
            none = np.zeros(0, np.int64)
            return none, none, none, none.astype(bool)
        line = np.searchsorted(stops, begin, "right")
        on = (line[1:] == line[:-1]) & (begin[1:] - end[:-1] <= gap)
        on[on] = self.figures_to[i[begin[1:][on]]] == self.figures_to[i[end[:-1][on] - 1] + 1]
        first = np.flatnonzero(np.concatenate([[True], ~on]))
        last = np.append(first[1:], len(begin)) - 1
        hit = np.add.reduceat(end - begin, first)
        a, b, line = begin[first], end[last], line[first]
        length = b - a
        full = (length >= stretch[n[line]]) & (length - hit <= length // 9 + 1)
        counts = full | (hit >= 3) & (length - hit <= 1)
        a, b, line, full = a[counts], b[counts], line[counts], full[counts]
        a_item, b_item = a + back[line], b + back[line]
        counts = full | (self.whole[i[a]] <= b_item)
        return line[counts], a_item[counts], b_item[counts], full[counts]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def leaks(docs: DataFrame, items: DataFrame, share: float = 0.4, words: int = 10, signs: int = 20, block_chars: int = 8_000_000) -> DataFrame:
    """doc_id, item_id, share, spans: the items of which at least ``share`` recurs in a document, and where.

    ``items`` is held-out material of fixed size: it is read on the driver in
    blocks of at most ``block_chars`` characters, and one index per block is
    broadcast; the corpus streams once per block and is never shuffled.  Null
    and empty texts have no tokens and leak nothing; an empty item leaks
    nowhere; repeated documents give repeated rows, repeated items one row
    each.  Spans are code-point offsets, merged and in order.
    """
    spark: SparkSession = docs.sparkSession
    blocks: list[list[tuple[int, str]]] = [[]]
    room = block_chars
    for r in items.select("item_id", "text").where("item_id is not null").distinct().orderBy("item_id", "text").toLocalIterator():
        text = r[1] or ""
        if room < len(text) and blocks[-1]:
            blocks.append([])
            room = block_chars
        blocks[-1].append((r[0], text))
        room -= len(text)
    out = None
    for block in blocks:
        shared = spark.sparkContext.broadcast(Index(block))
        one = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]).where("text is not null").mapInArrow(_stream(shared, share, words, signs), "doc_id bigint, item_id bigint, share double, spans array<struct<start:int,end:int>>")
        out = one if out is None else out.union(one)
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("share", pa.float64()), ("spans", _SPANS)])


def _stream(shared, share: float, words: int, signs: int):
    def run(batches):
        index = shared.value
        keys = _Keys(index.classes)

        def one(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {n: [] for n in _SCHEMA.names}
            texts = batch.column(1).to_pylist()
            found = index.all_leaked([[keys[x] for x in tokens(t)] for t in texts], share, words, signs)
            for d, t, hits in zip(batch.column(0).to_pylist(), texts, found):
                at = [m.span() for m in _TOKENS.finditer(_lower(t))] if hits else []
                for n, got, spans in hits:
                    for name, value in zip(_SCHEMA.names, (d, index.ids[n], got, [{"start": at[a][0], "end": at[b - 1][1]} for a, b in _merged(spans)])):
                        out[name].append(value)
            return out

        return chunked(one, _SCHEMA)(batches)

    return run


def without_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, text of the documents with leaked spans, these removed; spans are gathered per document, at most one for each item."""
    from pyspark.sql import functions as F

    per = found.groupBy("doc_id").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def step(acc, x):
        keep = F.greatest(x["start"] - acc["at"], F.lit(0))
        return F.struct(F.concat(acc["text"], F.substring(F.col("text"), acc["at"] + 1, keep)).alias("text"), F.greatest(acc["at"], x["end"]).alias("at"))

    left = F.aggregate("spans", start, step)
    joined = docs.select("doc_id", "text").join(per, "doc_id").withColumn("left", left)
    return joined.select("doc_id", F.concat(F.col("left.text"), F.substring(F.col("text"), F.col("left.at") + 1, F.length("text"))).alias("text"))
