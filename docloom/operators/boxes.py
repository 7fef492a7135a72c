"""Boxes on pages: overlap, containment, nearest neighbours, clusters, token lines.

Box rows have doc_id, page, id and x0, y0, x1, y1.  Joins of boxes on one page
go through a grid of cells, so that a page with very many boxes is not compared
with itself.  Folds (clusters, lines) run per page.
"""

from __future__ import annotations


from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from docloom.functions.arrow import chunked


def area(b: str) -> Column:
    return F.greatest(F.col(f"{b}.x1") - F.col(f"{b}.x0"), F.lit(0.0)) * F.greatest(F.col(f"{b}.y1") - F.col(f"{b}.y0"), F.lit(0.0))


def overlap(a: str, b: str) -> Column:
    """Common area of two boxes, 0 when they are apart."""
    w = F.least(F.col(f"{a}.x1"), F.col(f"{b}.x1")) - F.greatest(F.col(f"{a}.x0"), F.col(f"{b}.x0"))
    h = F.least(F.col(f"{a}.y1"), F.col(f"{b}.y1")) - F.greatest(F.col(f"{a}.y0"), F.col(f"{b}.y0"))
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def overlap_share(a: str, b: str) -> Column:
    """Share of the second box inside the first, 0 for a second box without area."""
    return F.coalesce(overlap(a, b) / F.nullif(area(b), F.lit(0.0)), F.lit(0.0))


def gridded(rows: DataFrame, box: str, size: float = 200.0) -> DataFrame:
    """One row per grid cell that a box touches."""
    cells = lambda lo, hi: F.sequence(F.floor(F.col(f"{box}.{lo}") / size), F.floor(F.col(f"{box}.{hi}") / size))
    rows = rows.where(f"{box}.x0 <= {box}.x1 and {box}.y0 <= {box}.y1")
    return rows.withColumn("gx", F.explode(cells("x0", "x1"))).withColumn("gy", F.explode(cells("y0", "y1")))


def overlapping(left: DataFrame, right: DataFrame, size: float = 200.0) -> DataFrame:
    """doc_id, page, left_id, right_id, common, share: pairs of boxes of one page with common area.

    Every pair is found in each cell both touch and kept in the one that holds
    the upper left corner of the common part.  Boxes with null sides have no pairs.
    """
    l = gridded(left.select("doc_id", "page", F.col("id").alias("left_id"), F.col("bbox").alias("a")), "a", size)
    r = gridded(right.select("doc_id", "page", F.col("id").alias("right_id"), F.col("bbox").alias("b")), "b", size)
    j = l.join(r, ["doc_id", "page", "gx", "gy"]).where((F.col("left_id") != F.col("right_id")) & (overlap("a", "b") > 0))
    corner = (F.floor(F.greatest("a.x0", "b.x0") / size) == F.col("gx")) & (F.floor(F.greatest("a.y0", "b.y0") / size) == F.col("gy"))
    return j.where(corner).select("doc_id", "page", "left_id", "right_id", overlap("a", "b").alias("common"), overlap_share("a", "b").alias("share"))


def outside(rows: DataFrame, holes: DataFrame, size: float = 200.0) -> DataFrame:
    """Rows whose box lies fully inside no box of ``holes`` on the same page; boxes with null sides stay."""
    inside = overlapping(holes, rows, size).where("share >= 1.0 - 1e-9").select("doc_id", "page", F.col("right_id").alias("id")).distinct()
    return rows.join(inside, ["doc_id", "page", "id"], "left_anti")


def inner_texts(elements: DataFrame, tokens: DataFrame, least: float = 0.3) -> DataFrame:
    """doc_id, page, id, text: elements with the texts of the tokens of which more than ``least`` lies inside, in token order."""
    hit = overlapping(elements, tokens).where(F.col("share") > least)
    hit = hit.join(tokens.select("doc_id", "page", F.col("id").alias("right_id"), "seq", "text"), ["doc_id", "page", "right_id"])
    return hit.groupBy("doc_id", "page", F.col("left_id").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "right_id", "text"))), lambda x: x["text"]), " ").alias("text"))


def connections(nodes: DataFrame, flows: DataFrame) -> DataFrame:
    """doc_id, page, flow, source, target: the nearest node on each side of every flow, where both exist.

    The side is left and right for a flow wider than high, above and below
    otherwise; the first of equally near nodes counts.  Nodes of a page are
    reduced to the nearest per flow and side map-side.
    """
    n = nodes.select("doc_id", "page", F.col("id").alias("node"), "seq", ((F.col("bbox.x0") + F.col("bbox.x1")) / 2).alias("nx"), ((F.col("bbox.y0") + F.col("bbox.y1")) / 2).alias("ny"))
    f = flows.select("doc_id", "page", F.col("id").alias("flow"), ((F.col("bbox.x0") + F.col("bbox.x1")) / 2).alias("fx"), ((F.col("bbox.y0") + F.col("bbox.y1")) / 2).alias("fy"), ((F.col("bbox.x1") - F.col("bbox.x0")) > (F.col("bbox.y1") - F.col("bbox.y0"))).alias("flat"))
    j = f.join(n, ["doc_id", "page"]).where(F.col("flow") != F.col("node"))
    source = F.when(F.col("flat"), F.col("nx") < F.col("fx")).otherwise(F.col("ny") < F.col("fy"))
    rank = F.struct(F.sqrt(F.pow(F.col("fx") - F.col("nx"), 2) + F.pow(F.col("fy") - F.col("ny"), 2)).alias("d"), F.col("seq"), F.col("node"))
    best = j.groupBy("doc_id", "page", "flow").agg(F.min_by("node", F.when(source, rank)).alias("source"), F.min_by("node", F.when(~source, rank)).alias("target"))
    return best.where("source is not null and target is not null")


def _merge(a: list[float], b: list[float], share: float, near: float) -> bool:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w > 0 and h > 0:
        least = min((x[2] - x[0]) * (x[3] - x[1]) for x in (a, b))
        if least > 0 and w * h / least >= share:
            return True
    return (max(0.0, -w) ** 2 + max(0.0, -h) ** 2) ** 0.5 <= near


def cluster(boxes: list[list[float]], share: float = 0.1, near: float = 20.0) -> list[int]:
    """Cluster number of every box: clusters whose hulls overlap or lie near are merged until none is left to merge."""
    hulls = [list(b) for b in boxes]
    group = [[i] for i in range(len(boxes))]
    changed = True
    while changed:
        changed = False
        at = 0
        while at < len(hulls):
            other = at + 1
            while other < len(hulls):
                if _merge(hulls[at], hulls[other], share, near):
                    a, b = hulls[at], hulls.pop(other)
                    hulls[at] = [min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])]
                    group[at] += group.pop(other)
                    changed = True
                else:
                    other += 1
            at += 1
    out = [0] * len(boxes)
    for n, members in enumerate(group):
        for m in members:
            out[m] = n
    return out


def _per_page(rows: DataFrame, columns: list[str], fold: Callable[[list[dict]], list[dict]], out: str) -> DataFrame:
    """A fold over the rows of each page: one array per page, so many small pages share an Arrow batch."""
    schema = to_arrow_schema(_parse_datatype_string(out))

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        got = [{"doc_id": d, "page": p, **r} for d, p, x in zip(*[c.to_pylist() for c in batch.columns]) for r in fold(x)]
        return {n: [r[n] for r in got] for n in schema.names}

    return rows.groupBy("doc_id", "page").agg(F.collect_list(F.struct(*columns)).alias("x")).mapInArrow(chunked(run, schema), out)


def clusters(rows: DataFrame, share: float = 0.1, near: float = 20.0) -> DataFrame:
    """doc_id, page, cluster, n, x0, y0, x1, y1 of the drawings of every page; a fold, so one page is one group."""

    def fold(found: list[dict]) -> list[dict]:
        found = sorted(found, key=lambda r: (r["seq"] if r["seq"] is not None else -1, r["id"]))
        by: dict[int, list[dict]] = {}
        for r, c in zip(found, cluster([[r[k] for k in ("x0", "y0", "x1", "y1")] for r in found], share, near)):
            by.setdefault(c, []).append(r)
        return [{"cluster": c, "n": len(m), "x0": min(r["x0"] for r in m), "y0": min(r["y0"] for r in m), "x1": max(r["x1"] for r in m), "y1": max(r["y1"] for r in m)} for c, m in by.items()]

    flat = rows.where("bbox.x0 is not null and bbox.y0 is not null and bbox.x1 is not null and bbox.y1 is not null").select("doc_id", "page", "id", "seq", "bbox.x0", "bbox.y0", "bbox.x1", "bbox.y1")
    return _per_page(flat, ["id", "seq", "x0", "y0", "x1", "y1"], fold, "doc_id string, page int, cluster int, n int, x0 double, y0 double, x1 double, y1 double")


def token_lines(tokens: list[tuple], threshold: float = 18.0, gap: float | None = None) -> list[dict]:
    """Tokens (text, x0, y0, x1, y1) as lines: a token joins the line whose running middle is near, wide gaps cut it."""
    lines: list[list[tuple]] = []
    middle = 0.0
    for t in sorted(tokens, key=lambda t: (t[2], t[1])):
        y = (t[2] + t[4]) / 2
        if lines and abs(y - middle) <= threshold:
            lines[-1].append(t)
            middle = (middle + y) / 2
        else:
            lines.append([t])
            middle = y
    out = []
    for line in lines:
        part: list[tuple] = []
        for t in sorted(line, key=lambda t: t[1]):
            if part and gap is not None and t[1] - part[-1][3] > gap:
                out.append(part)
                part = []
            part.append(t)
        out.append(part)
    return [{"text": " ".join(t[0] for t in p if t[0]), "x0": min(t[1] for t in p), "y0": min(t[2] for t in p), "x1": max(t[3] for t in p), "y1": max(t[4] for t in p)} for p in out]


def stacked(lines: list[dict], gap: float = 12.0, share: float = 0.6, most: float = 120.0) -> list[dict]:
    """Lines as boxes: a line joins the box above when it is near, below it and the box stays low."""
    out: list[dict] = []
    for s in sorted(lines, key=lambda s: (s["y0"], s["x0"])):
        b = out[-1] if out else None
        if b is not None:
            common = max(0.0, min(b["x1"], s["x1"]) - max(b["x0"], s["x0"])) / max(1.0, min(b["x1"] - b["x0"], s["x1"] - s["x0"]))
            if s["y0"] - b["y1"] <= gap and common >= share and s["y1"] - b["y0"] <= most:
                b.update(text=f"{b['text']} {s['text']}".strip(), x0=min(b["x0"], s["x0"]), y0=min(b["y0"], s["y0"]), x1=max(b["x1"], s["x1"]), y1=max(b["y1"], s["y1"]))
                continue
        out.append(dict(s))
    return out


def page_token_boxes(tokens: DataFrame, boxes: bool = True) -> DataFrame:
    """doc_id, page, n, text, x0, y0, x1, y1: token lines of every page, or the boxes they stack to."""

    def fold(found: list[dict]) -> list[dict]:
        rows = token_lines(sorted(tuple(r[k] for k in ("text", "x0", "y0", "x1", "y1")) for r in found), 14.0 if boxes else 18.0, 28.0 if boxes else None)
        return [{"n": n, **r} for n, r in enumerate(stacked(rows) if boxes else rows)]

    whole = tokens.where("x0 is not null and y0 is not null and x1 is not null and y1 is not null").withColumn("text", F.coalesce("text", F.lit("")))
    return _per_page(whole, ["text", "x0", "y0", "x1", "y1"], fold, "doc_id string, page int, n int, text string, x0 double, y0 double, x1 double, y1 double")


def valid_box(text: Column) -> Column:
    """Texts of diagrams: three signs, mostly Cyrillic, little noise, no short single word but да and нет."""
    cyr, alpha = F.regexp_count(text, F.lit("[а-яА-ЯёЁ]")), F.regexp_count(text, F.lit("[a-zA-Zа-яА-ЯёЁ]"))
    noise = F.regexp_count(text, F.lit(r"[^а-яА-ЯёЁa-zA-Z0-9\s.,:;()\-]"))
    lone = ~text.contains(" ") & (F.length(text) < 5) & ~F.lower(text).isin("да", "нет")
    return (F.length(text) >= 3) & (alpha > 0) & (cyr >= alpha * 0.6) & (noise <= F.length(text) * 0.2) & ~lone


def lanes(boxes: DataFrame) -> DataFrame:
    """doc_id, page, lane, flow: texts from left to right, in an upper and a lower lane where the page is high and has six boxes."""
    ok = boxes.where(valid_box(F.col("text")))
    size = ok.groupBy("doc_id", "page").agg(F.min("y0").alias("__lo"), F.max("y1").alias("__hi"), F.count(F.lit(1)).alias("__n"))
    two = (F.greatest(F.col("__hi") - F.col("__lo"), F.lit(1.0)) > 180) & (F.col("__n") >= 6)
    half = F.col("__lo") + F.greatest(F.col("__hi") - F.col("__lo"), F.lit(1.0)) / 2
    out = ok.join(size, ["doc_id", "page"]).withColumn("lane", F.when(~two, "lane").when((F.col("y0") + F.col("y1")) / 2 <= half, "upper").otherwise("lower"))
    return out.groupBy("doc_id", "page", "lane").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "n", "text"))), lambda x: x["text"]), " -> ").alias("flow"))


def grounded(text: Column) -> Column:
    """array<struct<text, box>> of the <|ref|>..<|det|>.. tags in an OCR answer; only tags with four numbers."""
    tag = r"(?s)<\|ref\|>(.*?)<\|/ref\|><\|det\|>\[\[(.*?)\]\].*?<\|/det\|>"
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(tag), F.lit(1)).alias("text"), F.regexp_extract_all(text, F.lit(tag), F.lit(2)).alias("box"))
    rows = F.transform(found, lambda x: F.struct(F.trim(x["text"]).alias("text"), F.transform(F.split(x["box"], r",\s*"), lambda n: n.try_cast("double")).alias("box")))
    return F.filter(rows, lambda x: F.size(x["box"]) == 4)


def yolo(box: str, width: Column, height: Column, number: Column) -> Column:
    """A label line: class, centre and size as shares of the page with six decimals."""
    c = lambda a, b, n: (F.col(f"{box}.{a}") + F.col(f"{box}.{b}")) / 2 / n
    s = lambda a, b, n: (F.col(f"{box}.{b}") - F.col(f"{box}.{a}")) / n
    return F.format_string("%d %.6f %.6f %.6f %.6f", number, c("x0", "x1", width), c("y0", "y1", height), s("x0", "x1", width), s("y0", "y1", height))
