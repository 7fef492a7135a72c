"""Document graphs: nodes, edges, degrees, versions, pruning, neighbourhoods.

Documents have code, type, process and version; a node table has id, label,
node_type, group and process, an edge table source, target and edge_type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T

# Group letters, their node names and the graph's root.
GROUPS = {"М": "M", "Б": "B", "В": "V"}
ROOT = ("root_smk", "СМК")
# Type names in ids.
TYPES = {"ДП": "DP", "РД": "RD", "СТ": "ST", "КД": "KD", "РГ": "RG", "РК": "RK", "ИОТ": "IOT", "TPM": "TPM"}


def _name(c: Column, names: dict[str, str], other: str) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), c), F.lit(other))


def node_id(code: Column) -> Column:
    """The node id of a document code."""
    return F.concat(F.lit("doc_"), F.translate(code, ".-", "__"))


def described(docs: DataFrame) -> DataFrame:
    """Documents with node id, process id, group and type name; the first of equal codes stays."""
    first = docs.groupBy("code").agg(F.min_by(F.struct("type", "process", "version"), "ordinal").alias("d"), F.min("ordinal").alias("ordinal"))
    d = first.select("code", "ordinal", "d.*").withColumn("process_id", F.when(F.coalesce("process", F.lit("")) != "", T.process_code(F.split_part("process", F.lit("."), F.lit(1)))))
    return d.withColumns({"id": node_id(F.col("code")), "group": F.when(F.col("process_id").isNull(), "UNKNOWN").otherwise(_name(F.substring("process_id", 1, 1), GROUPS, "UNKNOWN")), "type_name": _name(F.col("type"), TYPES, "UNKNOWN")})


def nodes(docs: DataFrame) -> DataFrame:
    """Root, groups, processes, document types and documents, each id once."""
    known = docs.where("process_id is not null")
    none = F.lit(None).cast("string")
    row = lambda i, label, kind, group, process: [i.alias("id"), label.alias("label"), F.lit(kind).alias("node_type"), group.alias("group"), process.alias("process")]
    root = docs.limit(1).select(*row(F.lit(ROOT[0]), F.lit(ROOT[1]), "root", none, none))
    groups = known.select("group").distinct().select(*row(F.concat(F.lit("group_"), "group"), F.col("group"), "process_group", F.col("group"), none))
    processes = known.select("process_id", "group").distinct().select(*row(F.concat(F.lit("process_"), "process_id"), F.col("process_id"), "process", F.col("group"), F.col("process_id")))
    types = docs.select(F.coalesce("process_id", F.lit("UNKNOWN")).alias("p"), "type_name", "group").distinct().select(*row(F.concat_ws("_", F.lit("type"), "p", "type_name"), F.col("type_name"), "doc_type", F.col("group"), F.col("p")))
    documents = docs.select(*row(F.col("id"), F.col("code"), "document", F.col("group"), F.col("process_id")))
    return root.unionByName(groups).unionByName(processes).unionByName(types).unionByName(documents)


def edges(docs: DataFrame, refs: DataFrame) -> DataFrame:
    """Hierarchy, contains and references edges; ends that are no node are kept here.

    ``refs`` has code and ref; a reference resolves by the code in one alphabet,
    references to oneself and unknown ones are dropped.
    """
    known = docs.where("process_id is not null")
    edge = lambda s, t, kind: [s.alias("source"), t.alias("target"), F.lit(kind).alias("edge_type")]
    group, process = F.concat(F.lit("group_"), "group"), F.concat(F.lit("process_"), "process_id")
    kind = F.concat_ws("_", F.lit("type"), F.coalesce("process_id", F.lit("UNKNOWN")), "type_name")
    parts = [
        known.select("group").distinct().select(*edge(F.lit(ROOT[0]), group, "hierarchy")),
        known.where("group != 'UNKNOWN'").select("group", "process_id").distinct().select(*edge(group, process, "hierarchy")),
        docs.select("group", "process_id", "type_name").distinct().select(*edge(F.coalesce(process, F.lit("group_UNKNOWN")), kind, "hierarchy")),
        docs.select(*edge(kind, F.col("id"), "contains")),
        resolved(docs, refs).select(*edge(F.col("source"), F.col("target"), "references")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def resolved(docs: DataFrame, refs: DataFrame) -> DataFrame:
    """source, target: references whose both codes name a document, compared in one alphabet."""
    index = docs.select(T.code_key(F.col("code")).alias("key"), "id")
    pairs = refs.select(T.code_key(F.col("code")).alias("a"), T.code_key(F.col("ref")).alias("b")).distinct()
    out = pairs.join(index.select(F.col("key").alias("a"), F.col("id").alias("source")), "a").join(index.select(F.col("key").alias("b"), F.col("id").alias("target")), "b")
    return out.where("source != target").select("source", "target").distinct()


def without_orphan_edges(edge: DataFrame, node: DataFrame) -> DataFrame:
    """Edges whose both ends are nodes."""
    ids = node.select("id")
    return edge.join(ids, edge["source"] == ids["id"], "left_semi").join(ids, edge["target"] == ids["id"], "left_semi")


def degrees(edge: DataFrame) -> DataFrame:
    """id, degree: how many edge ends each node has."""
    ends = edge.select(F.explode(F.array("source", "target")).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def latest_versions(docs: DataFrame) -> DataFrame:
    """base, code, version: the highest numeric version of each base code; the first of equal ones stays."""
    d = docs.withColumns({"base": F.regexp_replace("code", r"-\d+$", ""), "number": F.col("version").try_cast("int")}).where("number is not null")
    best = d.groupBy("base").agg(F.max_by(F.struct("code", "version"), F.struct("number", -F.col("ordinal"))).alias("b"))
    return best.select("base", "b.code", "b.version")


def without_orphans(node: DataFrame, edge: DataFrame, latest: DataFrame) -> DataFrame:
    """Nodes without documents of degree 0 that are not the latest version."""
    keep = latest.select(node_id(F.col("code")).alias("id")).union(degrees(edge).select("id")).distinct()
    return node.where("node_type != 'document'").unionByName(node.where("node_type = 'document'").join(keep, "id", "left_semi"))


def neighbourhood(node: DataFrame, edge: DataFrame, start: Column) -> DataFrame:
    """start, id, direction, edge_type: nodes one edge away from every node that ``start`` selects."""
    s = node.where(start).select(F.col("id").alias("start"))
    out = edge.join(s, edge["source"] == s["start"]).select("start", F.col("target").alias("id"), F.lit("out").alias("direction"), "edge_type")
    into = edge.join(s, edge["target"] == s["start"]).select("start", F.col("source").alias("id"), F.lit("in").alias("direction"), "edge_type")
    return out.unionByName(into)


def search(node: DataFrame, text: str) -> DataFrame:
    """Nodes whose label or process contains a text, ignoring case; document types are left out."""
    t = text.lower()
    return node.where((F.col("node_type") != "doc_type") & (F.lower("label").contains(t) | F.coalesce(F.lower("process").contains(t), F.lit(False))))


def of_group(node: DataFrame, group: str) -> DataFrame:
    """The root, one group and its processes and documents."""
    return node.where((F.col("node_type") == "root") | ((F.col("node_type") != "doc_type") & (F.col("group") == group)))


def layout(node: DataFrame, per_row: int = 10) -> DataFrame:
    """Grid cell of every node: a band per type, siblings by group and label; counted per process, then added up."""
    from pyspark.sql import Window

    band = F.element_at(F.create_map(*[F.lit(x) for k, v in (("root", 0), ("process_group", 1), ("process", 2), ("doc_type", 3), ("document", 4)) for x in (k, v)]), F.col("node_type"))
    p = F.coalesce("process", F.lit(""))
    n = node.withColumns({"band": band, "p": p, "k": F.row_number().over(Window.partitionBy("node_type", p).orderBy("label", "id"))})
    base = n.groupBy("node_type", "p").agg(F.count(F.lit(1)).alias("c")).withColumn("base", F.coalesce(F.sum("c").over(Window.partitionBy("node_type").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    at = (F.col("k") + F.col("base") - 1).cast("bigint")
    return n.join(base.drop("c"), ["node_type", "p"]).select("id", "band", F.floor(at / per_row).alias("row"), F.pmod(at, F.lit(per_row)).alias("col"))
