"""Deeply nested XML records as related flat tables.

Every element below the body that has attributes or child elements is an
object: it gets a Merkle identity, its canonical form (attributes by name,
fields in their order) hashed together with the identities of its children,
bottom-up.  Identical objects are stored once; a bridge row per occurrence
keeps statement, path, parent and ordinal.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrow import chunked

_PAIRS = pa.map_(pa.string(), pa.string())
_NODES = pa.schema(
    [
        ("statement_id", pa.int64()),
        ("kind", pa.string()),
        ("role", pa.string()),
        ("node_path", pa.string()),
        ("parent_path", pa.string()),
        ("holder_path", pa.string()),
        ("section", pa.string()),
        ("ordinal", pa.int32()),
        ("rec_id", pa.string()),
        ("object_id", pa.string()),
        ("attributes", _PAIRS),
        ("fields", _PAIRS),
        ("children", pa.list_(pa.string())),
    ]
)
NODES = "statement_id bigint, kind string, role string, node_path string, parent_path string, holder_path string, section string, ordinal int, rec_id string, object_id string, attributes map<string,string>, fields map<string,string>, children array<string>"


def decode(raw: bytes) -> str:
    """The text of an XML file in UTF-8, else in the Cyrillic Windows encoding; bytes neither knows are replaced."""
    for codec in ("utf-8-sig", "cp1251"):
        try:
            return raw.decode(codec)
        except UnicodeDecodeError:
            continue
    return raw.decode("cp1251", "replace")


def _local(tag: object) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""


def _digest(*parts: str) -> str:
    h = blake2b(digest_size=16)
    for p in parts:
        raw = p.encode("utf-8", "surrogatepass")
        h.update(len(raw).to_bytes(4, "big"))
        h.update(raw)
    return h.hexdigest()


def _pairs(elements: list) -> list[tuple[str, str]]:
    """Fields by name; a repeated name gets its number, as map keys are unique."""
    out: list[tuple[str, str]] = []
    seen: dict[str, int] = {}
    for e in elements:
        name = _local(e.tag)
        seen[name] = seen.get(name, 0) + 1
        out.append((name if seen[name] == 1 else f"{name}#{seen[name]}", "".join(e.itertext())))
    return out


def _attributes(e) -> list[tuple[str, str]]:
    return sorted({_local(k): v for k, v in e.attrib.items()}.items())


def _table(name: str) -> bool:
    return name.startswith("Table")


def _object(e, record: str) -> bool:
    """Whether an element is an object of its own and no mere field."""
    name = _local(e.tag)
    return bool(len(e) or e.attrib or _table(name) or name == record)


def parse(statement: int, xml: str, body: str = "TBODY", header: str = "THEADER", record: str = "Rec") -> list[tuple]:
    """Node rows of one statement; [] when the text is not well-formed.

    role is header, section, table, record or group (any other element with
    attributes or children of its own); parent_path names the nearest enclosing
    record or else the section, holder_path the element just above.
    """
    try:
        root = ElementTree.fromstring(re.sub(r"^[\s﻿]+", "", xml))
    except (ElementTree.ParseError, ValueError):
        return []
    rows: list[tuple] = []
    for h in root.iter():
        if _local(h.tag) == header:
            attrs, fields = _attributes(h), _pairs(list(h))
            rows.append((statement, header, "header", header, "", "", header, 1, "", _digest(header, repr(attrs), repr(fields)), attrs, fields, []))
            break
    top = next((e for e in root.iter() if _local(e.tag) == body), None)
    if top is None:
        return rows
    # iterative walk, children before parents on the way back
    work = []
    stack = [(e, p, None, -1, p, n) for e, p, n in _numbered(top, "", record)]
    while stack:
        e, path, parent, holder, section, n = stack.pop()
        name = _local(e.tag)
        work.append((e, path, parent if parent is not None else section, holder, section, n, name))
        below = path if name == record else parent
        stack.extend((c, p, below, len(work) - 1, section, k) for c, p, k in _numbered(e, path + "/", record) if _object(c, record))
    kids: dict[int, list[tuple[int, str]]] = {}
    for at, (e, path, parent, holder, section, n, name) in reversed(list(enumerate(work))):
        fields = _pairs([c for c in e if _local(c.tag) and not _object(c, record)])
        own = (e.text or "").strip()
        if own and not len(e):
            fields.append(("text()", own))
        attrs = _attributes(e)
        children = [i for _, i in sorted(kids.get(at, []))]
        role = "record" if name == record else "section" if holder < 0 else "table" if _table(name) else "group"
        kind = path.split("/")[-2].split("[")[0] if role == "record" and "/" in path else name
        me = _digest(kind, role, *[x for a in attrs for x in a], "\0", *[x for f in fields for x in f], "\0", *children)
        kids.setdefault(holder, []).append((-at, me))
        rows.append((statement, kind, role, path, "" if role == "section" else parent, work[holder][1] if holder >= 0 else "", section, n, dict(attrs).get("RecID", ""), me, attrs, fields, children))
    return rows


def _numbered(e, prefix: str, record: str) -> list[tuple]:
    """(child, path, ordinal among siblings of its name) of the child elements."""
    out = []
    seen: dict[str, int] = {}
    for c in e:
        name = _local(c.tag)
        if not name:
            continue  # comments and processing instructions
        seen[name] = seen.get(name, 0) + 1
        number = f"[{seen[name]}]" if _table(name) or name == record else ""
        out.append((c, f"{prefix}{name}{number}", seen[name]))
    return out


def _nodes(batch: pa.RecordBatch) -> dict[str, list]:
    rows = [r for s, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in parse(s, x or "")]
    return dict(zip(_NODES.names, map(list, zip(*rows)))) if rows else {}


def nodes(statements: DataFrame, id_col: str = "statement_id", xml_col: str = "xml") -> DataFrame:
    """One row per header, section, table, record and other nested object of every well-formed statement.

    A narrow operator.  Null, empty and cut-off texts have no rows; a missing
    RecID is ''; repeated statements give repeated rows; further columns are
    ignored; an empty table has no rows.
    """
    return statements.select(F.col(id_col).cast("bigint").alias("statement_id"), F.col(xml_col).alias("xml")).where("xml is not null").mapInArrow(chunked(_nodes, _NODES, 16), NODES)


def occurrences(flat: DataFrame) -> DataFrame:
    """Bridge rows: one per record occurrence, with its parent and object identity."""
    return flat.where("role = 'record'").select("statement_id", "kind", "node_path", "parent_path", "section", "ordinal", "rec_id", "object_id")


def objects(flat: DataFrame) -> DataFrame:
    """Every distinct object once, with the number of its occurrences.

    Equal identities have equal content, so ``first`` is deterministic and
    combines map-side: a much repeated object costs one row per task.
    """
    return flat.groupBy("object_id").agg(F.first("kind").alias("kind"), F.first("role").alias("role"), F.first("attributes").alias("attributes"), F.first("fields").alias("fields"), F.first("children").alias("children"), F.count(F.lit(1)).alias("n_occurrences"))


def object_links(flat: DataFrame) -> DataFrame:
    """Parent object -> child object with ordinals, each distinct pair of objects once."""
    return objects(flat).select(F.col("object_id").alias("parent_object"), F.posexplode("children").alias("ordinal", "child_object")).withColumn("ordinal", F.col("ordinal") + 1)


def flat_table(flat: DataFrame, kind: str, attributes: list[str], fields: list[str]) -> DataFrame:
    """The records of one kind of table with named columns; attributes get an @."""
    return flat.where((F.col("role") == "record") & (F.col("kind") == kind)).select("statement_id", "node_path", "parent_path", "rec_id", *[F.element_at("attributes", F.lit(a)).alias(f"@{a}") for a in attributes], *[F.element_at("fields", F.lit(f)).alias(f) for f in fields])


def columns_of(flat: DataFrame) -> DataFrame:
    """kind, name, is_attribute, n: which columns the records of each kind have; one small row per name."""
    rows = flat.where("role = 'record'")
    names = rows.select("kind", F.explode(F.concat(F.transform(F.map_keys("attributes"), lambda x: F.struct(x.alias("name"), F.lit(True).alias("is_attribute"))), F.transform(F.map_keys("fields"), lambda x: F.struct(x.alias("name"), F.lit(False).alias("is_attribute"))))).alias("c"))
    return names.groupBy("kind", "c.name", "c.is_attribute").agg(F.count(F.lit(1)).alias("n"))


def audit(flat: DataFrame) -> DataFrame:
    """Tables whose announced number of records (nRec) differs from the records found."""
    tables = flat.where("role = 'table'").select("statement_id", "node_path", F.element_at("attributes", F.lit("nRec")).try_cast("int").alias("announced"))
    found = flat.where("role = 'record'").groupBy("statement_id", F.col("holder_path").alias("node_path")).agg(F.count(F.lit(1)).alias("found"))
    out = tables.join(found, ["statement_id", "node_path"], "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return out.where("announced is not null and announced != found")
