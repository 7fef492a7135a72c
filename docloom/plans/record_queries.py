"""Queries over owner records and the events they are assembled from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators import ordered
from docloom.operators import records as R
from docloom.plans import oracle as O
from docloom.plans.line_queries import blocks, page_lines, pages
from docloom.sources.tables import latest, table


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current state of the owner records."""
    return latest(table(spark, sf_dir, "owner_records"), "record_id", "loaded_at")


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and invalid records of each register (AGG-05, FLT-15, SNK-05)."""
    return R.validation(owners(spark, sf_dir), "register_id")


def duplicate_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner codes on several records (AGG-09)."""
    return R.duplicates(owners(spark, sf_dir), "owner_code", "record_id")


def duplicate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names on several records (AGG-09)."""
    return R.duplicates(owners(spark, sf_dir), "full_name", "record_id")


def fill_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of filled fields in each register, and the distance of its total from a control total (AGG-10)."""
    rate = lambda c: F.round(F.count_if(F.coalesce(F.trim(c) != "", F.lit(False))) * 100.0 / F.count(F.lit(1)), 2)
    return owners(spark, sf_dir).groupBy("register_id").agg(rate(F.col("address")).alias("address_pct"), rate(F.col("full_name")).alias("name_pct"), rate(F.col("document_number")).alias("document_pct"), rate(F.col("account_number")).alias("account_pct"), (F.coalesce(F.sum("quantity"), F.lit(0)) - 1000).alias("delta"))


def complete_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most complete record of every owner code (AGG-23)."""
    return R.most_complete(owners(spark, sf_dir), "owner_code", ["address", "full_name", "document_number", "account_number"], "record_id").select("owner_code", "record_id", "score")


def top_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest quantities (ORD-04)."""
    return owners(spark, sf_dir).where("quantity is not null").select("record_id", "quantity").orderBy(F.desc("quantity"), "record_id").limit(10)


def missing_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of complete records that no incomplete one has (SET-01)."""
    o = owners(spark, sf_dir).where("full_name is not null")
    return o.where("is_complete").select("full_name").subtract(o.where("not is_complete").select("full_name"))


def first_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct owner codes of each register in the order of first sight (SET-04)."""
    f = owners(spark, sf_dir).where("owner_code is not null").groupBy("register_id", "owner_code").agg(F.min("ordinal").alias("first_ordinal"))
    return f


def joined_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the last positive quantity of their code, inner and as enrichment (JOIN-01, JOIN-02)."""
    o = owners(spark, sf_dir)
    q = o.where("quantity > 0 and owner_code is not null").groupBy("owner_code").agg(F.max_by("quantity", "record_id").alias("last_quantity"), F.min_by("quantity", "record_id").alias("first_quantity"))
    return o.join(q, "owner_code").select("record_id", "last_quantity", F.coalesce("first_quantity", "quantity").alias("enriched"))


def owner_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in one spelling (SCL-20, UDF-03, UDF-04)."""
    return owners(spark, sf_dir).where("full_name is not null").select("record_id", T.legal_kind(T.squeeze(F.col("full_name"))).alias("kind"), T.owner_name(F.col("full_name")).alias("name"), T.type_b_key(F.col("full_name")).alias("key"))


def parsed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of table cells in each grammar, and null tokens (SCL-21, SCL-22, SCL-23, SCL-44)."""
    cells = pages(spark, sf_dir, "tables").select("content_id", F.posexplode(F.flatten(F.flatten("tables"))).alias("i", "cell")).where("cell is not null")
    c = F.col("cell")
    return cells.select("content_id", "i", T.null_tokens(c).alias("text"), F.round(T.number_strip(c), 4).alias("n_strip"), F.round(T.number_auto(c), 4).alias("n_auto"), T.amount_before_words(F.concat(c, F.lit(" (прописью)"))).alias("amount"))


def split_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner codes, mended where blanks split them (SCL-28)."""
    c = F.regexp_replace("owner_code", r"^(\d{2}_\d{5})", "$1 ")
    whole = F.nullif(F.regexp_extract(c, r"(0[123]_\d{11})", 1), F.lit(""))
    spaced = F.nullif(F.regexp_extract(F.regexp_replace(c, r"\s", ""), r"(0[123]_\d{11})", 1), F.lit(""))
    digits = F.array_join(F.regexp_extract_all(c, F.lit(r"(\d)"), F.lit(1)), "")
    built = F.when(F.length(digits) >= 13, F.concat(F.substring(digits, 1, 2), F.lit("_"), F.substring(digits, 3, 11)))
    return owners(spark, sf_dir).select("record_id", F.coalesce(whole, spaced, built).alias("code"))


def known_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose code stands as a word in some page (FLT-23)."""
    words = page_lines(spark, sf_dir).select(F.explode(F.regexp_extract_all("line", F.lit(r"([\p{L}\p{N}_.\-]+)"), F.lit(1))).alias("w")).distinct()
    docs = latest(table(spark, sf_dir, "document_metadata").select("meta_id", "doc_id", "processed_date"), "meta_id", "processed_date")
    return docs.join(words, docs["doc_id"] == words["w"], "left_semi").select("meta_id", "doc_id")


def owner_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of addresses found by pattern: postal code, house, flat (SCL-27)."""
    a = F.col("address")
    part = lambda p: F.nullif(F.regexp_extract(a, P.java(p), 1), F.lit(""))
    return owners(spark, sf_dir).where("address is not null").select("record_id", part(r"(\d{6})").alias("postal"), part(r"(?:^|[\s,])(?:д|дом)\.?\s*(\d+)").alias("house"), part(r"кв\.?\s*(\d+)").alias("flat"))


def pattern_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many names, codes, amounts and dates every page holds, in all and distinct (AGG-22)."""
    t = F.coalesce("text", F.lit(""))
    each = {"names": r"([А-ЯЁ]\.\s?[А-ЯЁ]\.\s?[А-ЯЁ][а-яё]+)", "codes": r"(\d{6})", "amounts": r"(\d+,\d{2})", "dates": r"(\d{2}\.\d{2}\.\d{4})"}
    found = {n: F.regexp_extract_all(t, F.lit(p), F.lit(1)) for n, p in each.items()}
    return pages(spark, sf_dir, "text").select("content_id", *[F.size(x).alias(n) for n, x in found.items()], *[F.size(F.array_distinct(x)).alias(f"d_{n}") for n, x in found.items()])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks as record events: headings start, paragraphs tell who, tables tell how much."""
    kind = F.when(F.col("type") == "heading", "START").when(F.col("type") == "paragraph", "PERSONAL").when(F.col("type") == "table", "QUANTITY")
    b = blocks(spark, sf_dir, "doc_id", "page", "seq", "type", "id", "content").where("doc_id is not null").withColumn("kind", kind).where("kind is not null")
    return b.withColumn("value", F.when(kind == "QUANTITY", F.length(F.coalesce("content", F.lit(""))).cast("string")).otherwise(F.col("id")))


def assembled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records assembled across pages by the state machine (WIN-04)."""
    return R.state_machine(_events(spark, sf_dir), "doc_id", "page", ["page", "seq", "block_no"])


def _marks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = _events(spark, sf_dir).withColumn("pos", F.col("seq") * 100)
    return e.where("kind = 'START'").select(F.col("doc_id").alias("doc"), "pos", F.col("id").alias("owner")), e.where("kind = 'QUANTITY'").select(F.col("doc_id").alias("doc"), "pos", F.col("value").cast("bigint").alias("qty"))


def asof_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that belongs to every heading, forward else backward, and the next one whatever lies between (JOIN-03, JOIN-04, JOIN-05, JOIN-24)."""
    return R.asof(*_marks(spark, sf_dir))


def marker_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Span from every heading to the next, the last at most 5000 long (WIN-12)."""
    m, _ = _marks(spark, sf_dir)
    m = ordered.next_known(m.withColumn("c", F.floor(F.col("pos") / 4096)), "doc", "c", ["pos"], F.col("pos"), "end")
    return m.select("doc", "pos", F.coalesce("end", F.col("pos") + 5000).alias("end"))


def zipped_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The i-th heading with the i-th table of a document (JOIN-07)."""
    m, t = _marks(spark, sf_dir)
    return R.zipped(m, t.withColumn("value", F.col("qty")), "doc", "pos").select("doc", "pos", "i", "right_value")


def nearby_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every 'Итого' line the nearest date line 2 to 49 on, else 1 to 29 back (JOIN-06).

    Dates are spread to the blocks of 50 lines they can be seen from, so the
    join is on document and block, not on all pairs.
    """
    rows = page_lines(spark, sf_dir).select("content_id", "line_no", "line")
    a = rows.where(F.col("line").contains("Итого")).select("content_id", F.col("line_no").alias("i"), F.floor(F.col("line_no") / 50).alias("b"))
    d = F.regexp_extract("line", r"(\d{2}\.\d{2}\.\d{4})", 1)
    c = rows.withColumn("code", d).where("code != ''").select("content_id", F.col("line_no").alias("j"), "code", F.explode(F.array(*[F.floor(F.col("line_no") / 50) + k for k in (-1, 0, 1)])).alias("b"))
    hit = a.join(c, ["content_id", "b"])
    k = F.col("j") - F.col("i")
    hit = hit.withColumn("rank", F.when(k.between(2, 49), k).when((k.between(-29, -1)) & (F.col("j") > F.greatest(F.lit(0), F.col("i") - 30)), 1000 - k)).where("rank is not null")
    return hit.groupBy("content_id", "i").agg(F.min_by("code", "rank").alias("code"))


def compared_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registers whose totals differ between complete records and all records (JOIN-21, SRC-32)."""
    o = owners(spark, sf_dir)
    return R.compared(o, o.where("is_complete"), "register_id", "quantity")


QUERIES = {f.__name__: f for f in (validation_report, duplicate_codes, duplicate_names, fill_rates, complete_records, top_quantities, missing_names, first_codes, joined_quantities, owner_names, parsed_numbers, split_codes, known_codes, owner_fields, pattern_census, assembled_records, asof_quantities, marker_chunks, zipped_quantities, nearby_codes, compared_extractions)}

_A = O.strip("address")
_VALID = f"coalesce({_A} != '' and quantity > 0, false)"
_DUP = lambda by: f"select o.{by}, count(*) as n, array_to_string(list_sort(list(distinct record_id))[1:5], ',') as examples from owners o where {by} is not null group by 1 having count(*) > 1"
_SCORE = " + ".join(f"cast(coalesce({f} != '', false) as int)" for f in ("address", "full_name", "document_number", "account_number"))
_CELLS = "select content_id, generate_subscripts(c, 1) - 1 as i, unnest(c) as cell from (select content_id, flatten(flatten(tables)) as c from pages)"
_NUM = f"translate(regexp_replace({O.strip('cell')}, '[\\x{{A0}} ]', '', 'g'), '−—', '--')"
_AUTO = "case when regexp_matches(t, '^-?[\\d.,]+$') then try_cast(case when contains(t, ',') and contains(t, '.') then case when strpos(reverse(t), '.') < strpos(reverse(t), ',') then replace(t, ',', '') else replace(replace(t, '.', ''), ',', '.') end when contains(t, ',') then case when length(t) - length(replace(t, ',', '')) = 1 then replace(t, ',', '.') else replace(t, ',', '') end else t end as double) end"
_EVENTS = "select *, case when kind = 'QUANTITY' then cast(length(coalesce(content, '')) as varchar) else id end as value from (select *, case type when 'heading' then 'START' when 'paragraph' then 'PERSONAL' when 'table' then 'QUANTITY' end as kind from blocks where doc_id is not null) where kind is not null"
_W = "over (partition by doc_id order by page nulls first, seq, block_no)"
_MARKS = "select doc_id as doc, seq * 100 as pos, id as owner from events where kind = 'START'"
_TABS = "select doc_id as doc, seq * 100 as pos, cast(value as bigint) as qty from events where kind = 'QUANTITY'"
_NEXT = "select *, lead(pos) over (partition by doc order by pos) as nm, lag(pos) over (partition by doc order by pos) as pm from m"
_FW = "(select arg_min(qty, t.pos) from t where t.doc = k.doc and t.pos > k.pos and t.pos < case when k.nm != 0 then k.nm else k.pos + 5000 end)"
_BW = "(select arg_max(qty, t.pos) from t where t.doc = k.doc and t.pos < k.pos and t.pos > case when k.pm != 0 then k.pm else k.pos - 3000 end)"


def _owner_name_sql() -> str:
    t = O.squeeze(f"regexp_replace(translate({O.squeeze('full_name')}, 'ёЁ', 'еЕ'), '\\s+\\([А-Яа-яЁё\\s\\-]+\\)$', '')")
    forms = " or ".join(f"contains(lower({{0}}), {O.lit(x.lower())})" for pair in P.LEGAL_FORMS for x in pair)
    words = f"list_filter(regexp_split_to_array({{0}}, {O.lit(P.BLANK + '+')}), lambda x: x != '')"
    people = f"len({words}) between 2 and 4 and not regexp_matches({{0}}, '[\"«»]') and len(list_filter({words}, lambda w: not regexp_matches(w, '^[А-Яа-яЁёA-Za-z\\-]+$'))) = 0"
    kind = lambda c: f"case when {forms.replace('{0}', c)} then 'legal' when {people.replace('{0}', c)} then 'person' else 'legal' end"
    title = "array_to_string(list_transform(string_split(w, '-'), lambda p: upper(p[1]) || lower(p[2:])), '-')"
    each = f"case when upper(w) = w and lower(w) != w then {title} when not regexp_matches(w[1], '\\p{{Lu}}') then upper(w[1]) || lower(w[2:]) else w end"
    person = f"array_to_string(list_transform({words.replace('{0}', 'm')}, lambda w: {each}), ' ')"
    mixed = f"case when regexp_matches(t, '[А-Яа-яЁё]') and regexp_matches(t, '[A-Za-z]') then translate(t, '{P.NAME_LATIN}', '{P.NAME_CYRILLIC}') else t end"
    status = O.lit(P.re2(r"\s+д\.у\.|\s+\(д\.у\.\)|\s+в лице.*$"))
    short = "case " + " ".join(f"when contains(lower(l0), {O.lit(f.lower())}) then regexp_replace(l0, {O.lit(P.re2(f))}, {O.lit(s)}, 'g')" for f, s in P.LEGAL_FORMS) + " else l0 end"
    q = "'^\\s*(ООО|ЗАО|ОАО|АО|ПАО)\\s+([^\"]*)\"(.*)$'"
    inner = O.squeeze(f"regexp_extract(l2, {q}, 2)")
    legal = f"regexp_replace(case when (length(l2) - length(replace(l2, '\"', ''))) % 2 != 0 then case when regexp_extract(l2, {q}, 1) != '' then regexp_extract(l2, {q}, 1) || ' \"' || {inner} || ' ' || regexp_extract(l2, {q}, 3) else '\"' || l2 end else l2 end, {O.lit(P.BLANK + '{2,}')}, ' ', 'g')"
    return f"select record_id, {kind(O.squeeze('full_name'))} as kind, case when k = 'person' then {person} else {legal} end as name, 'TypeB_' || md5(full_name)[1:11] as key from (select *, translate({short}, '«»„“”''‘’', '\"\"\"\"\"\"\"\"') as l2 from (select *, {mixed} as m, regexp_replace(t, {status}, '', 'g') as l0, {kind('t')} as k from (select record_id, full_name, {t} as t from owners where full_name is not null)))"


SQL = {
    "validation_report": O.sql(f"select *, case when total > 0 then round(valid * 100.0 / total, 2) else 0.0 end as quality from (select register_id, count(*) as total, count(*) filter ({_VALID}) as valid, count(*) filter (not {_VALID}) as invalid, coalesce(sum(quantity) filter ({_VALID}), 0) as quantity, count(*) filter (not {_VALID} and coalesce({_A} = '', true)) as missing_address, count(*) filter (not {_VALID} and coalesce(quantity <= 0, true)) as missing_quantity from owners group by 1)", "owners"),
    "duplicate_codes": O.sql(_DUP("owner_code"), "owners"),
    "duplicate_names": O.sql(_DUP("full_name"), "owners"),
    "fill_rates": O.sql("select register_id, " + ", ".join(f"round(count(*) filter (trim({c}) != '') * 100.0 / count(*), 2) as {n}_pct" for c, n in (("address", "address"), ("full_name", "name"), ("document_number", "document"), ("account_number", "account"))) + ", coalesce(sum(quantity), 0) - 1000 as delta from owners group by 1", "owners"),
    "complete_records": O.sql(f"select owner_code, record_id, score from (select *, {_SCORE} as score from owners where owner_code is not null) qualify row_number() over (partition by owner_code order by score desc, record_id) = 1", "owners"),
    "top_quantities": O.sql("select record_id, quantity from owners where quantity is not null order by quantity desc, record_id limit 10", "owners"),
    "missing_names": O.sql("select full_name from owners where is_complete and full_name is not null except select full_name from owners where not is_complete and full_name is not null", "owners"),
    "first_codes": O.sql("select register_id, owner_code, min(ordinal) as first_ordinal from owners where owner_code is not null group by 1, 2", "owners"),
    "joined_quantities": O.sql("select record_id, l as last_quantity, coalesce(f, quantity) as enriched from owners join (select owner_code, arg_max(quantity, record_id) as l, arg_min(quantity, record_id) as f from owners where quantity > 0 and owner_code is not null group by 1) using (owner_code)", "owners"),
    "owner_names": O.sql(_owner_name_sql(), "owners"),
    "parsed_numbers": O.sql(f"select content_id, i, case when {O.strip('cell')} not in ('', 'None', 'nan') then {O.strip('cell')} end as text, round(try_cast(regexp_replace(cell, {O.lit(P.BLANK + '|,')}, '', 'g') as double), 4) as n_strip, round({_AUTO}, 4) as n_auto, try_cast(regexp_replace(regexp_extract(cell || ' (прописью)', '(\\d[\\d\\s]*)\\s*\\(', 1), '\\s', '', 'g') as bigint) as amount from (select *, {_NUM} as t from cells where cell is not null)", "pages", cells=_CELLS),
    "split_codes": O.sql("select record_id, coalesce(nullif(regexp_extract(c, '(0[123]_\\d{11})', 1), ''), nullif(regexp_extract(regexp_replace(c, '\\s', '', 'g'), '(0[123]_\\d{11})', 1), ''), case when length(d) >= 13 then d[1:2] || '_' || d[3:13] end) as code from (select record_id, c, array_to_string(regexp_extract_all(c, '\\d'), '') as d from (select record_id, regexp_replace(owner_code, '^(\\d{2}_\\d{5})', '\\1 ') as c from owners))", "owners"),
    "known_codes": O.sql("select meta_id, doc_id from meta where doc_id in (select unnest(regexp_extract_all(line, '[\\p{L}\\p{N}_.\\-]+')) from page_lines)", "meta", "page_lines"),
    "owner_fields": O.sql("select record_id, " + ", ".join(f"nullif(regexp_extract(address, {O.lit(P.re2(p))}, 1), '') as {n}" for p, n in ((r"(\d{6})", "postal"), (r"(?:^|[\s,])(?:д|дом)\.?\s*(\d+)", "house"), (r"кв\.?\s*(\d+)", "flat"))) + " from owners where address is not null", "owners"),
    "pattern_census": O.sql("select content_id, " + ", ".join(f"len(regexp_extract_all(t, {O.lit(p)})) as {n}, len(list_distinct(regexp_extract_all(t, {O.lit(p)}))) as d_{n}" for n, p in (("names", r"([А-ЯЁ]\.\s?[А-ЯЁ]\.\s?[А-ЯЁ][а-яё]+)"), ("codes", r"(\d{6})"), ("amounts", r"(\d+,\d{2})"), ("dates", r"(\d{2}\.\d{2}\.\d{4})"))) + " from (select content_id, coalesce(text, '') as t from pages)", "pages"),
    "assembled_records": O.sql("select *, address is not null and quantity is not null as complete from (select doc_id, record, arg_max(value, {'p': page, 's': seq, 'b': block_no}) filter (kind = 'PERSONAL') as address, try_cast(arg_max(value, {'p': page, 's': seq, 'b': block_no}) filter (kind = 'QUANTITY') as bigint) as quantity from e2 where n = 0 or (n = 1 and kind = 'QUANTITY') group by 1, 2)", "blocks", events=_EVENTS, e1=f"select *, sum(cast(kind = 'START' as int)) {_W} as record from events", e2="select *, sum(cast(kind = 'QUANTITY' as int)) over (partition by doc_id, record order by page nulls first, seq, block_no) as n from e1 where record > 0"),
    "asof_quantities": O.sql(f"select doc, pos, owner, coalesce(f, b) as qty, nx as qty_next, case when f is not null then 'forward' when b is not null then 'backward' else 'none' end as how from (select *, {_FW} as f, {_BW} as b, (select arg_min(qty, t.pos) from t where t.doc = k.doc and t.pos > k.pos) as nx from k)", "blocks", events=_EVENTS, m=_MARKS, t=_TABS, k=_NEXT),
    "marker_chunks": O.sql("select doc, pos, coalesce(lead(pos) over (partition by doc order by pos), pos + 5000) as \"end\" from m", "blocks", events=_EVENTS, m=_MARKS),
    "zipped_quantities": O.sql("select a.doc, a.pos, a.i, b.qty as right_value from (select *, row_number() over (partition by doc order by pos) as i from m) a left join (select *, row_number() over (partition by doc order by pos) as i from t) b on a.doc = b.doc and a.i = b.i", "blocks", events=_EVENTS, m=_MARKS, t=_TABS),
    "nearby_codes": O.sql("select content_id, i, arg_min(code, r) as code from (select a.content_id, a.line_no as i, c.code, case when c.line_no - a.line_no between 2 and 49 then c.line_no - a.line_no when c.line_no - a.line_no between -29 and -1 and c.line_no > greatest(0, a.line_no - 30) then 1000 - (c.line_no - a.line_no) end as r from (select * from page_lines where contains(line, 'Итого')) a join (select content_id, line_no, regexp_extract(line, '(\\d{2}\\.\\d{2}\\.\\d{4})', 1) as code from page_lines) c on a.content_id = c.content_id and c.code != '') where r is not null group by 1, 2", "page_lines"),
    "compared_extractions": O.sql("select register_id, old_value, new_value, case when new_value is null then 'old' when old_value is null then 'new' else 'both' end as side from (select register_id, sum(quantity) as old_value, sum(quantity) filter (is_complete) as new_value from owners group by 1) where new_value is null or old_value is null or old_value != new_value", "owners"),
}
