"""Text functions of the document engine, as Column to Column functions.

All of them keep null as null unless they say otherwise, run inside whole-stage
code generation, and never call Python per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions import patterns as P


def strip(c: Column) -> Column:
    """Without blanks of any script at both ends."""
    return F.regexp_replace(c, f"^{P.BLANK}+|{P.BLANK}+$", "")


def squeeze(c: Column) -> Column:
    """Every run of blanks, no-break and thin ones too, as one blank; none at the ends."""
    return F.trim(F.regexp_replace(c, f"{P.BLANK}+", " "))


def without_anchor(c: Column) -> Column:
    """Without a trailing {#anchor}."""
    return strip(F.regexp_replace(c, P.ANCHOR, ""))


def normal_line(c: Column) -> Column:
    """A line as repeats are compared: no anchor, single blanks, lower case."""
    return F.lower(squeeze(F.regexp_replace(c, P.ANCHOR, "")))


def matches(c: Column, *found: str) -> Column:
    """Whether any pattern is found, ignoring case; false for null."""
    return F.coalesce(c.rlike(P.java(P.either(found))), F.lit(False))


def is_garbage(c: Column) -> Column:
    """Lines without content: empty, under three signs, on the list, or of a known running form."""
    clean = without_anchor(F.coalesce(c, F.lit("")))
    return (F.length(clean) < 3) | F.upper(clean).isin(*P.GARBAGE_LINES) | matches(clean, *P.GARBAGE_PATTERNS)


def is_important(c: Column) -> Column:
    """Headings of the sections that every document has."""
    return matches(without_anchor(F.coalesce(c, F.lit(""))), *P.IMPORTANT_PATTERNS)


def line_class(c: Column) -> Column:
    """garbage, important or content, the first that holds."""
    return F.when(is_garbage(c), "garbage").when(is_important(c), "important").otherwise("content")


def line_reason(c: Column, repeated: Column) -> Column:
    """Why a line is dropped or kept: repeat, blacklist, pattern, important or content, the first that holds."""
    clean = without_anchor(c)
    return F.when(repeated, "repeat").when(F.upper(clean).isin(*P.GARBAGE_LINES), "blacklist").when(matches(clean, *P.GARBAGE_PATTERNS), "pattern").when(is_important(c), "important").otherwise("content")


def is_tree_garbage(c: Column) -> Column:
    """Lines that a section tree leaves out."""
    t = strip(c)
    return t.rlike(P.TREE_GARBAGE) | ((F.length(t) < 3) & ~t.rlike(r"^\d"))


def is_running_line(c: Column) -> Column:
    """Header or footer lines by their words, or short lines with 'из'."""
    low = F.lower(strip(c))
    return (low.contains("из") & (F.length(strip(c)) < 20)) | reduce(lambda a, b: a | b, [low.contains(p) for p in P.RUNNING_PARTS])


def is_toc_line(c: Column) -> Column:
    """Lines of a table of contents: leader dots, or a page number at the end of a long line."""
    return c.contains("...") | c.contains("…") | (c.rlike(r"\s+\d{1,3}\s*$") & (F.length(F.regexp_replace(c, f"{P.BLANK}+$", "")) > 40))


def is_glossary_junk(c: Column) -> Column:
    """Page marks, rules and separators between glossary lines."""
    return c.rlike(P.GLOSSARY_JUNK)


def is_mostly_latin(c: Column, share: float = 0.6, least: int = 10) -> Column:
    """Lines over ``least`` letters of which more than ``share`` are Latin and no known word excuses it."""
    latin, cyrillic = F.regexp_count(c, F.lit("[a-zA-Z]")), F.regexp_count(c, F.lit("[а-яА-ЯёЁ]"))
    return (latin + cyrillic > least) & (latin > (latin + cyrillic) * share) & ~c.rlike(P.LATIN_ALLOWED)


def is_markdown_garbage(c: Column) -> Column:
    """Lines that the Markdown cleaner drops."""
    return c.rlike(P.java("^(?:" + P.either(P.MARKDOWN_GARBAGE) + ")")) | is_mostly_latin(c)


def is_actionable(c: Column) -> Column:
    """Texts that ask somebody to act."""
    return F.lower(c).rlike(P.ACTION_WORDS)


def is_corrupted_title(c: Column) -> Column:
    """Title pages of under 50 signs, or mostly Latin letters in the first 500."""
    head = F.substring(F.coalesce(c, F.lit("")), 1, 500)
    latin, cyrillic = F.regexp_count(head, F.lit("[a-zA-Z]")), F.regexp_count(head, F.lit("[а-яА-ЯёЁ]"))
    return (F.length(strip(F.coalesce(c, F.lit("")))) < 50) | ((latin + cyrillic > 0) & (latin > (latin + cyrillic) * 0.5))


def markdown_heading(c: Column) -> Column:
    """A line as a Markdown heading by the depth of its number, or when it is all capitals."""
    t = strip(c)
    num, title = F.regexp_extract(t, r"^(\d+(?:\.\d+)*)\s+([А-ЯA-Z].+)$", 1), F.regexp_extract(t, r"^(\d+(?:\.\d+)*)\s+([А-ЯA-Z].+)$", 2)
    depth = F.least(F.regexp_count(num, F.lit(r"\.")) + 1, F.lit(4))
    capitals = (F.upper(t) == t) & (F.lower(t) != t) & (F.length(t) > 5) & (F.length(t) < 80) & ~t.rlike(r"\d")
    return F.when((num != "") & (F.length(title) <= 150), F.concat(F.repeat(F.lit("#"), depth), F.lit(" "), num, F.lit(" "), title)).when((num == "") & capitals, F.concat(F.lit("# "), t)).otherwise(t)


def anchor(c: Column) -> Column:
    """The anchor of a heading: no number, lower case, hyphens for blanks, letters and figures only."""
    return F.regexp_replace(F.replace(F.lower(F.regexp_replace(c, r"^\d+\.?\s*", "")), F.lit(" "), F.lit("-")), r"[^\p{L}\p{N}_\-]", "")


def cell(c: Column) -> Column:
    """A table cell for Markdown: bars escaped, line breaks as blanks, ' ' where nothing is left."""
    t = strip(F.translate(F.replace(c, F.lit("|"), F.lit("\\|")), "\n\r", "  "))
    return F.coalesce(F.when(t != "", t), F.lit(" "))


def section(c: Column) -> Column:
    """number, level, title and kind (numeric, appendix, service, unknown) of a heading."""
    t = strip(F.regexp_replace(strip(c), r"\.{2,}\s*\d*\s*$", ""))
    service = reduce(lambda a, b: a | b, [F.upper(t).startswith(s) for s in P.SERVICE_SECTIONS])
    num = F.regexp_extract(t, r"^(\d+(?:\.\d+)*)(?:\s+.+)?$", 1)
    app = F.regexp_extract(t, P.java(r"^(Приложение\s+\d+|Приложение\s+[А-Яа-яA-Za-z])\.?\s*(.*)$"), 1)
    rest = strip(F.regexp_extract(t, r"^\d+(?:\.\d+)*\s+(.+)$", 1))
    rest_app = strip(F.regexp_extract(t, P.java(r"^(Приложение\s+\d+|Приложение\s+[А-Яа-яA-Za-z])\.?\s*(.*)$"), 2))
    kind = F.when(service, "service").when(num != "", "numeric").when(app != "", "appendix").otherwise("unknown")
    return F.struct(
        F.when(kind == "numeric", num).when(kind == "appendix", app).alias("num"),
        F.when(kind == "numeric", F.size(F.split(num, r"\."))).when(kind == "appendix", 1).otherwise(0).alias("level"),
        F.when(kind == "numeric", F.when(rest != "", rest).otherwise(num)).when(kind == "appendix", F.when(rest_app != "", rest_app).otherwise(app)).otherwise(t).alias("title"),
        kind.alias("kind"),
    )


def section_id(num: Column, kind: Column) -> Column:
    """The id of a section: its number, or app_ and the last figure or letter."""
    return F.when(kind == "appendix", F.concat(F.lit("app_"), F.lower(F.regexp_extract(num, r"(\d+|[А-Яа-яA-Za-z])$", 1)))).otherwise(num)


def section_key(num: Column) -> Column:
    """Sort key of a section number as an array: unnumbered first, appendices last."""
    number = F.regexp_extract(num, r"(\d+)", 1).try_cast("int")
    parts = F.transform(F.split(num, r"\."), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    return F.when(F.coalesce(num, F.lit("")) == "", F.array(F.lit(0))).when(F.lower(num).startswith("приложение"), F.array(F.lit(9999), F.coalesce(number, F.lit(0)))).otherwise(parts)


def process_code(c: Column) -> Column:
    """A process code with a Cyrillic first letter (Latin B is Б here)."""
    return F.when(F.length(c) > 0, F.concat(F.translate(F.upper(F.substring(c, 1, 1)), "MBV", "МБВ"), F.substring(c, 2, 1000))).otherwise(c)


def code_key(c: Column) -> Column:
    """A document code for comparison: upper case, look-alike Latin letters as Cyrillic (Latin B is В here)."""
    return F.coalesce(F.translate(F.upper(strip(c)), P.LOOKS_LATIN, P.LOOKS_CYRILLIC), F.lit(""))


def catalogue_key(c: Column) -> Column:
    """A code as the catalogue is searched: upper case, no blanks, hyphens for slashes and dots."""
    return F.translate(F.replace(F.upper(strip(c)), F.lit(" "), F.lit("")), "/.", "--")


def file_code(c: Column) -> Column:
    """The document code in a file or folder name: no hash, no extension, no closing remark."""
    t = strip(F.split_part(c, F.lit("^"), F.lit(1)))
    t = strip(F.replace(F.replace(t, F.lit(".pdf"), F.lit("")), F.lit(".PDF"), F.lit("")))
    return strip(F.regexp_replace(t, r"\s*\([^)]+\)\s*$", ""))


_CODES = (
    (r"^КД-(ДП|РД|РГ|СТ)-([МБВMB]\d+)\.(\d+)-(\d+)", 1, (2, 3), 4),
    (r"^(ДП|РД|СТ|РГ)-([МБВMB]\d+)\.(\d+)-(\d+)", 1, (2, 3), 4),
    (r"^(РК)(\d+)-(\d+)-(\d+)", "РК", "", 4),
    (r"^(ИОТ)-(\d+)-(\d+)", "ИОТ", "В7", 3),
    (r"^(СТ)-(\d+)-(\d+)", "СТ", "", 3),
    (r"^(TPM)-([A-Z]+)-([A-Z]+)-(\d+)-(\d+)", "TPM", "", 5),
    (r"^(КД)-(РГ)-(\d+)-(\d+)", "РГ", "", 4),
)


def document_code(name: Column) -> Column:
    """code, type, process and version in a file name; all null where it is no document code."""
    code = file_code(name)
    kind = process = version = None
    for pattern, k, p, v in reversed(_CODES):
        part = lambda n, pattern=pattern: F.regexp_extract(code, P.java(pattern), n)
        hit = code.rlike(P.java(pattern))
        new_kind = F.upper(part(k)) if isinstance(k, int) else F.lit(k)
        new_process = F.concat(process_code(F.upper(part(p[0]))), F.lit("."), part(p[1])) if isinstance(p, tuple) else F.lit(p)
        kind = F.when(hit, new_kind) if kind is None else F.when(hit, new_kind).otherwise(kind)
        process = F.when(hit, new_process) if process is None else F.when(hit, new_process).otherwise(process)
        version = F.when(hit, part(v)) if version is None else F.when(hit, part(v)).otherwise(version)
    return F.struct(F.when(kind.isNotNull(), code).alias("code"), kind.alias("type"), process.alias("process"), version.alias("version"))


def references(text: Column, own: Column) -> Column:
    """The distinct document codes named in a text, sorted, without its own."""
    every = F.flatten(F.array(*[F.transform(F.regexp_extract_all(text, F.lit(P.java(f"({p})")), F.lit(1)), lambda x: F.upper(x)) for p in P.REFERENCES]))
    return F.array_sort(F.array_distinct(F.array_remove(every, F.upper(F.coalesce(own, F.lit(""))))))


def dates(text: Column) -> Column:
    """approval (a date near a word of approval) or else effective (the first date of the first 2000 signs)."""

    def first_date(c: Column) -> Column:
        return F.coalesce(*[F.nullif(F.regexp_extract(c, P.java(p), 1), F.lit("")) for p in P.DATES])

    low = F.lower(text)
    near = []
    for word in P.APPROVAL_WORDS:
        at = F.locate(word, low)
        start = F.greatest(at - 50, F.lit(1))
        near.append(F.when(at > 0, first_date(F.substring(text, start, at + 200 - start))))
    approval = F.coalesce(*near)
    return F.struct(approval.alias("approval_date"), F.when(approval.isNull(), first_date(F.substring(text, 1, 2000))).alias("effective_date"))


def title(text: Column) -> Column:
    """The title of a document: after its code, in capitals, or after a label; 11 to 199 signs."""
    tries = []
    for p in P.TITLES:
        t = squeeze(F.regexp_extract(text, "(?ium)" + p, 1))
        tries.append(F.when((F.length(t) > 10) & (F.length(t) < 200), t))
    return F.coalesce(*tries)


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two texts by their lower-case words, 0 when either has none."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), f"{P.BLANK}+"), lambda x: x != ""))
    x, y = words(a), words(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def legal_kind(name: Column) -> Column:
    """person or legal, by the reference's substring rule: any abbreviation of a legal form makes a name legal."""
    low = F.lower(name)
    forms = reduce(lambda a, b: a | b, [low.contains(x.lower()) for pair in P.LEGAL_FORMS for x in pair])
    words = F.filter(F.split(name, f"{P.BLANK}+"), lambda x: x != "")
    people = F.size(words).between(2, 4) & ~name.rlike('["«»]') & F.forall(words, lambda w: w.rlike(r"^[А-Яа-яЁёA-Za-z\-]+$"))
    return F.when(forms, "legal").when(people, "person").otherwise("legal")


def person_name(name: Column) -> Column:
    """A person's name: look-alike Latin letters as Cyrillic where both occur, capitals to title case."""
    mixed = name.rlike("[А-Яа-яЁё]") & name.rlike("[A-Za-z]")
    t = F.when(mixed, F.translate(name, P.NAME_LATIN, P.NAME_CYRILLIC)).otherwise(name)

    def one(w: Column) -> Column:
        titled = F.array_join(F.transform(F.split(w, "-"), lambda p: F.initcap(p)), "-")
        upper = (F.upper(w) == w) & (F.lower(w) != w)
        first_small = F.substring(w, 1, 1).rlike(r"[^\p{Lu}]")
        return F.when(upper, titled).when(first_small, F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1000)))).otherwise(w)

    return F.array_join(F.transform(F.filter(F.split(t, f"{P.BLANK}+"), lambda x: x != ""), one), " ")


def legal_name(name: Column) -> Column:
    """An organisation's name: no trustee status, the longest legal form abbreviated, straight quotes, the missing opening one put back."""
    t = F.regexp_replace(name, P.java(r"\s+д\.у\.|\s+\(д\.у\.\)|\s+в лице.*$"), "")
    hit = F.lit(None).cast("string")
    for form, short in reversed(P.LEGAL_FORMS):
        hit = F.when(F.lower(t).contains(form.lower()), F.regexp_replace(t, P.java(form), short)).otherwise(hit)
    t = F.translate(F.coalesce(hit, t), "«»„“”'‘’", '""""""""')
    n = F.regexp_count(t, F.lit('"'))
    first = F.regexp_extract(t, r'^\s*(ООО|ЗАО|ОАО|АО|ПАО)\s+([^"]*)"(.*)$', 1)
    inner, rest = squeeze(F.regexp_extract(t, r'^\s*(ООО|ЗАО|ОАО|АО|ПАО)\s+([^"]*)"(.*)$', 2)), F.regexp_extract(t, r'^\s*(ООО|ЗАО|ОАО|АО|ПАО)\s+([^"]*)"(.*)$', 3)
    mended = F.when(first != "", F.concat(first, F.lit(' "'), inner, F.lit(" "), rest)).otherwise(F.concat(F.lit('"'), t))
    return F.regexp_replace(F.when(n % 2 != 0, mended).otherwise(t), f"{P.BLANK}{{2,}}", " ")


def owner_name(name: Column) -> Column:
    """A person's or organisation's name in one spelling: е for ё, no place in brackets at the end, then by kind."""
    t = squeeze(F.regexp_replace(F.translate(squeeze(name), "ёЁ", "еЕ"), r"\s+\([А-Яа-яЁё\s\-]+\)$", ""))
    return F.when(legal_kind(t) == "person", person_name(t)).otherwise(legal_name(t))


def amount_before_words(c: Column) -> Column:
    """The number before an amount in words in brackets, blanks inside it dropped; null without one."""
    return F.regexp_replace(F.regexp_extract(c, r"(\d[\d\s]*)\s*\(", 1), r"\s", "").try_cast("bigint")


def number_strip(c: Column) -> Column:
    """A number after all blanks and commas are dropped ('1 234,56' is 123456)."""
    return F.regexp_replace(c, f"{P.BLANK}|,", "").try_cast("double")


def number_auto(c: Column) -> Column:
    """A number whose last separator is the decimal point; one comma is a point, several are thousands; null for other texts."""
    t = F.translate(F.regexp_replace(strip(c), r"[\x{A0} ]", ""), "−—", "--")
    comma, point = F.locate(",", F.reverse(t)), F.locate(".", F.reverse(t))
    one = F.when((comma > 0) & (point > 0), F.when(point < comma, F.replace(t, F.lit(","), F.lit(""))).otherwise(F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))))
    one = one.when(comma > 0, F.when(F.regexp_count(t, F.lit(",")) == 1, F.replace(t, F.lit(","), F.lit("."))).otherwise(F.replace(t, F.lit(","), F.lit(""))))
    return F.when(t.rlike(r"^-?[\d.,]+$"), one.otherwise(t).try_cast("double"))


def null_tokens(c: Column) -> Column:
    """Null for texts that stand for a missing value."""
    t = strip(c)
    return F.when(~t.isin("", "None", "nan"), t)


def artefacts(c: Column) -> Column:
    """Without bars, with words joined that a hyphen and a blank cut, single blanks."""
    t = F.regexp_replace(F.regexp_replace(c, r"\s*\|\s*", " "), r"([\p{L}\p{N}_])- ([\p{L}\p{N}_])", "$1$2")
    return strip(F.regexp_replace(t, r"\s{2,}", " "))


def for_export(c: Column) -> Column:
    """Markdown for a plain document: marks spelled out, no emoji, line breaks and blanks after bold text."""
    for mark, plain in P.EXPORT_MARKS:
        c = F.replace(c, F.lit(mark), F.lit(plain))
    c = F.regexp_replace(F.regexp_replace(c, P.EMOJI, ""), r"<br>\s*", "  \n")
    return F.regexp_replace(F.regexp_replace(c, r"\*\*([^*]+)\*\*([А-ЯЁA-Z])", r"**$1** $2"), r"\)([А-ЯЁ]{2,}:)", r") $1")


def split_languages(c: Column) -> Column:
    """ru and en part of a mixed text: tokens go by their letters, neutral ones to every part begun, mixed ones to both; a short English part goes back."""
    tokens = F.filter(F.split(c, f"{P.BLANK}+"), lambda x: x != "")
    start = F.struct(F.array().cast("array<string>").alias("ru"), F.array().cast("array<string>").alias("en"))

    def step(acc: Column, t: Column) -> Column:
        cyr, lat = t.rlike("[а-яА-ЯёЁ]"), t.rlike("[a-zA-Z]")
        ru = F.when(cyr | (~lat & (F.size(acc["ru"]) > 0)), F.array_append(acc["ru"], t)).otherwise(acc["ru"])
        en = F.when(lat | (~cyr & (F.size(acc["en"]) > 0)), F.array_append(acc["en"], t)).otherwise(acc["en"])
        return F.struct(ru.alias("ru"), en.alias("en"))

    both = F.aggregate(tokens, start, step)
    edge = r"^[\s,;.\-–—]+|[\s,;\-–—]+$"
    ru, en = F.regexp_replace(F.array_join(both["ru"], " "), edge, ""), F.regexp_replace(F.array_join(both["en"], " "), edge, "")
    short = F.length(en) < 20
    return F.struct(F.when(short, squeeze(c)).otherwise(ru).alias("ru"), F.when(short, F.lit("")).otherwise(en).alias("en"))


def type_b_key(name: Column) -> Column:
    """The key of a record without an owner code."""
    return F.concat(F.lit("TypeB_"), F.substring(F.md5(name), 1, 11))


def duration(seconds: Column) -> Column:
    """Seconds as text: seconds, minutes, or hours and minutes."""
    hours, minutes = F.floor(seconds / 3600).cast("int"), F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("int")
    return F.when(seconds < 60, F.format_string("%.1f сек", seconds.cast("double"))).when(seconds < 3600, F.format_string("%.1f мин", seconds / 60)).otherwise(F.format_string("%d ч %d мин", hours, minutes))
