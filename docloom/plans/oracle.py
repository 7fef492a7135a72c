"""The common parts of the DuckDB statements that the queries are compared with."""

from __future__ import annotations

from docloom.functions import patterns as P


def lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def found(column: str, *patterns: str) -> str:
    """Whether one of the patterns is found, ignoring case."""
    return f"coalesce(regexp_matches({column}, {lit(P.re2(P.either(patterns)))}), false)"


def strip(column: str) -> str:
    return f"regexp_replace({column}, {lit(f'^{P.BLANK}+|{P.BLANK}+$')}, '', 'g')"


def squeeze(column: str) -> str:
    return f"trim(regexp_replace({column}, {lit(f'{P.BLANK}+')}, ' ', 'g'))"


def bare(column: str) -> str:
    return strip(f"regexp_replace({column}, {lit(P.ANCHOR)}, '', 'g')")


def normal_line(column: str) -> str:
    return f"lower({squeeze(f'regexp_replace({column}, {lit(P.ANCHOR)}, {lit('')}, {lit("g")})')})"


def is_garbage(column: str) -> str:
    clean = bare(f"coalesce({column}, '')")
    return f"(length({clean}) < 3 or upper({clean}) in ({', '.join(map(lit, P.GARBAGE_LINES))}) or {found(clean, *P.GARBAGE_PATTERNS)})"


def is_important(column: str) -> str:
    return found(bare(f"coalesce({column}, '')"), *P.IMPORTANT_PATTERNS)


def _latest(table: str, key: str, time: str) -> str:
    return f"(select * from {table} qualify row_number() over (partition by {key} order by {time} desc) = 1)"


CTES = {
    "blocks": _latest("ir_blocks", "block_no", "loaded_at"),
    "pages": _latest("page_contents", "content_id", "loaded_at"),
    "ocr": _latest("ocr_responses", "page_id", "received_at"),
    "parsed": _latest("full_parse_results", "result_id", "parsed_at"),
    "owners": _latest("owner_records", "record_id", "loaded_at"),
    "meta": _latest("document_metadata", "meta_id", "processed_date"),
    "docx": _latest("docx_metadata", "docx_id", "extracted_at"),
    "block_lines": "(select doc_id, page, seq, block_no, generate_subscripts(string_split(content, chr(10)), 1) - 1 as line_no, unnest(string_split(content, chr(10))) as line from blocks where content is not null)",
    "page_lines": "(select doc_id, page_num as page, content_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no, unnest(string_split(text, chr(10))) as line from pages where text is not null)",
    "markdown_lines": "(select result_id, doc_code, generate_subscripts(string_split(full_markdown, chr(10)), 1) - 1 as line_no, unnest(string_split(full_markdown, chr(10))) as line from parsed where full_markdown is not null)",
}
_NEEDS = {"block_lines": ["blocks"], "page_lines": ["pages"], "markdown_lines": ["parsed"]}


def sql(body: str, *ctes: str, **more: str) -> str:
    """A statement over common tables and named extra ones."""
    names = list(dict.fromkeys(x for c in ctes for x in [*_NEEDS.get(c, []), c]))
    parts = [f"{n} as {CTES[n]}" for n in names] + [f"{n} as ({q})" for n, q in more.items()]
    return ("with " + ", ".join(parts) + " " if parts else "") + body
