"""Fixed values of the line, block and code rules, and their forms for the two engines.

Every pattern is written so that Java and RE2 read it alike: explicit letter
classes, no lookaround, no backreference.  ``java`` and ``re2`` add the flags
that each engine needs to ignore the case of Cyrillic letters.
"""

from __future__ import annotations

# The blanks that Python's str.split knows.
BLANK = r"[\x{1C}-\x{1F}\x{09}-\x{0D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ANCHOR = r"\s*\{#[^}]+\}\s*$"

# Lines that are dropped when the whole line equals one, in upper case.
GARBAGE_LINES = (
    "PROCEDURES",
    "СOLLECTION OF CONTINUING AIRWORTHINESS",
    "COLLECTION OF CONTINUING AIRWORTHINESS",
    "СБОРНИК ПРОЦЕДУР ПО ПОДДЕРЖАНИЮ ЛЕТНОЙ",
    "ГОДНОСТИ",
    "НАИМЕНОВАНИЕ",
    "№ Р. Т.",
    "№ ЭКЗ./ № К.Т.",
    "№  ЭКЗ./ №  К.Т.",
    "№ К.Т.",
    "№ Р.Т.",
    "СТР.",
    "PAGE",
)
# Lines that are dropped when one of these is found.
GARBAGE_PATTERNS = (
    r"^(КД|ДП|РД|РИ|СТ|РГ|ИОТ)-[А-ЯA-Z0-9.\-]+\s*(KD|DP|RD|RI|ST|RG)?-?[A-Z0-9.\-]*$",
    r"^[A-Z][a-z]+.*Manual$",
    r"^[A-Z][a-z]+.*Procedures?$",
    r"^[A-Z][a-z]+.*Program$",
    r"^Page/Страница\s+\d+",
    r"^Стр\.\s*/\s*page\s+\d+",
    r"^\d+-\d+-\d+$",
    r"^Effect\./Дата введ\.\s+\d+\.\d+\.\d+",
    r"^Дата введения",
    r"^Rev\./Ревизия\s+\d+",
    r"^Issue/Издание\s+\d+",
    r"^судов$",
    r"^обслуживанию$",
    r"^техники$",
    r"^экипажами$",
    r"^воздушных перевозок$",
    r"^технического имущества$",
    r"^складского учета авиационно-$",
    r"^\(транспортных средств\)$",
    r"^\{#[a-z0-9\-]+\}$",
    r"^`\s*$",
    r"^Выполняется\s*/\s*Implemented",
    r"^Check list of",
    r"^FORM\s+UT\d+",
    r"^№\s*[–-]\s*[¬_]+",
    r"^Используются формы",
    r"^Вовлеченные подразделения",
    r"^Ответственное подразделение",
    r"^Ссылки на документы",
    r"^Основываясь на",
    r"^Ссылка на РД",
    r"^Ссылка на документ",
    r"^ЛЕТНОЙ ГОДНОСТИ$",
    r"^CONTINUING AIRWORTHINESS$",
    r"^AIRWORTHINESS$",
    r"^ЦУТО$",
    r"^УПЛГ$",
    r"^НЕТ$",
    r"^N/A$",
    r"^Рис\.\s*\d+$",
    r"^Fig\.\s*\d+$",
    r"^REGISTRATION",
    r"^PART NUMBER$",
    r"^СЕРИЙНЫЙ НОМЕР",
    r"^ТИП ВС",
    r"^AIRCRAFT TYPE",
    r"^ЧЕРТЕЖНЫЙ НОМЕР",
    r"^ЦИКЛЫ$",
    r"^until\s+Status",
)
# Sections that are always kept.
IMPORTANT_PATTERNS = (
    r"^\d+\s+(ЦЕЛЬ|ОБЛАСТЬ|НОРМАТИВНЫЕ|ОПРЕДЕЛЕНИЯ|ОБОЗНАЧЕНИЯ|ОБЩИЕ|ОТВЕТСТВЕННОСТЬ)",
    r"^\d+\s+ТРЕБОВАНИЯ ОХРАНЫ ТРУДА",
    r"^\d+\s+ОБЩИЕ ТРЕБОВАНИЯ",
    r"^\d+\s+ПЕРЕЧЕНЬ НОРМАТИВНЫХ",
    r"^ПРЕДИСЛОВИЕ",
    r"^ПЕРЕЧЕНЬ РАССЫЛКИ",
    r"^СОДЕРЖАНИЕ$",
    r"^ОГЛАВЛЕНИЕ$",
    r"^ВВЕДЕНИЕ$",
    r"^ПРИЛОЖЕНИЕ\s+[А-ЯA-Z0-9]",
)
# Unnumbered service sections of a section tree.
SERVICE_SECTIONS = ("ПРЕДИСЛОВИЕ", "ПЕРЕЧЕНЬ РАССЫЛКИ", "СОДЕРЖАНИЕ", "ЛИСТ РЕГИСТРАЦИИ ИЗМЕНЕНИЙ", "ОГЛАВЛЕНИЕ", "ВВЕДЕНИЕ", "АННОТАЦИЯ")
# Lines that a section tree leaves out.
TREE_GARBAGE = r"^Стр\.\s*\d+\s*из\s*\d+|^\d+$|^\.{3,}|^\s*$|^[А-Яа-я]{1,3}$"
# What the Markdown line cleaner drops, tested from the start of the line.
MARKDOWN_GARBAGE = (
    r"Дата введения изменения.*Стр\.\s*\d+\s*из\s*\d+",
    r"Стр\.\s*\d+\s*из\s*\d+",
    r"Дата введения изменения",
    r"Основание:?",
    r"#\s+.*ДП-[А-Яа-я0-9.-]+\s*\{#",
    r"#{1,6}\s*(TIYBIII|AKUI4OHEP|YTBEPx|CI4CTEMA|AII-\d|<<An\s*u|flara|lpr4Ka3oM|reHepanbHofo|Ar\{peKTopa|rlaprepnbre|peficrr|Xanrsr-M|OEIUECTB)",
    r"r\.\s*X[a-z]",
    r"TIYBIII",
    r"AKUI4OHEP",
    r"OEIUECTB\s*O",
    r"#\s+ТЕХНИЧЕСКИЙ\s+ДИРЕКТОРАТ",
    r"[A-Z]{3,}[а-яА-Я]",
    r"[а-яА-Я]+[A-Z]{3,}",
    r"#?\s*[а-яА-Я]{1,3}$",
    r"#?\s*[ных|№]+$",
    r"#?\s*ние$",
    r"#?\s*Измене$",
    r"#\s+[\p{L}\p{N}_.]+@",
    r"#?\s*\(\d+\)\s*\d+",
)
# Words that excuse a line of Latin letters.
LATIN_ALLOWED = (
    r"ДП-|РК|СТО|КД-|РД-|ИОТ-|ISO|IATA|ICAO|DCS|PNL|MVT|LDM|APIS|EASA|FAA|MEL|CDL|SB|AD|AMP|MRB|RVSM|ETOPS|MMEL|MPD|CMM|IPC|AMM|TSM|FIM|WDM|SRM|"
    r"AMOS|SAP|ERP|CRM|SMS|QMS|EFB|OCC|AOC|NOTAM|SIGMET|METAR|TAF|RVR|ILS|VOR|NDB|DME|PIC|SIC|FE|LAE|TRE|TRI|SFI|SFE|"
    r"Boeing|Airbus|ATR|Bombardier|Embraer|B737|B767|A320|CRJ|DHC|UTC|GMT|MSK|@|http|www\."
)
CHANGE_LOG = r"лист регистрации внесения изменений"
MARKDOWN_HEADING = r"^(?:#{1,6}\s+|\d+(?:\.\d+)*\s+)"
# Verbs of sections that ask for an action.
ACTION_WORDS = r"несет ответственность|обязан|должен|выполняет|осуществляет|проводит|обеспечивает|контролирует|согласовывает|утверждает|направляет|представляет|информирует"
# Parts of a running header or footer.
RUNNING_PARTS = ("стр.", "дата введения изменения", "дата введения", "основание", "___")
# Block headings and list marks.
HEADING_PATTERNS = (r"^\d+\.\s+", r"^\d+\.\d+\s+", r"^[A-ZА-Я][A-ZА-Я\s]+$", r"^Глава\s+\d+", r"^Раздел\s+\d+", r"^Приложение\s+[A-ZА-Я\d]")
LIST_ORDERED = r"^\d+\)\s+"
LIST_UNORDERED = r"^(?:[-•·]\s+|[а-я]\)\s+|[ivxlcdm]+\)\s+)"
# References to documents.
REFERENCES = (
    r"(?:ДП|РД|СТ|РГ|КД)-[МБВMB]\d+\.\d+-\d+",
    r"КД-(?:ДП|РД|РГ|СТ)-[МБВMB]\d+\.\d+-\d+",
    r"КД-(?:РГ|СТ)-\d+-\d+",
    r"РК\d+-\d+-\d+",
    r"ИОТ-\d+-\d+",
    r"СТ-\d+-\d+",
    r"(?:TPM|ТРМ)-[A-ZА-Я]+-[A-ZА-Я]+-\d+-\d+",
)
# Dates in running text, and the words beside a date of approval.
DATES = (
    r"(\d{2}[./]\d{2}[./]\d{4})",
    r"(\d{1,2}\s+(?:января|февраля|марта|апреля|мая|июня|июля|августа|сентября|октября|ноября|декабря|янв|фев|мар|апр|май|июн|июл|авг|сен|окт|ноя|дек)\.?\s+\d{4})",
    r"(\d{4}-\d{2}-\d{2})",
)
APPROVAL_WORDS = ("утвержд", "введен в действие", "вступает в силу", "дата введения", "approved", "effective date", "дата утверждения")
TITLES = (
    r"(?:ДП|РД|СТ|РГ|КД|РК|ИОТ)[^\n]+\n+([А-ЯA-Z][^\n]{10,100})",
    r"\n([А-ЯA-Z][А-ЯA-Z\s]{20,100})\n",
    r"(?:название|наименование|title)[:\s]+([^\n]{10,100})",
)
# Legal forms, the longest first, and their abbreviations.
LEGAL_FORMS = (
    ("Общество с дополнительной ответственностью", "ОДО"),
    ("Общество с ограниченной ответственностью", "ООО"),
    ("Государственное унитарное предприятие", "ГУП"),
    ("Муниципальное унитарное предприятие", "МУП"),
    ("Непубличное акционерное общество", "НАО"),
    ("Федеральное казенное предприятие", "ФКП"),
    ("Индивидуальный предприниматель", "ИП"),
    ("Публичное акционерное общество", "ПАО"),
    ("Открытое акционерное общество", "ОАО"),
    ("Закрытое акционерное общество", "ЗАО"),
    ("Производственный кооператив", "ПК"),
    ("Коммандитное товарищество", "КТ"),
    ("Акционерное общество", "АО"),
    ("Полное товарищество", "ПТ"),
    ("Товарищество на вере", "ТНВ"),
)
# Letters of two alphabets that look alike.
LOOKS_LATIN, LOOKS_CYRILLIC = "ABCEHKMOPTXY", "АВСЕНКМОРТХУ"
NAME_LATIN, NAME_CYRILLIC = "ABCEHKMOPTXYaceopxy", "АВСЕНКМОРТХУасеорху"
# Marks that export to plain documents replaces.
EXPORT_MARKS = (("✓", "[+]"), ("✅", "[OK]"), ("❌", "[X]"), ("⚠️", "[!]"), ("→", "->"), ("←", "<-"), ("↑", "^"), ("↓", "v"), ("•", "-"), ("§", "S"), ("№", "N"))
EMOJI = r"[\x{1F1E0}-\x{1F1FF}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F7FF}\x{1F800}-\x{1FAFF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}\x{FE0F}]+"
# A term, a dash and its definition; junk of glossary pages.
TERM = r"(?s)^(.+?)\s+[–—\-]\s+(.+)"
GLOSSARY_JUNK = r"^<!--\s*Страница\s+\d+\s*-->|^Изменение/Revision|^\s*$|^---+$|^\|\s*-+\s*\|"
# Roles and tasks named in texts.
ROLES = "руководитель|специалист|менеджер|ответственный|исполнитель|директор|начальник|инженер"
TASKS = "подготовить|подготовка|согласовать|согласование|проверить|проверка|утвердить|утверждение|создать|создание"


def either(patterns: tuple[str, ...]) -> str:
    """One pattern that finds whatever any of these finds."""
    return "|".join(f"(?:{p})" for p in patterns)


def java(pattern: str) -> str:
    """The pattern for Spark, ignoring case in every script."""
    return "(?iu)" + pattern


def re2(pattern: str) -> str:
    """The pattern for DuckDB, ignoring case in every script."""
    return "(?i)" + pattern
