"""Variant spellings of persons and organisations, linked by metric-space partitioning.

A name is read into parts: a person into surname, first name and patronymic
(each full, an initial or missing), an organisation into its head word, its
further words and its number.  The parts that a dictionary settles span a
discrete metric, the surname or head word an edit metric; their sum is a true
metric.  Names are assigned to pivots of that space, names near a cell's border
are replicated by the triangle inequality, and inside each cell an exact radius
join with the edit metric finds all pairs.  Abbreviated names then join the one
full name that they can stand for.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrow import chunked
from docloom.functions.components import components
from docloom.functions.shared import kept
from docloom.llm.addresses import reading

# Given names with their short forms; a name that both sexes bear stands once.
GIVEN = """Александр Александра Саша Шура Саня
Алексей Леша Алеша
Анатолий Толя
Андрей Андрюша
Антон Тоша
Артем Тема
Борис Боря
Вадим Вадик
Валентин Валентина Валя
Валерий Валерия Валера
Василий Вася
Виктор Виктория Витя Вика
Виталий Виталик
Владимир Вова Володя
Вячеслав Слава
Геннадий Гена
Георгий Жора
Григорий Гриша
Даниил Данил Даня
Денис Дениска
Дмитрий Дима Митя
Евгений Евгения Женя
Егор Егорка
Захар Захарка
Иван Ваня
Игорь Игорек
Илья Илюша
Кирилл Кирюша
Константин Костя
Лев Лева
Леонид Леня
Максим Макс
Матвей Мотя
Михаил Миша
Никита Никитка
Николай Коля
Олег Олежка
Павел Паша
Петр Петя
Роман Рома
Семен Сема Сеня
Сергей Сережа
Степан Степа
Тимофей Тима Тимоша
Тимур Тимурка
Федор Федя
Юрий Юра
Яков Яша
Алла Аллочка
Анастасия Настя
Анна Аня
Вера Верочка
Галина Галя
Дарья Даша
Екатерина Катя
Елена Лена
Елизавета Лиза
Зинаида Зина
Зоя Зоенька
Ирина Ира
Ксения Ксюша
Лариса Лара
Лидия Лида
Любовь Люба
Людмила Люда Мила
Маргарита Рита
Марина Мариша
Мария Маша
Надежда Надя
Наталья Наталия Наташа
Нина Ниночка
Оксана Ксана
Ольга Оля
Полина Поля
Раиса Рая
Светлана Света
Софья София Соня
Тамара Тома
Татьяна Таня
Ульяна Уля
Фаина Фая
Юлия Юля
Яна Яночка"""
# The stems that patronymics are made of.
FATHERS = """Александр Алексе Анатоль Андре Антон Артем Борис Вадим Валентин Валерь Василь Виктор Виталь Владимир Вячеслав Геннадь Георги Григорь Дани Данил Денис Дмитри Евгень Егор Захар Иван Игор Кирилл Константин Леонид Льв Максим Матве Михайл Никола Олег Павл Петр Роман Семен Серге Степан Тимофе Тимур Федор Юрь Яковл"""
# Legal forms and the words that are not part of a name.
FORMS = """ооо оао пао зао нао ао нпп ип тоо гуп муп фгуп
общество с ограниченной ответственностью
непубличное публичное открытое закрытое акционерное общество
индивидуальный предприниматель"""

_SOFT = ("е", "ь", "и", "а")


def _readings() -> tuple[dict[str, str], dict[str, tuple[str, str]]]:
    given: dict[str, str] = {}
    for line in GIVEN.splitlines():
        names = [reading(n) for n in line.split()]
        for n in names:
            given.setdefault(n, names[0])
    fathers: dict[str, tuple[str, str]] = {}
    for stem in FATHERS.split():
        soft = stem[-1] in "еьиа" or stem == "Яковл"
        for end, sex in ((("евич" if soft else "ович"), "m"), (("евна" if soft else "овна"), "f")):
            fathers[reading(stem + end)] = (reading(stem), sex)
    for word, stem, sex in (("Ильич", "иль", "m"), ("Ильинична", "иль", "f"), ("Никитич", "никит", "m"), ("Никитична", "никит", "f"), ("Лукич", "лук", "m"), ("Лукинична", "лук", "f")):
        fathers[reading(word)] = (reading(stem), sex)
    return given, fathers


_GIVEN, _FATHERS = _readings()
_FORM_WORDS = frozenset(reading(w) for w in FORMS.split())
_NOISE = re.compile(r"\([^)]*\)?|\bд\.\s*у\.?|\bв лице директора\b|\bd\.\s*u\.?(?!\w)", re.I)
_TOKEN = re.compile(r"[а-я]+|\d+")
# Endings of patronymics in the reading alphabet.
_PATRONYMIC = re.compile(r"(?<=..)(?:ович|евич|овна|евна|инична|улы|кызы)$")


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions, most + 1 when it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    before2: list[int] = []
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before2[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        before2, before = before, row
    return before[-1]


@lru_cache(200_000)
def _nearest(word: str, which: str) -> tuple[str | None, int]:
    """The dictionary word nearest to a word and its distance, None past one (long words: two) typos; a tie of two given names is None."""
    words = _GIVEN if which == "given" else _FATHERS
    if word in words:
        return word, 0
    most = 2 if len(word) >= 7 else 1 if len(word) >= 4 else 0
    best, least, tie = None, most + 1, False
    for w in words:
        d = distance(word, w, most)
        if d < least:
            best, least, tie = w, d, False
        elif d == least and d <= most and best is not None:
            tie = tie or (words[w] != words[best])
    return (None, 9) if best is None or tie and which == "given" else (best, least)


PARTS = ("kind", "head", "given", "given_initial", "father", "father_initial", "sex", "tail", "number")


def read_name(name: str) -> dict[str, str | None] | None:
    """The parts of one name; None where no word is left."""
    out: dict[str, str | None] = dict.fromkeys(PARTS)
    quoted = bool(re.search("[«»“”„\"'‘’]", name))
    text = _NOISE.sub(" ", name)
    words = []
    for w in re.findall(r"\w+", text):
        if re.search("[а-яё]", w, re.I) and re.search("[a-z]", w, re.I):
            w = w.lower().translate(str.maketrans("aeopcyxkmtbh", "аеорсухкмтвн"))
        words.append(w)
    words = _TOKEN.findall(reading(" ".join(words)))
    legal = any(w in _FORM_WORDS for w in words if w != "с")
    rest = [w for w in words if w not in _FORM_WORDS or w == "с"]
    if legal:
        rest = [w for w in rest if w != "с"] if "ограниченнои" in words or any(distance(w, "ответственностю", 2) <= 2 for w in words) else rest
    if not rest:
        return None
    initials = [w for w in rest if len(w) == 1 and not w.isdigit()]
    long = [w for w in rest if len(w) > 1 and not w.isdigit()]
    if not legal and not quoted and not any(w.isdigit() for w in rest) and 1 <= len(long) <= 3 and len(rest) <= 4:
        best = None
        for order in permutations(range(len(long))):
            s, more = long[order[0]], [long[k] for k in order[1:]]
            g = f = None
            cost = 0.0
            if more:
                g, d = _nearest(more[0], "given")
                cost += d
                if g is None:
                    continue
            if len(more) > 1:
                f, d = _nearest(more[1], "father")
                cost += d
                if f is None:
                    continue
            if len(more) + len(initials) == 0 or len(more) + len(initials) > 2:
                continue
            # the usual orders: surname first, or surname last; a surname is no given name
            cost += 0.5 * (s in _GIVEN) + 0.1 * (order[0] not in (0, len(long) - 1))
            if best is None or cost < best[0]:
                best = (cost, s, g, f)
        if best is not None:
            _, s, g, f = best
            out["kind"], out["head"] = "P", s
            inits = list(initials)
            if g:
                out["given"] = _GIVEN[g]
                out["given_initial"] = out["given"][0]
            elif inits:
                out["given_initial"] = inits.pop(0)
            if f:
                out["father"], out["sex"] = _FATHERS[f]
                out["father_initial"] = out["father"][0]
            elif inits:
                out["father_initial"] = inits.pop(0)
            return out
        marked = [k for k, w in enumerate(long) if _PATRONYMIC.search(w)]
        if best is None and len(long) == 3 and not initials and len(marked) == 1 and marked[0] > 0:
            # names that no list has: the word before the patronymic is the given name
            k = marked[0]
            out["kind"], out["head"], out["given"] = "P", next(w for n, w in enumerate(long) if n not in (k - 1, k)), long[k - 1]
            out["father"], out["sex"] = _PATRONYMIC.sub("", long[k]), "f" if long[k].endswith(("на", "кызы")) else "m"
            out["given_initial"], out["father_initial"] = out["given"][0], out["father"][0]
            return out
    out["kind"] = "O"
    out["number"] = "".join(w for w in rest if w.isdigit()) or ""
    letters = [w for w in rest if not w.isdigit()]
    out["head"] = letters[0] if letters else ""
    out["tail"] = " ".join(letters[1:])
    return out


_PARSED = pa.schema([("record_id", pa.int64())] + [(p, pa.string()) for p in PARTS])


def _read(batch: pa.RecordBatch) -> dict[str, list]:
    out: dict[str, list] = {n: [] for n in _PARSED.names}
    for rec, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        got = read_name(name)
        if got is not None:
            out["record_id"].append(rec)
            for p in PARTS:
                out[p].append(got[p])
    return out


def cells(objects: DataFrame, radius: int = 2, size: int = 64) -> DataFrame:
    """grp, pivot, word, far, at_home: the cells of the metric space of every group that each word lies in.

    A group of n words has about sqrt(n) * 16 / ``size`` pivots, chosen by hash,
    and its least word; so distances to pivots stay below n * sqrt(n).  A word's
    home is the cell of its nearest pivot; it is replicated to every pivot no
    further than its home distance plus twice the radius, the bound that the
    triangle inequality gives: two words within the radius meet in the home
    cell of either.
    """
    objects = objects.select("grp", "word").distinct()
    sizes = objects.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("word").alias("least"))
    every = F.greatest(F.lit(1), (F.sqrt("n") * size / 16).cast("bigint"))
    ranked = objects.join(sizes, "grp")
    pivots = ranked.where((F.col("word") == F.col("least")) | ((F.col("n") > size) & (F.pmod(F.xxhash64("word"), every) == 0))).select("grp", F.col("word").alias("pivot"))
    reach = objects.join(pivots, "grp").withColumn("far", F.levenshtein("word", "pivot"))
    home = reach.groupBy("grp", "word").agg(F.min(F.struct("far", "pivot")).alias("h"))
    return reach.join(home, ["grp", "word"]).where(F.col("far") <= F.col("h.far") + 2 * radius).select("grp", "pivot", "word", "far", (F.col("pivot") == F.col("h.pivot")).alias("at_home"))


def radius_pairs(objects: DataFrame, radius: int = 2) -> DataFrame:
    """grp, word_1 < word_2, d: all pairs of one group within an edit distance.

    ``objects`` has (grp, word); the group is the discrete part of the metric.
    In a cell home words meet all words whose distance to the pivot, and whose
    length, differs by the radius at most (the triangle inequality again, with
    the pivot and with the empty word); what is left is compared by the edit
    distance itself, so no pair is lost and none is approximate.
    """
    found = kept(cells(objects, radius))
    a = found.where("at_home").select("grp", "pivot", F.col("word").alias("word_1"), F.col("far").alias("far_1"))
    b = found.select("grp", "pivot", F.col("word").alias("word_2"), F.col("far").alias("far_2"))
    near = a.join(b, ["grp", "pivot"]).where((F.col("word_1") != F.col("word_2")) & (F.abs(F.col("far_1") - F.col("far_2")) <= radius) & (F.abs(F.length("word_1") - F.length("word_2")) <= radius))
    near = near.withColumn("d", F.levenshtein("word_1", "word_2", radius)).where("d >= 0")
    return near.select("grp", F.least("word_1", "word_2").alias("word_1"), F.greatest("word_1", "word_2").alias("word_2"), "d").distinct()


def _same_word(least: int = 7, either_sex: bool = True) -> str:
    """Typos of one word, not another name: two edits need a long word or a swap; where the sex is open, a feminine ending is another person's."""
    swap = "(length(word_1) = length(word_2) and sort_array(split(word_1, '')) = sort_array(split(word_2, '')))"
    sexes = "(word_1 = concat(word_2, 'а') or word_2 = concat(word_1, 'а') or (right(word_1, 2) = 'ая' and right(word_2, 1) = 'и') or (right(word_2, 2) = 'ая' and right(word_1, 1) = 'и'))"
    if not either_sex:
        sexes = "false"
    return f"(d <= 1 or {swap} or (d = 2 and length(word_1) >= {least} and length(word_2) >= {least})) and not {sexes}"


_MOST = 0.7
_RARE = "least(n_1, n_2) * 3 <= greatest(n_1, n_2, 6)"


def _tails(orgs: DataFrame, share: float = 0.004, least: int = 3) -> list[str]:
    """Words that follow many heads; a word must hold a share of all of them, so at most 1 / share reach the driver."""
    words = orgs.select(F.explode(F.split("tail", " ")).alias("w")).where("length(w) >= 3").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    total = words.agg(F.sum("n").alias("total"))
    return sorted(r[0] for r in words.join(F.broadcast(total)).where((F.col("n") >= F.col("total") * share) & (F.col("n") >= least)).select("w").collect())


def split_tails(glued: str, tails: list[str]) -> tuple[str, str]:
    """(head, tails) of an organisation's letters without blanks; a tail may have one typo."""
    found: list[str] = []
    while True:
        best = None
        for t in tails:
            for n, most in ((len(t), 0), (len(t), 1), (len(t) - 1, 1), (len(t) + 1, 1)):
                if len(glued) - n < 3 or most and len(t) < 4:
                    continue
                d = distance(glued[-n:], t, most)
                if d <= most and (best is None or (d, -n) < best[:2]):
                    best = (d, -n, t)
        if best is None:
            return glued, " ".join(reversed(found))
        found.append(best[2])
        glued = glued[: best[1]]


def owners(records: DataFrame, id_col: str = "record_id", name_col: str = "full_name", radius: int = 2) -> DataFrame:
    """record_id, owner of every record with a name.

    Equal readings always share an owner.  Persons with equal given name and
    patronymic (as a dictionary reads them) are one when their surnames are
    typos of each other; an abbreviated name joins the only full name that fits
    it, is left alone when several fit, and joins its equals when none does.
    Organisations need equal further words and numbers, and head words that are
    typos of each other.  Null and blank names have no row.
    """
    rows = records.select(F.col(id_col).cast("bigint").alias("record_id"), F.col(name_col).alias("name")).where("name is not null and trim(name) != ''")
    names = kept(rows.mapInArrow(chunked(_read, _PARSED), "record_id bigint, " + ", ".join(f"{p} string" for p in PARTS)))
    people, orgs = names.where("kind = 'P'"), names.where("kind = 'O'")
    tails = _tails(orgs)

    def cut(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in _ORG.names}
        for rec, head, tail, number in zip(*[c.to_pylist() for c in batch.columns]):
            h, t = split_tails(head + tail.replace(" ", ""), tails)
            out["record_id"].append(rec)
            out["grp"].append(f"O|{t}|{number}")
            out["word"].append(h)
        return out

    firms = orgs.select("record_id", "head", "tail", "number").mapInArrow(chunked(cut, _ORG), "record_id bigint, grp string, word string")
    whole = people.where("given is not null and father is not null").select("record_id", F.concat_ws("|", F.lit("P"), "given", "father", "sex").alias("grp"), F.col("head").alias("word"))
    members = kept(whole.union(firms))
    sur = kept(people.select("record_id", F.col("head").alias("word"), "given", "given_initial", "father", "father_initial"))
    first = sur.where("given is not null and father is null and father_initial is not null")
    only = sur.where("given is not null and father_initial is null")
    initials = sur.where("given is null")
    b_group, c_group = F.concat_ws("|", F.lit("B"), "given", "father_initial"), F.concat_ws("|", F.lit("C"), "given")
    d_group = lambda i: F.concat_ws("|", F.lit("D"), "given_initial", i)
    short_b = first.select("record_id", b_group.alias("grp"), "word")
    short_c = only.select("record_id", c_group.alias("grp"), "word").union(initials.select("record_id", d_group(F.coalesce("father_initial", F.lit("?"))).alias("grp"), "word"))
    # one radius join serves all steps: the forms themselves, and the fuller forms that abbreviated ones can stand for
    full_forms, b_forms = sur.where("given is not null and father is not null"), first
    targets = full_forms.select(b_group.alias("grp"), "word")
    for forms in (full_forms, b_forms):
        for g in (c_group, d_group(F.col("father_initial")), d_group(F.lit("?"))):
            targets = targets.union(forms.select(g.alias("grp"), "word"))
    shorts = short_b.select("grp", "word").union(short_c.select("grp", "word")).distinct()
    wanted = targets.distinct().join(shorts.select("grp").distinct(), "grp", "left_semi")
    near = kept(radius_pairs(members.select("grp", "word").union(shorts).union(wanted), radius))
    full = kept(_clusters(members, near))
    # abbreviated persons, the fuller forms first
    parts = ("owner", "word", "given", "given_initial", "father_initial")
    known = full.join(sur.select("record_id", "given", "given_initial", "father_initial"), "record_id").groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))
    found_b = _joined(short_b, known.select("owner", b_group.alias("grp"), "word", "n"), near)
    more = found_b.where("new").join(first.select("record_id", "given", "given_initial", "father_initial"), "record_id").groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))
    known = kept(known.union(more))
    hits = known.select("owner", c_group.alias("grp"), "word", "n")
    for initial in (F.col("father_initial"), F.lit("?")):
        hits = hits.union(known.select("owner", d_group(initial).alias("grp"), "word", "n"))
    found_c = _joined(short_c, hits, near)
    return full.select("record_id", "owner").union(found_b.select("record_id", "owner")).union(found_c.select("record_id", "owner"))


_ORG = pa.schema([("record_id", pa.int64()), ("grp", pa.string()), ("word", pa.string())])


def _clusters(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """record_id, word, owner: members of one group whose words are typos of each other."""
    counts = kept(members.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    near = pairs.where("grp like 'P|%' or grp like 'O|%'").where(_same_word(7, False))
    near = near.join(counts.select(F.col("word").alias("word_1"), F.col("n").alias("n_1")), "word_1").join(counts.select(F.col("word").alias("word_2"), F.col("n").alias("n_2")), "word_2").where(_RARE)
    edges = near.select(F.concat_ws("/", "grp", "word_1").alias("a"), F.concat_ws("/", "grp", "word_2").alias("b"))
    node = members.withColumn("node", F.concat_ws("/", "grp", "word"))
    return node.join(components(edges), "node", "left").select("record_id", "word", F.coalesce("component", "node").alias("owner"))


def _joined(short: DataFrame, known: DataFrame, pairs: DataFrame) -> DataFrame:
    """record_id, word, owner, new: abbreviated names with the one owner that they fit best.

    Several owners fit equally well at times; one that holds most of their
    records (``_MOST``) is taken, else the name stays alone.
    """
    short = kept(short)
    known = kept(known.groupBy("owner", "grp", "word").agg(F.sum("n").alias("n")))
    forms = kept(short.select("grp", "word").distinct())
    near = pairs.join(forms.select("grp").distinct(), "grp", "left_semi").where(_same_word(8))
    cost = F.when(F.expr("d = 2 and sort_array(split(word_1, '')) = sort_array(split(word_2, ''))"), 1).otherwise(F.col("d"))
    near = near.withColumn("d", cost)
    ways = near.select("grp", F.col("word_1").alias("word"), F.col("word_2").alias("other"), "d").union(near.select("grp", F.col("word_2").alias("word"), F.col("word_1").alias("other"), "d")).union(forms.select("grp", "word", F.col("word").alias("other"), F.lit(0).alias("d")))
    ways = kept(ways.join(forms, ["grp", "word"], "left_semi"))
    fits = ways.join(known.select("grp", F.col("word").alias("other"), F.col("owner").alias("hit"), "n"), ["grp", "other"])
    least = fits.groupBy("grp", "word").agg(F.min("d").alias("least"))
    each = fits.join(least, ["grp", "word"]).where("d = least").groupBy("grp", "word", "hit").agg(F.sum("n").alias("n"))
    best = each.groupBy("grp", "word").agg(F.max(F.struct("n", "hit")).alias("top"), F.sum("n").alias("all"))
    best = kept(best.select("grp", "word", F.col("top.hit").alias("hit"), (F.col("top.n") >= F.col("all") * _MOST).alias("sure")))
    # without a full name, abbreviated names join their equals and all that near ones link them to
    alone = forms.join(best, ["grp", "word"], "left_anti")
    alone = kept(alone)
    near = ways.where("d <= 1 and word != other").join(alone, ["grp", "word"], "left_semi").join(alone.withColumnRenamed("word", "other"), ["grp", "other"], "left_semi")
    linked = components(near.select(F.concat_ws("/", "grp", "word").alias("a"), F.concat_ws("/", "grp", "other").alias("b")))
    own = alone.withColumn("own", F.concat_ws("/", "grp", "word"))
    rest = own.join(linked, own["own"] == linked["node"], "left").select("grp", "word", F.coalesce("component", "own").alias("node"))
    node = short.join(best, ["grp", "word"], "left").join(rest, ["grp", "word"], "left")
    owner = F.when(F.col("hit").isNull(), F.col("node")).when(F.col("sure"), F.col("hit")).otherwise(F.concat_ws("/", F.lit("alone"), "record_id"))
    return kept(node.select("record_id", "word", owner.alias("owner"), F.col("hit").isNull().alias("new")))
