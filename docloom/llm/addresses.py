"""Address records of one location, whatever way they are written.

An address is read into a bag of tokens: its numbers with their roles (house,
letter, building, flat) and its words (settlement, street, region, district),
all in one reading alphabet for Cyrillic and both Latin transcriptions, rare
spellings corrected by the frequent ones of the corpus.  Linking is numbers
first: records are blocked on the sorted digit tokens plus one rare word; what
else they have in common is the intersection of their word arrays, weighted by
rarity; words of settlement and street that stay unmatched must be a typo apart
with one of them rare.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrow import chunked
from docloom.functions.components import components
from docloom.functions.shared import kept

# Kind words in the reading alphabet (see reading()), by component.
STREET_KINDS = {
    "ул": "ул улица улитса",
    "пер": "пер переулок",
    "пр-д": "пр-д пр-зд проезд",
    "пр-т": "пр-т пр-кт просп проспект",
    "наб": "наб набережная",
    "б-р": "б-р бул булвар бр",
    "пл": "пл плошад",
    "туп": "туп тупик",
    "ш": "ш шоссе",
}
PLACE_KINDS = {"г": "г гор город", "с": "с село", "п": "п пос поселок", "д": "дер деревня", "ст": "ст-ца станица"}
OTHER = {"область": "обл область област", "район": "р-н р-он раион рн", "край": "краи край", "дом": "д дом", "корпус": "к корп корпус стр строение", "лит": "лит литера литер", "флат": "кв кв-ра квартира оф офис пом помешение комн", "страна": "рф россия россиская федерация"}
SIZES = {"большая": "б бол болшая болшои", "малая": "м мал малая малыи малои мали"}
ORDINALS = {"первая": "1", "первыи": "1", "перви": "1", "вторая": "2", "второи": "2", "третя": "3", "третии": "3", "четвертая": "4", "пятая": "5"}

_KIND = {w: ("street", k) for k, ws in STREET_KINDS.items() for w in ws.split()} | {w: ("place", k) for k, ws in PLACE_KINDS.items() for w in ws.split()} | {w: (k, k) for k, ws in OTHER.items() for w in ws.split()}
_SIZE = {w: k for k, ws in SIZES.items() for w in ws.split()}
_LATIN = [("shch", "щ"), ("sch", "щ"), ("zh", "ж"), ("kh", "х"), ("ts", "ц"), ("ch", "ч"), ("sh", "ш"), ("yu", "ю"), ("iu", "ю"), ("ju", "ю"), ("ya", "я"), ("ia", "я"), ("ja", "я"), ("yo", "е"), ("x", "кс")]
_LETTER = str.maketrans("abcdefghijklmnopqrstuvwyz", "абцдефгхийклмнопкрстуввйз")
_FOLD = str.maketrans("ёйыэщ", "еииеш", "ьъ'’`")


def reading(text: str) -> str:
    """Lower case in one alphabet: Latin transcriptions read as Cyrillic, sounds that they merge folded."""
    s = text.lower()
    if re.search("[a-z]", s):
        # a Latin sign inside a Cyrillic word is a look-alike, not a transcription
        s = re.sub("(?<=[а-яё])[aeopcyxkmtbh]|[aeopcyxkmtbh](?=[а-яё])", lambda m: "аеорсухкмтвн"["aeopcyxkmtbh".index(m.group())], s)
        for a, b in _LATIN:
            s = s.replace(a, b)
        s = s.translate(_LETTER)
    return re.sub("ии+", "и", s.translate(_FOLD)).replace("иа", "я")


_QUOTES = re.compile("[\"«»“”„№]")
_POSTAL = re.compile(r"(?<!\d)\d{6}(?!\d)")
_ORDINAL = re.compile(r"(?<![\d-])(\d{1,2})\s*-?\s*(?:ая|яя|я|аия|ия|и|ои|еи|е|ое|иа|иая)(?![а-я])")
_LETTERED = re.compile(r"(?<=\d)\s*(?:-\s*|лит\w*\.?\s*)?([а-ежзклмв])(?![а-я-])(?!\.?\s*\d)")
_LIT = re.compile(r"(?<=\d)\s*,?\s*лит\w*\.?\s*([а-я])(?![а-я])")
_CORP = re.compile(r"(?<![а-я])(?:корпус|корп|стр|к)\.?\s*(\d+)")
_FLAT = re.compile(r"(?<![а-я])(?:(?:пом\.?\s*)?(?:офис|оф)|квартира|кв-ра|кв|пом|комн)\.?\s*(\d+)")
_HOUSE = re.compile(r"(?<![\d-])(\d{1,4})([а-я]?)(?:\s*/\s*(\d+))?(?:\s*-\s*(\d+))?(?![\d])")
_WORD = re.compile(r"[а-я]+(?:-[а-я]+)*")
_ADJECTIVE = re.compile(r"(?:ая|яя|кая|ои|ки|ни|ви|ри|ти|ли|аа|ия|ни)$")

FIELDS = ("postal", "region", "district", "place_kind", "place", "street_kind", "street", "modifier", "house", "corp", "flat")


def parse(address: str) -> dict[str, str | None]:
    """The components of one address; what is not found is None."""
    out: dict[str, str | None] = dict.fromkeys(FIELDS)
    s = reading(_QUOTES.sub("", address))
    m = _POSTAL.search(s)
    if m:
        out["postal"] = m.group()
        s = s[: m.start()] + "," + s[m.end() :]
    s = re.sub(r"\s+", " ", s)
    ordinal = _ORDINAL.search(s)
    mods = []
    if ordinal and not re.search(r"(?:д|дом|кв|оф|к|корп)\.? ?$", s[: ordinal.start()]):
        mods.append(ordinal.group(1))
        s = s[: ordinal.start()] + " " + s[ordinal.end() :]
    s = _LIT.sub(r"\1", s)
    s = _LETTERED.sub(r"\1", s)
    m = _FLAT.search(s)
    if m:
        out["flat"] = m.group(1)
        s = s[: m.start()] + " , " + s[m.end() :]
    m = _CORP.search(s)
    if m:
        out["corp"] = m.group(1)
        s = s[: m.start()] + " , " + s[m.end() :]
    m = _HOUSE.search(s)
    if m:
        out["house"] = m.group(1).lstrip("0") + m.group(2)
        if m.group(3):
            out["corp"] = m.group(3)
        if m.group(4) and not out["flat"]:
            out["flat"] = m.group(4)
        s = s[: m.start()] + " , " + s[m.end() :]
    # segments hold runs of words; a kind word takes a name beside it
    names: list[tuple[int, str]] = []
    kinds: list[tuple[int, str, str]] = []
    at = 0
    for segment in re.split(r"[,;:()]", s):
        at += 2
        for w in _WORD.findall(segment):
            at += 1
            if w in _SIZE and (len(w) > 1 or out["house"]):
                mods.append("б" if _SIZE[w] == "большая" else "м")
                at -= 1
            elif w in ORDINALS:
                mods.append(ORDINALS[w])
                at -= 1
            elif w in _KIND:
                kinds.append((at, *_KIND[w]))
            elif len(w) > 2:
                names.append((at, w))
    out["modifier"] = "".join(sorted(mods)) or None
    where = dict(names)
    takers = [k for k in kinds if k[1] in ("street", "place", "область", "район")]
    streets = [k for k in takers if k[1] == "street"]
    if len(streets) > 1:  # a street named like a kind, as in "ul. Naberezhnaya"
        own = next((k for k in streets if k[2] == "ул"), streets[0])
        other = next(k for k in streets if k is not own)
        beside = [a for a in (own[0] - 1, own[0] + 1) if a in where]
        if not beside or abs(other[0] - own[0]) == 1 and own[2] == "ул":
            where[other[0]] = "набережная" if other[2] == "наб" else other[2]
        takers.remove(other)
    best, score = (), -1.0
    options = [[a for a in (k[0] - 1, k[0] + 1) if a in where] + [None] for k in takers]
    # every kind word has at most three choices; a long text is settled from left to right in groups of six
    if takers:
        for pick in _picks(options):
            used = [p for p in pick if p is not None]
            if len(set(used)) < len(used):
                continue
            fit = 0.0
            for k, p in zip(takers, pick):
                if p is not None:
                    adjective = bool(_ADJECTIVE.search(where[p]))
                    fit += 1 + (0.5 if adjective == (k[1] != "place") else -0.6)
                    if k[1] == "область":
                        fit += 0.3 * where[p].endswith("ская")
                    if k[1] == "район":
                        fit += 0.3 * where[p].endswith("ски")
            if fit > score:
                best, score = pick, fit
    used = set()
    for k, p in zip(takers, best):
        if k[1] == "street":
            out["street_kind"] = k[2]
        if k[1] == "place":
            out["place_kind"] = k[2]
        if p is None:
            continue
        used.add(p)
        out[{"street": "street", "place": "place", "область": "region", "район": "district"}[k[1]]] = where[p]
    left = [(a, w) for a, w in sorted(where.items()) if a not in used]
    for a, w in left:
        adjective = bool(_ADJECTIVE.search(w))
        if not adjective and out["place"] is None:
            out["place"] = w
        elif adjective and out["street"] is None and out["street_kind"]:
            out["street"] = w
        elif out["place"] is None and out["street"] is not None:
            out["place"] = w
        elif out["street"] is None:
            out["street"] = w
    if out["street"]:
        out["street"] = re.sub(r"(?:ая|яя|ои|аа|ия|и)$", "", out["street"]) or out["street"]
    return out


def _picks(options: list[list]) -> Iterator[tuple]:
    """All combinations of the choices, for more than six in groups of which the earlier ones keep their first free choice."""
    if len(options) <= 6:
        yield from product(*options)
        return
    head: list = []
    for o in options[:-6]:
        head.append(next(x for x in o if x is None or x not in head))
    for tail in product(*options[-6:]):
        yield (*head, *tail)


_PARSED = pa.schema([("record_id", pa.int64())] + [(f, pa.string()) for f in FIELDS])


def _read(batch: pa.RecordBatch) -> dict[str, list]:
    out: dict[str, list] = {n: [] for n in _PARSED.names}
    for rec, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        got = parse(text)
        out["record_id"].append(rec)
        for f in FIELDS:
            out[f].append(got[f])
    return out


def parsed(records: DataFrame, id_col: str = "record_id", text_col: str = "address") -> DataFrame:
    """Components of every non-blank address."""
    rows = records.select(F.col(id_col).cast("bigint").alias("record_id"), F.col(text_col).alias("address")).where("address is not null and trim(address) != ''")
    return rows.mapInArrow(chunked(_read, _PARSED), "record_id bigint, " + ", ".join(f"{f} string" for f in FIELDS))


def corrected(words: DataFrame, ratio: int = 8) -> DataFrame:
    """word -> target: a rare word and the one frequent word that is nearest to it.

    ``words`` has word, n and (optional evidence) near, e.g. the region it is
    seen with.  A partner is at most two typos away (one for words under six
    letters), ``ratio`` times as frequent; the nearest wins, then the one with
    equal evidence; a tie leaves the word as it is.  Candidates share one of
    three segments (two typos spoil at most two), so no pair of words without
    common text is compared.
    """
    pieces = (
        words.where("length(word) >= 3")
        .withColumn("third", F.greatest(F.lit(1), F.floor(F.length("word") / 3)).cast("int"))
        .select("word", "n", "near", "third")
    )
    frequent = pieces.where("n >= %d" % ratio).select(
        F.col("word").alias("target"), F.col("n").alias("target_n"), F.col("near").alias("target_near"),
        F.explode(F.array(F.expr("concat('a', substring(word, 1, third))"), F.expr("concat('b', third, substring(word, third + 1, third))"), F.expr("concat('c', substring(word, 2 * third + 1))"))).alias("key"),
    )
    # the rare side offers every window that a segment of a word within two letters of its length can sit at
    windows = F.expr(
        "flatten(array("
        "transform(sequence(greatest(1, int(floor((length(word) - 2) / 3))), int(floor((length(word) + 2) / 3))), t -> concat('a', substring(word, 1, t))),"
        "flatten(transform(sequence(greatest(1, int(floor((length(word) - 2) / 3))), int(floor((length(word) + 2) / 3))), t -> transform(sequence(greatest(1, t - 1), t + 3), p -> concat('b', t, substring(word, p, t))))),"
        "transform(sequence(greatest(1, length(word) - int(floor((length(word) + 2) / 3)) - 2), length(word)), p -> concat('c', substring(word, p)))))"
    )
    rare = pieces.select("word", "n", "near", F.explode(F.array_distinct(windows)).alias("key"))
    close = rare.join(frequent, "key").where("word != target and n * %d <= target_n and abs(length(word) - length(target)) <= 2" % ratio).dropDuplicates(["word", "target"])
    scored = close.withColumn("d", F.levenshtein("word", "target", 2))
    swap = F.expr("length(word) = length(target) and d = 2 and sort_array(split(word, '')) = sort_array(split(target, ''))")
    scored = scored.where(F.expr("d >= 0 and d <= if(length(word) < 6, 1, 2)") | swap)
    order = F.struct((F.when(swap, 1.5).otherwise(F.col("d")) + F.when(F.col("near") == F.col("target_near"), 0).when(F.col("near").isNull() | F.col("target_near").isNull(), 0.25).otherwise(0.5)).alias("cost"))
    best = scored.withColumn("cost", order["cost"])
    top = best.groupBy("word").agg(F.min("cost").alias("least"))
    chosen = best.join(top, "word").where("cost <= least + 0.2").groupBy("word").agg(F.count(F.lit(1)).alias("ways"), F.max_by("target", F.struct("target_n", "target")).alias("target"), F.max("target_n").alias("target_n"), F.sum("target_n").alias("all_n"))
    return chosen.where("ways = 1").select("word", "target")


def _most(df: DataFrame, key: str, value: str) -> DataFrame:
    """key -> the value it is seen with most."""
    return df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n")).groupBy(key).agg(F.max_by(value, F.struct("n", value)).alias(f"{key}_{value}"), F.max("n").alias(f"{key}_n"))


def locations(records: DataFrame, id_col: str = "record_id", text_col: str = "address", least: float = 0.6) -> DataFrame:
    """record_id, location of every record with a non-blank address.

    Equal readings always share a location; others are linked when modifier,
    house, building and flat are equal and the words agree (see ``_accepted``).
    A postal code stands for its settlement, by itself where no record names
    that.  Null and blank addresses have no row; an address of which neither
    street nor house was read stands alone, one without settlement and postal
    code with its equals.
    """
    rows = kept(parsed(records, id_col, text_col))
    by_postal = _most(rows, "postal", "place")
    region = _most(rows, "place", "region")
    places = rows.where("place is not null").groupBy("place").agg(F.count(F.lit(1)).alias("n")).join(region.select("place", F.col("place_region").alias("near")), "place", "left").withColumnRenamed("place", "word")
    streets = rows.where("street is not null").groupBy(F.col("street").alias("word")).agg(F.count(F.lit(1)).alias("n")).withColumn("near", F.lit(None).cast("string"))
    # a settlement that a postal code names outright is as good as a frequent one
    fix_place, fix_street = kept(corrected(places, 4)), corrected(streets, 8)
    named = rows.join(by_postal.select("postal", "postal_place"), "postal", "left").join(fix_place.select(F.col("word").alias("place"), F.col("target").alias("place_fix")), "place", "left").join(fix_street.select(F.col("word").alias("street"), F.col("target").alias("street_fix")), "street", "left")
    fix_post = fix_place.select(F.col("word").alias("postal_place"), F.col("target").alias("post_fix"))
    exact = ("street_kind", "modifier", "house", "corp", "flat")
    forms = named.join(fix_post, "postal_place", "left").select(
        "record_id",
        F.coalesce("post_fix", "postal_place", "place_fix", "place", F.concat(F.lit("postal:"), "postal")).alias("place"),
        F.coalesce("street_fix", "street").alias("street"),
        "region",
        "district",
        *exact,
        F.concat_ws(" ", F.sort_array(F.array_compact(F.array("house", "corp", "flat", F.regexp_extract(F.coalesce("modifier", F.lit("")), r"\d+", 0))))).alias("digits"),
    )
    whole = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in ("place", "street", *exact, "region", "district")])
    forms = kept(forms.withColumn("node", F.when(F.col("place").isNull() & F.col("street").isNull() & F.col("house").isNull(), F.concat_ws("|", F.lit("unread"), "record_id")).otherwise(whole)))
    distinct = kept(forms.where("place is not null and street is not null").select("node", "place", "street", "region", "district", *exact, "digits").distinct())
    # rarity of every word over all records
    words = forms.select(F.explode(F.array_compact(F.array("place", "street", "region", "district"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    total = words.agg(F.sum("n").alias("total"))
    words = kept(words.crossJoin(F.broadcast(total)).select("word", "n", F.log(F.lit(1.0) + F.col("total") / F.col("n")).alias("w")))
    for c in ("place", "street", "region", "district"):
        distinct = distinct.join(words.select(F.col("word").alias(c), F.col("n").alias(f"{c}_n"), F.col("w").alias(f"{c}_w")), c, "left")
    edges = _linked(kept(distinct), least)
    # forms that differ in what need not be written only are one by their equal core
    core = F.concat_ws("|", F.lit("core"), *[F.coalesce(c, F.lit("")) for c in ("place", "street", *exact)])
    same = forms.where("place is not null or street is not null or house is not null").select(F.col("node").alias("a"), core.alias("b")).distinct()
    found = components(edges.union(same), "a", "b")
    return forms.join(found, forms["node"] == found["node"], "left").select("record_id", F.coalesce("component", forms["node"]).alias("location"))


def _linked(forms: DataFrame, least: float) -> DataFrame:
    """Pairs of forms in one block that are accepted.

    A block is the digits with the rarer word, or with one word and two letters
    at either end of the other: a typo spoils one end at most.  Forms without
    digits are blocked on both words.
    """
    rare = F.when(F.coalesce("street_n", F.lit(0)) <= F.coalesce("place_n", F.lit(0)), F.col("street")).otherwise(F.col("place"))
    key = lambda *c: F.concat_ws("|", "digits", *c)
    # a typo makes a word rare, so either word can be the one that is whole
    ends = [key(F.lit(f"{mark}{a[0]}"), a, end(b)) for a, b in (("place", "street"), ("street", "place")) for mark, end in (("h", lambda c: F.substring(c, 1, 2)), ("t", lambda c: F.expr(f"right({c}, 2)")))]
    keys = F.when(F.col("digits") == "", F.array(key("place", "street"))).otherwise(F.array(key(F.lit("r"), rare), *ends))
    side = forms.withColumn("rare", rare).withColumn("block", keys).withColumn("block", F.explode(F.array_distinct("block")))
    cols = [c for c in side.columns if c not in ("block", "digits", "rare")]
    one = lambda n: side.select("block", F.col("digits").alias(f"digits_{n}"), *[F.col(c).alias(f"{c}_{n}") for c in cols])
    pair = one(1).join(one(2), "block").where("node_1 < node_2")
    for c in ("modifier", "house", "corp", "flat"):
        pair = pair.where(F.col(f"{c}_1").eqNullSafe(F.col(f"{c}_2")))
    pair = pair.where("street_kind_1 is null or street_kind_2 is null or street_kind_1 = street_kind_2")
    return pair.where(_accepted(least)).select(F.col("node_1").alias("a"), F.col("node_2").alias("b")).distinct()


def _accepted(least: float) -> Column:
    """Whether the words of two forms agree.

    The rarity-weighted overlap of the token arrays reaches ``least`` of the
    lighter side, and settlement and street of both sides are among the
    other's tokens, but for one each, which are a typo apart and one of them
    rare.
    """
    four = ("place", "street", "region", "district")
    tokens = lambda n: F.array_distinct(F.array_compact(F.array(*[F.col(f"{c}_{n}") for c in four])))
    core = lambda n: F.array(F.col(f"place_{n}"), F.col(f"street_{n}"))
    weight = lambda n: sum((F.coalesce(f"{c}_w_{n}", F.lit(0.0)) for c in four), F.lit(0.0))
    common = F.array_intersect(tokens(1), tokens(2))
    shared = sum((F.when(F.array_contains(common, F.col(f"{c}_1")), F.coalesce(f"{c}_w_1", F.lit(0.0))).otherwise(0.0) for c in four), F.lit(0.0))
    left_1, left_2 = F.array_except(core(1), tokens(2)), F.array_except(core(2), tokens(1))
    x, y = F.get(left_1, F.lit(0)), F.get(left_2, F.lit(0))
    n_x = F.when(x == F.col("place_1"), F.col("place_n_1")).otherwise(F.col("street_n_1"))
    n_y = F.when(y == F.col("place_2"), F.col("place_n_2")).otherwise(F.col("street_n_2"))
    swap = F.sort_array(F.split(x, "")) == F.sort_array(F.split(y, ""))
    d = F.levenshtein(x, y, 2)
    near = d.between(0, 2) & (swap | (d <= F.when(F.least(F.length(x), F.length(y)) < 6, 1).otherwise(2)))
    # rare: a quarter of the other at most, or both seen twice at most
    rare = (F.least(n_x, n_y) * 4 <= F.greatest(F.lit(4), n_x, n_y)) | (F.greatest(n_x, n_y) <= 2)
    typo = (F.size(left_1) == 1) & (F.size(left_2) == 1) & near & rare
    gained = F.when(typo, F.greatest(F.when(x == F.col("place_1"), F.col("place_w_1")).otherwise(F.col("street_w_1")), F.lit(0.0))).otherwise(0.0)
    whole = (F.size(left_1) == 0) & (F.size(left_2) == 0)
    return (whole | typo) & (shared + gained >= F.least(weight(1), weight(2)) * least)


def pairs(members: DataFrame, member: str, group: str) -> DataFrame:
    """record_a < record_b of every two members of one group."""
    a, b = members.select(F.col(member).alias("record_a"), group).distinct(), members.select(F.col(member).alias("record_b"), group).distinct()
    return a.join(b, group).where("record_a < record_b").select("record_a", "record_b")
