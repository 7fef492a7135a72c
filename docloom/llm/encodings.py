"""Texts that were decoded with a wrong character encoding.

A garbled text went through a chain of (written in, A read as B) steps, or lost
signs.  The chain is a latent variable of every record; its prior is shared by
all records of one source and field.  Expectation-maximization alternates
between the posterior of each record's chain and the pooled parameters: chain
priors per group, and a character model of the words as the posteriors say they
were written.

Words carry the evidence, so the texts are reduced to their distinct words
first.  Each is read under every chain once; the readings that the first model
does not rule out are kept, a table as small as the suspicious words.  A
reading gains by the character model and by the corpus: a garbled form is rarer
than what it stands for, so a frequent word is no garbling of a rarer one.
Posteriors are sums over a record's words, joined and aggregated in SQL.
"""

from __future__ import annotations

import math
from array import array
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrow import chunked
from docloom.functions.shared import kept

#: Buckets of each of the three tables of the character model: runs of three signs, of two, and contexts.
BUCKETS = 1 << 20

# Encodings that texts are written in, and that they are wrongly read as.
CYRILLIC = ("cp1251", "koi8-r", "cp866", "mac_cyrillic", "iso8859-5")
LATIN = ("cp1252", "cp850", "cp437", "mac_roman", "cp1250", "iso8859-2")
READ_AS = ("cp1251", "cp1252", "latin-1", "koi8-r", "cp866", "mac_cyrillic", "cp437", "cp850", "iso8859-5", "mac_roman", "cp1250")


@lru_cache(None)
def _table(codec: str) -> tuple[dict[str, int], list[str]]:
    """Sign -> byte and byte -> sign; bytes the codec leaves out stand for the control sign of their number."""
    to, back = {}, []
    for b in range(256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        to.setdefault(c, b)
        back.append(c)
    return to, back


def _bytes(text: str, codec: str) -> bytes | None:
    to = _table(codec)[0]
    try:
        return bytes([to[c] for c in text])
    except KeyError:
        return None


def steps() -> list[tuple[str, str]]:
    """(written in, read as) of single steps."""
    out = [("utf-8", b) for b in READ_AS]
    out += [(a, b) for a in CYRILLIC for b in READ_AS if a != b and b not in ("mac_roman", "cp1250")]
    return out + [(a, b) for a in LATIN for b in ("cp1251", "cp1252", "cp437", "cp850", "cp866", "koi8-r", "latin-1", "mac_roman") if a != b]


def _undo(text: str, step: tuple[str, str]) -> str | None:
    raw = _bytes(text, step[1])
    if raw is None:
        return None
    if step[0] == "utf-8":
        try:
            got = raw.decode("utf-8")
        except UnicodeDecodeError:
            return None
        return None if got == text else got
    back = _table(step[0])[1]
    got = "".join([back[b] for b in raw])
    return None if got == text or any("\x7f" <= c <= "\x9f" or "─" <= c <= "╿" for c in got) else got


@lru_cache(200_000)
def readings(word: str) -> tuple[tuple[str, str], ...]:
    """(chain, original) of every chain that can have made this word; UTF-8 steps may repeat."""
    if word.isascii():
        return ()
    out: dict[str, str] = {}
    front = [("", word)]
    # a UTF-8 step shortens the text, so the repetition ends by itself
    while front:
        nxt = []
        for chain, text in front:
            for a, b in _STEPS:
                got = _undo(text, (a, b))
                if got is None:
                    continue
                name = f"{a}>{b}" + (f"+{chain}" if chain else "")
                out.setdefault(name, got)
                if a == "utf-8" and not got.isascii():
                    nxt.append((name, got))
        front = nxt
    return tuple(out.items())


_STEPS = steps()
# Signs and runs of garbled text; texts without them teach the first model.
INIT_BAD = "(?U)[\\x7f-\\x9f\\x{fffd}\\x{2502}-\\x{257f}]|[a-zß-ÿа-яё][A-ZÀ-ÞА-ЯЁ]|[ÃÂÐÑÕÔ][^a-zA-ZÀ-ÖØ-ö\\s]|[РСГТ][^а-яёА-ЯЁ\\s.,»\")]|\\w[‚„“”†‡‰‹›€¢£¤¥¦§¨©ª«¬®°±²³´µ¶·¸¹º»¼½¾¿]\\w|[À-ÿ]{4}"
REPLACED = "\\x{fffd}"
QUERIED = r"(?U)[\p{L}]\?+[\p{L}]|(?:^|\s)[«\"(]?\?{2,}[»\")]?(?=\s|$)|(?:^|\s)[«\"(]?\?+[\p{L}]|\?[ -]\?"
LOST = "lost"


def grams(word: str) -> list[tuple[int, int, int]]:
    """Buckets of the run of three, of its context and of the run of two, for every sign and the end."""
    codes = [1, 2, *map(ord, word), 3]
    mask = BUCKETS - 1
    out = []
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        two = (b * 8191 + c * 131071 + 17) & mask
        out.append(((a * 92821 + b * 68917 + c * 31337 + (a ^ c) * 7 + 5) & mask, (a * 52711 + b * 28657 + 11) & mask, two))
    return out


class Model:
    """Character model of single words in three hashed tables of fixed size."""

    def __init__(self, three: array, context: array, two: array) -> None:
        self.three, self.context, self.two = three, context, two
        self.total = max(sum(two), 1.0)

    @lru_cache(100_000)
    def score(self, word: str) -> float:
        """Log probability of a word."""
        t, c, b, n = self.three, self.context, self.two, self.total
        return sum(math.log(0.8 * t[x] / (c[y] + 4) + 0.15 * b[z] / n + 1e-6) for x, y, z in grams(word))


_GRAMS = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("weight", pa.float64())])


def _count(batches):
    tables: list[dict[int, float]] = [{}, {}, {}]
    for batch in batches:
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for found in grams(word):
                for t, x in zip(tables, found):
                    t[x] = t.get(x, 0.0) + n
    for kind, t in enumerate(tables):
        rows = list(t.items())
        for at in range(0, len(rows), 10_000):
            part = rows[at : at + 10_000]
            yield pa.RecordBatch.from_pydict({"kind": [kind] * len(part), "bucket": [x for x, _ in part], "weight": [w for _, w in part]}, schema=_GRAMS)


def model(weights: DataFrame) -> Model:
    """The model of (word, weight); at most three times BUCKETS rows reach the driver."""
    got = weights.where("weight > 0").mapInArrow(_count, "kind int, bucket int, weight double").groupBy("kind", "bucket").agg(F.sum("weight").alias("weight")).toArrow()
    tables = [array("f", bytes(4 * BUCKETS)) for _ in range(3)]
    for kind, bucket, weight in zip(*[got.column(c).to_pylist() for c in ("kind", "bucket", "weight")]):
        tables[kind][bucket] = weight
    return Model(*tables)


_READ = pa.schema([("word", pa.string()), ("chain", pa.string()), ("restored", pa.string()), ("gain", pa.float64())])


def _readings(words: DataFrame, shared, least: float) -> DataFrame:
    """word, chain, restored, gain of the readings that gain at least ``least``."""

    def one(batch: pa.RecordBatch) -> dict[str, list]:
        m, out = shared.value, {n: [] for n in _READ.names}
        for word in batch.column(0).to_pylist():
            own = m.score(word)
            for chain, got in readings(word):
                gain = m.score(got) - own
                if gain > least:
                    for n, v in zip(_READ.names, (word, chain, got, gain)):
                        out[n].append(v)
        return out

    return words.select("word").mapInArrow(chunked(one, _READ), "word string, chain string, restored string, gain double")


def _rescored(found: DataFrame, shared) -> DataFrame:
    def one(batch: pa.RecordBatch) -> dict[str, list]:
        m = shared.value
        w, c, r = (batch.column(k).to_pylist() for k in range(3))
        return {"word": w, "chain": c, "restored": r, "gain": [m.score(y) - m.score(x) for x, y in zip(w, r)]}

    return found.select("word", "chain", "restored").mapInArrow(chunked(one, _READ), "word string, chain string, restored string, gain double")


def _lost(text: Column) -> Column:
    """Evidence of lost signs, in log odds; null without any."""
    return F.when(text.rlike(REPLACED), 14.0).when(text.rlike(QUERIED), 9.0)


def repaired(records: DataFrame, rounds: int = 3, least: float = 0.5, switch: float = 2.0) -> DataFrame:
    """Garbled records of (src, rec_id, grp, text): chain, posterior, whether signs were lost, and the original text.

    ``grp`` names source and field, the unit that pools chain evidence.  A
    record counts as garbled when the posterior of all chains together, lost
    signs among them, reaches ``least``; where signs were lost ``original`` is
    null.  Null, blank and ASCII texts without lost signs give no row; ties
    between chains go to the earlier name; repeated rows count once; an empty
    table gives no row.
    """
    spark = records.sparkSession
    texts = kept(records.where("text is not null and trim(text) != ''").select("src", F.col("rec_id").cast("bigint").alias("rec_id"), "grp", "text").distinct())
    tokens = texts.select("src", "rec_id", "grp", F.col("text").rlike(INIT_BAD).alias("bad"), F.posexplode(F.split("text", " ")).alias("pos", "word")).where("word != ''")
    words = kept(tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("bad")).alias("n_clean")))
    own = words.select(F.col("word").alias("restored"), F.col("n_clean").alias("n_restored"))
    seen = words.select("word", "n")
    first = model(words.select("word", F.col("n_clean").cast("double").alias("weight")))
    shared = spark.sparkContext.broadcast(first)
    found = kept(_readings(words.where(F.col("word").rlike(r"[^\x00-\x7f]")), shared, -2.0))
    groups = texts.groupBy("grp").agg(F.count(F.lit(1)).alias("total"))
    priors = None
    gains = found
    for n in range(rounds):
        # a reading is also judged by how often either form occurs
        frequency = F.greatest(F.lit(-8.0), F.least(F.lit(3.0), F.log((F.coalesce("n_restored", F.lit(0)) + 1) / (F.col("n") + 1))))
        # one reading per word and chain; only those that pay stay, so words written right drop out here
        judged = kept(gains.join(seen, "word").join(own, "restored", "left").withColumn("gain", F.col("gain") + frequency).where("gain > 0").select("word", "chain", "restored", "gain"))
        hits = tokens.join(judged, "word").select("src", "rec_id", "grp", "pos", "word", "chain", "restored", "gain")
        sums = hits.groupBy("src", "rec_id", "grp", "chain").agg((F.sum("gain") - switch).alias("evidence"))
        lost = texts.select("src", "rec_id", "grp", F.lit(LOST).alias("chain"), (_lost(F.col("text")) - switch).alias("evidence")).where("evidence is not null")
        sums = sums.unionByName(lost)
        if priors is None:
            weighted = sums.withColumn("log", F.col("evidence") + math.log(0.1 / len(_STEPS))).withColumn("clean", F.lit(math.log(0.9)))
        else:
            clean = priors.where("chain = ''").select("grp", F.log("prior").alias("clean"))
            weighted = sums.join(F.broadcast(priors), ["grp", "chain"], "left").join(F.broadcast(clean), "grp", "left")
            weighted = weighted.withColumns({"log": F.col("evidence") + F.log(F.coalesce("prior", F.lit(1e-5))), "clean": F.coalesce("clean", F.lit(math.log(0.9)))})
        # log-sum-exp per record, in two aggregates without a window
        top = weighted.groupBy("src", "rec_id").agg(F.greatest(F.max("log"), F.first("clean")).alias("top"))
        each = weighted.join(top, ["src", "rec_id"]).withColumn("e", F.exp(F.col("log") - F.col("top")))
        norm = each.groupBy("src", "rec_id").agg((F.sum("e") + F.exp(F.first("clean") - F.first("top"))).alias("norm"))
        posterior = kept(each.join(norm, ["src", "rec_id"]).select("src", "rec_id", "grp", "chain", (F.col("e") / F.col("norm")).alias("p")))
        if n == rounds - 1:
            break
        # M-step: priors of each group; at most groups x chains rows
        chains = posterior.groupBy("grp", "chain").agg(F.sum("p").alias("w")).join(groups, "grp").select("grp", "chain", ((F.col("w") + 0.01) / (F.col("total") + 1)).alias("prior"))
        rest = posterior.groupBy("grp").agg(F.sum("p").alias("w")).join(groups, "grp").select("grp", F.lit("").alias("chain"), ((F.col("total") - F.col("w") + 1) / (F.col("total") + 2)).alias("prior"))
        priors = kept(chains.unionByName(rest))
        # M-step: words lose the weight of being garbled, what they stand for gains it, each by its own posterior
        moved = hits.join(posterior.drop("grp"), ["src", "rec_id", "chain"])
        away = moved.groupBy("word").agg(F.sum("p").alias("w"))
        to = moved.groupBy(F.col("restored").alias("word")).agg(F.sum("p").alias("w"))
        base = words.join(away, "word", "left").select("word", F.greatest(F.col("n") - F.coalesce("w", F.lit(0.0)), F.lit(0.0)).alias("weight"))
        shared = spark.sparkContext.broadcast(model(base.unionByName(to.select("word", F.col("w").alias("weight")))))
        gains = _rescored(found, shared)
    best = posterior.groupBy("src", "rec_id").agg(F.sum("p").alias("posterior"), F.min_by("chain", F.struct(-F.col("p"), "chain")).alias("chain")).where(F.col("posterior") >= least)
    parts = hits.join(best.select("src", "rec_id", "chain"), ["src", "rec_id", "chain"]).groupBy("src", "rec_id").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("pos", "restored")))).alias("parts"))
    out = texts.join(best, ["src", "rec_id"]).join(parts, ["src", "rec_id"], "left").withColumn("lost", _lost(F.col("text")).isNotNull())
    fixed = F.array_join(F.transform(F.split("text", " "), lambda w, i: F.coalesce(F.try_element_at("parts", i), w)), " ")
    return out.select("src", "rec_id", F.when(F.col("chain") == LOST, "").otherwise(F.col("chain")).alias("chain"), "lost", "posterior", F.when(~F.col("lost"), fixed).alias("original"))
