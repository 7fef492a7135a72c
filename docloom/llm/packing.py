"""Documents packed into training sequences of one fixed token capacity.

Only the length histogram (at most ``capacity`` rows) reaches the driver.
There the lengths are placed longest first, each into the open packing pattern
with the most room left (shortest pack first), for all documents of a length
at once; the patterns with their counts are joined back to the documents by
rank within the length.  Ranks are made per (length, salt) group and shifted by
a prefix sum of the group sizes, so a length that a third of all documents
share is ranked by many tasks.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.shared import kept

TOKENIZER = os.environ.get("DOCLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
# Fixed value: the split pattern that belongs to the public rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LENGTHS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id and number of tokens; null texts count 0 tokens."""
    with open(tokenizer, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        coder = tiktoken.Encoding("lengths", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            lengths = [len(coder.encode_ordinary(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], schema=_LENGTHS)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(count, "doc_id bigint, n_tokens bigint")


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of the pattern, number of sequences) by shortest-pack-first over the histogram."""
    open_by_room: dict[int, list[list]] = {}
    rooms: list[int] = []  # negated rooms, a heap; stale entries are skipped

    def put(room: int, pack: list[int], n: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = []
            heapq.heappush(rooms, -room)
        open_by_room[room].append([pack, n])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if length <= 0:
            continue
        while left:
            while rooms and not open_by_room.get(-rooms[0]):
                open_by_room.pop(-heapq.heappop(rooms), None)
            room = -rooms[0] if rooms else 0
            if room < length:
                put(capacity - length, [length], left)
                break
            pack, n = open_by_room[room][-1]
            take = min(n, left)
            if take == n:
                open_by_room[room].pop()
            else:
                open_by_room[room][-1][1] -= take
            put(room - length, pack + [length], take)
            left -= take
    return [(pack, n) for packs in open_by_room.values() for pack, n in packs]


def ranked(pieces: DataFrame, salts: int = 64) -> DataFrame:
    """0-based rank of every piece within its length, without one task per length."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("n_tokens", "salt").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("n_tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("n_tokens", "salt", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"))
    own = Window.partitionBy("n_tokens", "salt").orderBy("doc_id", "piece")
    return salted.withColumn("nth", F.row_number().over(own) - 1).join(shift, ["n_tokens", "salt"]).select("doc_id", "piece", "first_token", "n_tokens", (F.col("nth") + F.col("shift")).alias("rank"))


_PLACED = pa.schema([("sequence_id", pa.int64()), ("position", pa.int32()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("first_token", pa.int64()), ("n_tokens", pa.int64())])


def packed(docs: DataFrame, capacity: int = 2048, tokenizer: str = TOKENIZER, lengths: DataFrame | None = None) -> DataFrame:
    """sequence_id, position, doc_id, piece, first_token, n_tokens of every document.

    A document of at most ``capacity`` tokens is one piece; a longer one is cut
    into full pieces and a rest.  Documents without tokens (null and empty
    texts) are in no sequence.  Repeated rows are packed as often as they
    occur; rank ties go by doc_id and piece; an empty table gives no row.
    """
    import numpy as np

    spark = docs.sparkSession
    counts = (token_counts(docs, tokenizer) if lengths is None else lengths).where("n_tokens > 0")
    pieces = kept(
        counts.withColumn("piece", F.explode(F.sequence(F.lit(0), ((F.col("n_tokens") - 1) / capacity).cast("int"))))
        .select("doc_id", "piece", (F.col("piece").cast("bigint") * capacity).alias("first_token"), F.least(F.lit(capacity).cast("bigint"), F.col("n_tokens") - F.col("piece").cast("bigint") * capacity).alias("n_tokens")),
    )
    histogram = {r[0]: r[1] for r in pieces.groupBy("n_tokens").agg(F.count(F.lit(1))).collect()}
    starts: list[tuple[int, int, int, int, int]] = []  # length, first rank, base sequence, position
    used: dict[int, int] = {}
    base = 0
    for pack, n in patterns(histogram, capacity):
        for position, length in enumerate(pack):
            starts.append((length, used.get(length, 0), base, position, n))
            used[length] = used.get(length, 0) + n
        base += n
    starts.sort()
    slots = spark.sparkContext.broadcast(np.array(starts, dtype=np.int64).reshape(-1, 5))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        key = (table[:, 0] << 44) | table[:, 1]
        for batch in batches:
            doc, piece, first, n, rank = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            at = np.searchsorted(key, (n << 44) | rank, side="right") - 1
            hit = table[at]
            yield pa.RecordBatch.from_arrays([pa.array(hit[:, 2] + rank - hit[:, 1]), pa.array(hit[:, 3].astype(np.int32)), pa.array(doc), pa.array(piece), pa.array(first), pa.array(n)], schema=_PLACED)

    return ranked(pieces).mapInArrow(place, "sequence_id bigint, position int, doc_id bigint, piece int, first_token bigint, n_tokens bigint")
