"""Best-fit packing of token sequences by a configuration linear program.

Lengths are at most the capacity, so their histogram has a bounded size and may
visit the driver. There a fractional configuration program (patterns of lengths
that fill one sequence; every length covered as often as it occurs) is solved by
multiplicative weights: each round prices the lengths, a knapsack dynamic program
finds the most valuable pattern, the pattern is bought, and what it covers loses
weight. The bought amounts are rounded down, and what is left over is placed by
best fit, longest first. Both kinds of patterns together hold each length exactly
as often as it occurs.

Rows then need their rank among rows of equal length. A length may belong to a
third of all rows, so ranks are taken in buckets of a hash and made global by
adding the sizes of the buckets before. The rank decides pattern, copy and place
with a search in a table whose size depends on the capacity alone.

Cases: a null text is empty and still makes a piece of one end token. Longer
documents are cut into pieces of the capacity of which the first may be shorter.
Rows that repeat an id are packed each. An empty table packs into nothing.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import WordEncoder, cut
from .tables import materialize, parts_for
from .words import slices

CAPACITY = 2048
END = 0
#: How byte-level vocabularies write a space, and words given to the tokenizer at once.
BYTE_LEVEL_SPACE = "\u0120"
CALL_WORDS = 512
#: Rounds of the weights, and how fast they fall.
ROUNDS = 1200
STEP = 0.25
BUCKET_ROWS = 200_000


@lru_cache(2)
def _encoder(path: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True

    vocabulary = tokenizer.get_vocab()
    spaced = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that begin with a space
    spaced[[i for token, i in vocabulary.items() if token[0] == BYTE_LEVEL_SPACE]] = True

    def ids_of(texts: list[str]) -> list[list[int]]:
        return [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(found: list[str]) -> list[bytes]:
        # many words to a call; a token with a space in front begins a word
        lines = [" " + " ".join(found[k : k + CALL_WORDS]) for k in range(0, len(found), CALL_WORDS)]
        ids = np.concatenate([np.array(x, np.int64) for x in ids_of(lines)])
        starts = np.flatnonzero(spaced[ids])
        return cut(ids, np.diff(starts, append=len(ids)))

    def whole(texts: list[str]) -> list[bytes]:
        return [np.array(x, "<u4").tobytes() for x in ids_of(texts)]

    return WordEncoder(words, whole)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, token_ids``: little-endian unsigned 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, ends = _encoder(path).encode(batch.column("text"))
            blob, ends = flat.astype("<u4").tobytes(), (4 * ends).tolist()
            end = np.array([END], "<u4").tobytes()
            doc_ids, rows = batch.column("doc_id").to_pylist(), []
            for doc_id, a, b in zip(doc_ids, ends, ends[1:], strict=False):
                ids = blob[a:b] + end
                size = len(ids) // 4
                first = size % capacity or capacity
                starts = [0, *range(first, size, capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], size], strict=True)):
                    rows.append((doc_id, piece, a, b - a, ids[4 * a : 4 * b]))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "token_ids"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, token_ids binary"
    )


def best_pattern(value: np.ndarray, capacity: int) -> np.ndarray:
    """How often the most valuable pattern has each length; an unbounded knapsack.

    ``value[length]`` is 0 for lengths that are not wanted.
    """
    worth = np.where(value > 0, value, -np.inf)[1:]
    best = np.zeros(capacity + 1)  # best[capacity - room]: value of a room
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        total = best[capacity - room + 1 :] + worth[:room]
        k = int(total.argmax())
        unused = best[capacity - room + 1]
        if total[k] > unused:
            best[capacity - room], choice[room] = total[k], k + 1
        else:
            best[capacity - room] = unused
    counts, room = np.zeros(capacity + 1, np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= choice[room]
    return counts


def fractional(need: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[np.ndarray, float]]:
    """Patterns and amounts of a fractional packing, by multiplicative weights.

    Prices start in proportion to the lengths, the best dual solution when no
    room is wasted, and fall for what has been covered. Amounts are scaled to the
    volume of ``need``; lengths that stay below their need are the caller's.
    """
    there = need > 0
    length = np.arange(len(need), dtype=float)
    price = np.where(there, length, 0.0)
    covered, bought = np.zeros(len(need)), {}
    for _ in range(rounds):
        counts = best_pattern(price / price.max(), capacity)
        used = counts > 0
        amount = (need[used] / counts[used]).min()
        gain = counts[used] * amount / need[used]
        covered[used] += gain
        price[used] *= np.exp(-STEP * gain)
        key = counts.tobytes()
        bought[key] = bought.get(key, 0.0) + amount
        if covered[there].min() >= 1:
            break
    scale = (need * length).sum() / (covered * need * length).sum()
    return [(np.frombuffer(k, np.int64), x * scale) for k, x in bought.items()]


def best_fit(need: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Best fit, longest first, over a histogram; bins of equal content stay together."""
    bins: dict[int, list[list]] = {}  # room left: [content, copies]
    for length in np.flatnonzero(need)[::-1]:
        left = int(need[length])
        while left:
            room = min((r for r in bins if r >= length), default=None)
            if room is None:
                content, copies, room = {}, -(-left // (capacity // int(length))), capacity
            else:
                content, copies = bins[room].pop()
                if not bins[room]:
                    del bins[room]
            each = min(room // int(length), left)
            filled = min(copies, left // each)
            if filled < copies:
                if copies - filled and room < capacity:
                    bins.setdefault(room, []).append([content, copies - filled])
            grown = dict(content)
            grown[int(length)] = grown.get(int(length), 0) + each
            bins.setdefault(room - each * int(length), []).append([grown, filled])
            left -= filled * each
    out = []
    for group in bins.values():
        for content, copies in group:
            counts = np.zeros(len(need), np.int64)
            for length, n in content.items():
                counts[length] = n
            out.append((counts, copies))
    return out


def plan(need: np.ndarray, capacity: int = CAPACITY) -> list[tuple[np.ndarray, int]]:
    """Patterns and copies that together hold every length exactly ``need`` times."""
    if not need.any():
        return []
    left, chosen = need.astype(np.int64).copy(), []
    for counts, amount in sorted(fractional(need, capacity), key=lambda x: -x[1]):
        used = counts > 0
        copies = min(int(amount), int((left[used] // counts[used]).min()))
        if copies:
            chosen.append((counts, copies))
            left -= counts * copies
    return chosen + best_fit(left, capacity)


def _places(patterns: list[tuple[np.ndarray, int]]) -> pd.DataFrame:
    """Runs of ranks: from ``first`` on, rows of a length go to copies of one pattern."""
    rows, used, sequence = [], {}, 0
    for counts, copies in patterns:
        offset = 0
        for length in np.flatnonzero(counts)[::-1]:
            n = int(counts[length])
            rows.append((int(length), used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + n * copies
            offset += n * int(length)
        sequence += copies
    return pd.DataFrame(rows, columns=["length", "first", "each", "sequence", "offset"])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with ``sequence_id`` and ``offset``."""
    rows = materialize(pieces, "pieces")
    spark = rows.sparkSession
    buckets = parts_for(rows, BUCKET_ROWS)
    hashed = rows.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = hashed.groupBy("length", "__bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__bucket")
    starts = materialize(
        sizes.withColumn("__before", F.sum("n").over(before) - F.col("n")), "bucket-sizes"
    )
    need = np.zeros(capacity + 1, np.int64)
    for length, n in starts.groupBy("length").agg(F.sum("n")).collect():
        need[length] = n
    table = _places(plan(need, capacity)).sort_values(["length", "first"], kind="stable")
    sent = spark.sparkContext.broadcast(table.to_numpy(np.int64))
    step = 1 << 40  # ranks stay below it, so that length and rank sort as one number

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t = sent.value
        at = np.searchsorted(t[:, 0] * step + t[:, 1], length * step + rank, "right") - 1
        turn, k = np.divmod(rank.to_numpy() - t[at, 1], t[at, 2])
        return pd.DataFrame(
            {"sequence_id": t[at, 3] + turn, "offset": t[at, 4] + k * length.to_numpy()}
        )

    inside = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece")
    ranked = (
        hashed.withColumn("__rank", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts.drop("n")) if buckets == 1 else starts.drop("n"), ["length", "__bucket"])
        .withColumn("__at", placed("length", F.col("__rank") + F.col("__before")))
    )
    return ranked.select(
        *rows.columns,
        F.col("__at.sequence_id").alias("sequence_id"),
        F.col("__at.offset").alias("offset"),
    )


def packed_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with checksum and place."""
    pieces = token_pieces(docs, path, capacity).select(
        "doc_id", "piece", "start", "length", F.crc32("token_ids").alias("ids_crc32")
    )
    return pack(pieces, capacity)
