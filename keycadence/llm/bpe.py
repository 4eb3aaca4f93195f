"""Byte-level BPE: encoding by replaying merges over the words of a corpus slice.

A text is cut into pieces by the tokenizer's pattern. Not single texts are
encoded but all new pieces of a slice at once: an inverted index leads from the
rank of a token pair to the positions that hold such a pair, merges are applied
in rank order to all their positions, and only the two neighbours of a merged
position are looked up again. A merge may give birth to a pair of lower rank
inside a piece; then the rest of that piece waits until the lower one is done,
so that each piece sees its merges in exactly the order that encoding it alone
would take: lowest rank first, leftmost first.

Encoded words are kept for later slices of the same Python worker, up to
``KEPT_WORDS``; the cache saves time and changes nothing.

Cases: a null text is empty and gives no ids; decoding null ids gives no bytes.
All other columns are passed through; one with the name of a result is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import slices

KEPT_WORDS = 400_000
#: Rows decoded at once.
DECODE_ROWS = 500


@lru_cache(2)
def vocabulary(path: str) -> tuple[dict[bytes, int], dict[int, bytes]]:
    """Ranks by token and tokens by rank of a file of base64 tokens with ranks."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks, {rank: token for token, rank in ranks.items()}


class Replay:
    """Merges over many pieces at once."""

    def __init__(self, path: str):
        self.ranks, self.tokens = vocabulary(path)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs: dict[int, int] = {}
        single = self.single.tolist()
        self.byte_pairs = np.array([self.pair(a, b) for a in single for b in single])

    def pair(self, left: int, right: int) -> int:
        """Rank of the token that two tokens make, or -1."""
        key = left << 32 | right
        rank = self.pairs.get(key)
        if rank is None:
            rank = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
            self.pairs[key] = rank
        return rank

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece, as little-endian 32-bit bytes."""
        whole = [self.ranks.get(piece) for piece in pieces]
        rest = [piece for piece, rank in zip(pieces, whole, strict=True) if rank is None]
        merged = iter(self._merge(rest) if rest else ())
        return [next(merged) if r is None else r.to_bytes(4, "little") for r in whole]

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        flat = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        neighbour = np.arange(1, len(flat) + 1)
        neighbour[ends - 1] = -1
        previous = np.arange(-1, len(flat) - 1)
        previous[ends - sizes] = -1
        token, after, before = self.single[flat].tolist(), neighbour.tolist(), previous.tolist()
        word = np.repeat(np.arange(len(pieces)), sizes).tolist()
        pairs, pair = self.pairs, self.pair
        # the index to begin with: places of byte pairs, grouped by rank
        first = self.byte_pairs[flat[:-1] << 8 | flat[1:]]
        first[neighbour[:-1] < 0] = -1
        at = np.flatnonzero(first >= 0)
        at = at[np.argsort(first[at], kind="stable")]
        ranks, begins = np.unique(first[at], return_index=True)
        groups = np.split(at, begins[1:])
        places = {r: g.tolist() for r, g in zip(ranks.tolist(), groups, strict=False)}
        queue = ranks.tolist()

        def add(rank: int, i: int) -> None:
            if rank in places:
                places[rank].append(i)
            else:
                places[rank] = [i]
                heappush(queue, rank)

        while queue:
            rank = heappop(queue)
            held = -1  # the word that waits for a lower rank
            found = places.pop(rank)
            found.sort()
            for i in found:
                j, left = after[i], token[i]
                # pairs that a merge has changed meanwhile are passed over
                if j < 0 or left < 0 or pairs[left << 32 | token[j]] != rank:
                    continue
                if word[i] == held:
                    add(rank, i)
                    continue
                token[i], token[j] = rank, -1
                k, h = after[j], before[i]
                after[i] = k
                if k >= 0:
                    before[k] = i
                    key = rank << 32 | token[k]
                    new = pairs[key] if key in pairs else pair(rank, token[k])
                    if new >= 0:
                        if new in places:
                            places[new].append(i)
                        else:
                            add(new, i)
                        if new < rank:
                            held = word[i]
                if h >= 0:
                    key = token[h] << 32 | rank
                    new = pairs[key] if key in pairs else pair(token[h], rank)
                    if new >= 0:
                        if new in places:
                            places[new].append(h)
                        else:
                            add(new, h)
                        if new < rank:
                            held = word[i]
        left = np.array(token)
        kept = left >= 0
        return cut(left[kept], np.add.reduceat(kept, ends - sizes))


class Recent(dict):
    """A cache of two generations: what is looked up again outlives a turn."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def fresh(self, keys) -> list:
        """Keys that are not known; known ones move into the young generation."""
        old, out = self.old, []
        if len(self) > self.most:
            self.old = old = dict(self)
            self.clear()
        for key in keys:
            if key not in self:
                if key in old:
                    self[key] = old[key]
                else:
                    out.append(key)
        return out


def cut(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Runs of ids as little-endian 32-bit bytes."""
    blob = ids.astype("<u4").tobytes()
    ends = (4 * np.cumsum(counts)).tolist()
    return [blob[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class WordEncoder:
    """Ids of whole texts, word by word.

    The pattern never joins characters across a single space between two
    characters that are not white space, so a text can be cut there and its parts
    be encoded alone, each with the space before it. Nearly all parts are words
    without white space at either end; ``words`` gives their ids as 32-bit bytes.
    ``whole`` takes the other parts, and the first of each text. Per word of a text
    there are array operations only; Python sees distinct words.
    """

    def __init__(
        self,
        words: Callable[[list[str]], list[bytes]],
        whole: Callable[[list[str]], list[bytes]],
    ):
        self.words, self.whole = words, whole
        self.known = Recent(KEPT_WORDS)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids laid end to end, and where those of each text begin and end."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        lists = pc.split_pattern(texts, " ")
        rows = lists.offsets.to_numpy()
        coded = lists.values.slice(rows[0], rows[-1] - rows[0]).dictionary_encode()
        rows = rows[:-1] - rows[0]
        names, codes = coded.dictionary.to_numpy(False).tolist(), coded.indices.to_numpy(False)
        opens = np.array([bool(w) and not w[0].isspace() for w in names])[codes]
        closes = np.array([bool(w) and not w[-1].isspace() for w in names])[codes]
        cuts = np.concatenate([[True], closes[:-1] & opens[1:]])
        cuts[rows] = True
        starts = np.flatnonzero(cuts)
        sizes = np.diff(starts, append=len(codes))
        plain = (sizes == 1) & (opens & closes)[starts]
        first = np.zeros(len(codes), bool)
        first[rows] = True
        plain &= ~first[starts]

        slots = np.zeros(len(starts), np.int64)
        used = codes[starts[plain]]
        distinct = np.flatnonzero(np.bincount(used, minlength=len(names)))
        place = np.zeros(len(names), np.int64)
        place[distinct] = np.arange(len(distinct))
        slots[plain] = place[used]
        found = self._known([names[k] for k in distinct.tolist()])
        others: dict[str, int] = {}
        for k in np.flatnonzero(~plain).tolist():
            a, b = starts[k], starts[k] + sizes[k]
            part = " ".join([names[c] for c in codes[a:b].tolist()])
            slots[k] = others.setdefault(part if first[a] else " " + part, len(found) + len(others))
        found += self.whole(list(others)) if others else []

        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        table = np.frombuffer(b"".join(found), "<u4")
        counts = lengths[slots]
        ids = _runs(table, (np.cumsum(lengths) - lengths)[slots], counts)
        per_text = np.add.reduceat(counts, np.searchsorted(starts, rows))
        return ids, np.concatenate([[0], np.cumsum(per_text)])

    def _known(self, names: list[str]) -> list[bytes]:
        fresh = self.known.fresh(names)
        if fresh:
            self.known.update(zip(fresh, self.words(fresh), strict=True))
        return [*map(self.known.__getitem__, names)]


def _runs(table: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Parts of a table, given by start and length, laid end to end."""
    ends = np.cumsum(counts)
    steps = np.repeat(starts - ends + counts, counts)
    steps += np.arange(len(steps))
    return table[steps]


@lru_cache(2)
def _encoder(path: str) -> WordEncoder:
    replay, pattern = Replay(path), regex.compile(public_tokenizers.PATTERN)
    ids = Recent(KEPT_WORDS // 2)

    def piece_ids(pieces: list[str]) -> list[bytes]:
        new = ids.fresh(dict.fromkeys(pieces))
        ids.update(zip(new, replay.encode([p.encode() for p in new]), strict=True))
        return [*map(ids.__getitem__, pieces)]

    def words(found: list[str]) -> list[bytes]:
        # one search for all: a piece with a space in front begins a word
        pieces = pattern.findall(" " + " ".join(found))
        starts = [k for k, p in enumerate(pieces) if p[0] == " "]
        blobs = piece_ids(pieces)
        return [
            blobs[a] if b - a == 1 else b"".join(blobs[a:b])
            for a, b in zip(starts, [*starts[1:], len(pieces)], strict=True)
        ]

    def whole(texts: list[str]) -> list[bytes]:
        found = [pattern.findall(text) for text in texts]
        blobs = iter(piece_ids([p for pieces in found for p in pieces]))
        return [b"".join(islice(blobs, len(pieces))) for pieces in found]

    return WordEncoder(words, whole)


def with_column(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """A schema with one more column, last; an older one of that name goes."""
    return T.StructType([f for f in schema.fields if f.name != name]).add(name, kind)


def _appended(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*map(batch.column, kept), values], [*kept, name])


def _encoded(batches, path: str, column: str, out: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, column):
        ids, ends = _encoder(path).encode(batch.column(column))
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.view(np.int32)))
        yield _appended(batch, out, lists)


@lru_cache(2)
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """All tokens laid end to end by rank, and where each begins."""
    tokens = vocabulary(path)[1]
    every = [tokens.get(rank, b"") for rank in range(max(tokens) + 1)]
    begins = np.cumsum([0, *map(len, every)])
    return np.frombuffer(b"".join(every), np.uint8), begins


def _decoded(batches, path: str, column: str, out: str) -> Iterator[pa.RecordBatch]:
    table, begins = _token_bytes(path)
    parts = (b.slice(at, DECODE_ROWS) for b in batches for at in range(0, b.num_rows, DECODE_ROWS))
    for batch in parts:
        lists = batch.column(column)
        ids = lists.flatten().to_numpy(False)  # null lists have no values here
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(False)
        sizes = begins[ids + 1] - begins[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(ends[-1]) + np.repeat(begins[ids] - ends[:-1], sizes)
        offsets = ends[np.concatenate([[0], np.cumsum(counts)])].astype(np.int64)
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(table[places].tobytes())]
        whole = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, buffers)
        yield _appended(batch, out, whole.cast(pa.binary()))


def encode(docs: DataFrame, path: str, column: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of a text column as ``array<int>``."""
    schema = with_column(docs.schema, out, T.ArrayType(T.IntegerType()))
    return docs.mapInArrow(lambda batches: _encoded(batches, path, column, out), schema)


def decode(docs: DataFrame, path: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that a column of token ids stands for."""
    schema = with_column(docs.schema, out, T.BinaryType())
    return docs.mapInArrow(lambda batches: _decoded(batches, path, column, out), schema)


def round_trip(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``encode`` and then ``decode``, in one Python worker instead of two."""
    schema = with_column(docs.schema, "ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoded(_encoded(batches, path, column, "ids"), path, "ids", "decoded")

    return docs.mapInArrow(run, with_column(schema, "decoded", T.BinaryType()))
