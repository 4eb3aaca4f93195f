"""A hierarchical Pitman-Yor language model and the scores it gives to texts.

Words are drawn from restaurants, one for each previous word (the end token
before the first word of a text). They share the word restaurant without context
as their parent, whose dishes come from a spelling model: a hierarchy of
restaurants over bytes, one for each context of up to four bytes, which shares
its parent (the context without its oldest byte) with others, down to one
restaurant without context over a uniform base. Byte contexts know bytes by
classes (all letters apart in the two nearest places), so that there are at most
2^16 of them. A new table in a restaurant sends one customer to its parent.

Seating is sampled by sweeps. In a sweep the customers of every pair of words,
then of every word are seated anew, given the parents' probabilities and the
totals of the sweep before. This is Gibbs sampling in blocks and not customer by
customer: the customers of a dish come in blocks that grow with their number, and
a block opens its expected number of new tables, rounded at random. Then the
spelling restaurants are seated the same way. Random numbers are hashes of words,
sweep and block, so a lost task seats its words exactly as before. Predictive
probabilities are averaged over the sweeps after ``BURN_IN``.

All counts come from the whole training part. Documents are laid into chunks of
about ``CHUNK_BYTES`` with a vocabulary each; only distinct words and word pairs
of a chunk are shuffled. A pair is one 8-byte code of two word numbers, and is
shuffled once: one that is seen once in training has one table in every sweep, so
only pairs seen more often are seated, and only pairs that a chunk cannot judge
by its own count are sent back to it. The spelling model has at most 2^24
contexts with a byte, whatever the corpus; it alone visits the driver and is
broadcast. Word numbers have 31 bits; more distinct words than that are refused.

Cases: a null text is empty and has its end token. A null doc_id counts as the
empty text where documents are divided. The spelling of a word of hundreds of bytes
has probability ``LEAST_SPELLED``, so every score is finite. Without training documents every count is
0 and the model is its uniform spelling base. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import discard, materialize
from .words import mixed, slices, word_codes, word_hashes

CHUNK_BYTES = 16_000_000
SWEEPS = 4
BURN_IN = 1
STRENGTH = 10.0
#: Of the restaurants with a previous word.
PAIR_STRENGTH = 1.0
#: Pairs that one task groups.
PART_PAIRS = 2_000_000
SPELL_DISCOUNT, SPELL_STRENGTH = 0.5, 2.0
#: Below this a spelling's probability would be lost to rounding; very long words have it.
LEAST_SPELLED = 1e-290
#: Stands for the end of a text; no word holds white space.
END = b"\n"
EDGE = 0x20
#: Bits by which a context knows the byte before, the one before that, and so on.
FIELDS = (5, 5, 4, 2)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents that are not trained on."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 10 == 0


def chunks(docs: DataFrame) -> DataFrame:
    """One row per chunk: ids, flags and lengths of its documents, their words as
    codes, and the words with their training counts."""

    def row(chunk: int, parts: list) -> pa.RecordBatch:
        ids = pa.concat_arrays([p.column("doc_id") for p in parts])
        held = pa.concat_arrays([p.column("held_out") for p in parts])
        offsets, codes, words = word_codes(pa.concat_arrays([p.column("text") for p in parts]))
        sizes = np.diff(offsets) + 1
        all_codes = np.full(sizes.sum(), len(words), np.int32)
        inside = np.ones(len(all_codes), bool)
        inside[np.cumsum(sizes) - 1] = False
        all_codes[inside] = codes
        train = np.repeat(~held.to_numpy(False), sizes)
        counts = np.bincount(all_codes[train], minlength=len(words) + 1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([chunk]),
                *[pa.ListArray.from_arrays([0, len(x)], x) for x in (ids, held, pa.array(sizes))],
                pa.array([all_codes.tobytes()], pa.binary()),
                pa.ListArray.from_arrays([0, len(words) + 1], pa.array([*words, END], pa.binary())),
                pa.ListArray.from_arrays([0, len(counts)], pa.array(counts.astype(np.int64))),
            ],
            ["chunk", "ids", "held", "sizes", "codes", "words", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in slices(batches, "text"):
            parts.append(batch)
            size += batch.nbytes
            if size >= CHUNK_BYTES:
                yield row(chunk, parts)
                chunk, parts, size = chunk + 1, [], 0
        if parts:
            yield row(chunk, parts)

    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        held_out().alias("held_out"),
    )
    return rows.mapInArrow(
        run,
        "chunk long, ids array<long>, held array<boolean>, sizes array<long>, codes binary, "
        "words array<binary>, counts array<long>",
    )


def tables(count: np.ndarray, new: np.ndarray, discount: float, uniform) -> np.ndarray:
    """Tables of each dish after seating its ``count`` customers.

    ``new`` is the weight of a new table with the dish. The k-th block takes
    ``uniform(k, rows)`` random numbers for the dishes that still have customers.
    """
    out = np.minimum(count, 1).astype(float)
    order = np.argsort(-count, kind="stable")
    falling, seated, k = -count[order], 1, 0
    while (active := int(np.searchsorted(falling, -seated, "left"))) > 0:
        rows = order[:active]
        block = np.minimum(count[rows] - seated, max(1, seated // 5))
        share = new[rows] / (new[rows] + seated - discount * out[rows])
        out[rows] += np.minimum(np.floor(block * share + uniform(k, rows)), block)
        seated += max(1, seated // 5)
        k += 1
    return out


def _mask(level: int) -> int:
    """The part of a key that a restaurant with ``level`` bytes of context sees."""
    return (1 << (sum(FIELDS[:level]) + 8)) - 1


@dataclass
class Spelling:
    """Predictive probabilities of a byte after a context, by level."""

    keys: list[np.ndarray]  # seen contexts with their byte, sorted
    own: list[np.ndarray]  # what a restaurant adds for the byte
    back: list[np.ndarray]  # by context: weight of the parent

    def probability(self, keys: np.ndarray, level: int = len(FIELDS)) -> np.ndarray:
        p = np.full(len(keys), 1 / 256)
        for k in range(level + 1):
            part = keys & _mask(k)
            p = p * self.back[k][part >> 8]
            known = self.keys[k]
            if len(known):
                at = np.minimum(np.searchsorted(known, part), len(known) - 1)
                p = p + np.where(known[at] == part, self.own[k][at], 0.0)
        return p


def fitted(keys: np.ndarray, counts: np.ndarray, before: Spelling | None, sweep: int) -> Spelling:
    """Seat all levels for given customers of the restaurants with whole contexts.

    New tables are weighed with the parent's probabilities of the sweep before.
    """
    rng = np.random.default_rng(sweep)
    draw = lambda k, rows: rng.random(len(rows))
    d, s = SPELL_DISCOUNT, SPELL_STRENGTH
    all_keys, own, back = [], [], []
    for level in range(len(FIELDS), -1, -1):
        context, size = keys >> 8, (_mask(level) >> 8) + 1
        opened = np.bincount(context, np.minimum(counts, 1), size)
        parent = np.full(len(keys), 1 / 256)
        if before and level:
            parent = before.probability(keys, level - 1)
        seats = tables(counts, (s + d * opened[context]) * parent, d, draw)
        total = np.bincount(context, counts, size)
        all_keys.append(keys)
        own.append((counts - d * seats) / (s + total[context]))
        back.append((s + d * np.bincount(context, seats, size)) / (s + total))
        if level:
            keys, place = np.unique(keys & _mask(level - 1), return_inverse=True)
            counts = np.bincount(place, seats, len(keys)).astype(np.int64)
    return Spelling(all_keys[::-1], own[::-1], back[::-1])


def _classes() -> np.ndarray:
    """Contexts know a byte by one of 32 classes: letters, the edge, and five others."""
    found = 27 + np.arange(256) % 5
    found[97:123] = np.arange(1, 27)
    found[EDGE] = 0
    return found


def _spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys (context and byte) of all words and their ends, and each key's word."""
    pad = bytes([EDGE]) * len(FIELDS)
    flat = np.frombuffer(b"".join(pad + w + b" " for w in words), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    owner = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(owner)) + len(FIELDS) * (owner + 1)
    classes, keys, shift = _classes()[flat], flat[at], 8
    for back, bits in enumerate(FIELDS, 1):
        keys = keys | (classes[at - back] % (1 << bits)) << shift
        shift += bits
    return keys, owner


@dataclass
class Sweep:
    spelling: Spelling
    tables: float  # all tables of the word restaurant
    customers: int  # and all its customers


class Words:
    """Words of one batch, seated as each sweep seats them."""

    def __init__(self, words: list[bytes], counts: np.ndarray, discount: float):
        self.counts, self.discount = counts, discount
        self.hashes = word_hashes(words)
        self.keys, self.owner = _spelled(words)
        self.distinct, self.place = np.unique(self.keys, return_inverse=True)

    def spelled(self, sweep: Sweep) -> np.ndarray:
        p = np.log10(sweep.spelling.probability(self.distinct))[self.place]
        logs = np.bincount(self.owner, p, len(self.counts))
        return np.maximum(10.0**logs, LEAST_SPELLED)

    def seats(self, number: int, before: Sweep | None) -> np.ndarray:
        """Tables of each word in a sweep; one for each word to begin with."""
        if before is None:
            return np.minimum(self.counts, 1).astype(float)
        new = (STRENGTH + self.discount * before.tables) * self.spelled(before)
        return tables(self.counts, new, self.discount, _uniform(self.hashes, number))


def _uniform(hashes: np.ndarray, number: int):
    """Random numbers for ``tables`` in a sweep."""

    def draw(k: int, rows: np.ndarray) -> np.ndarray:
        salt = mixed(np.array([number * 1000 + k], np.uint64))
        return (mixed(hashes[rows] ^ salt) >> np.uint64(11)) / float(1 << 53)

    return draw


def _word_batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for at in range(0, batch.num_rows, 50_000):
            part = batch.slice(at, 50_000)
            yield part, part.column("word").to_pylist(), part.column("customers").to_numpy(False)


def _discount(once: int, twice: int, most: float) -> float:
    """The usual estimate of a discount from what is seen once and twice."""
    return min(max((once + 1) / (once + 2 * twice + 2), 0.1), most)


def numbered(vocabulary: DataFrame) -> DataFrame:
    """``word, n`` with ``number`` (counted from 0) and ``mark``, a hash of the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            words = batch.column("word")
            yield pa.RecordBatch.from_arrays(
                [
                    words, batch.column("n"), pa.array(np.full(len(words), part, np.int32)),
                    pa.array(np.arange(at, at + len(words))),
                    pa.array(word_hashes(words.to_pylist()).view(np.int64)),
                ],
                ["word", "n", "part", "place", "mark"],
            )
            at += len(words)

    stored = materialize(
        vocabulary.mapInArrow(run, "word binary, n long, part int, place long, mark long"),
        "vocabulary",
    )
    sizes = {r.part: r.n for r in stored.groupBy("part").agg(F.count("*").alias("n")).collect()}
    each = [sizes.get(k, 0) for k in range(max(sizes, default=0) + 1)]
    if sum(each) >= 1 << 31:
        raise ValueError("more distinct words than word numbers")
    first = F.array(*[F.lit(int(x)).cast("long") for x in np.cumsum([0, *each])])
    number = F.get(first, F.col("part")) + F.col("place")
    return stored.select("word", "n", number.alias("number"), "mark")


def _pair_codes(chunk: dict, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all tokens of a chunk: code of the word before, code, and pair of numbers."""
    codes = np.frombuffer(chunk["codes"], np.int32)
    sizes = np.array(chunk["sizes"], np.int64)
    before = np.roll(codes, 1)
    before[np.cumsum(sizes) - sizes] = len(numbers) - 1
    return before, codes, numbers[before] << 32 | numbers[codes]


def _pair_counts(chunk: dict, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, the place of each token's pair, and the training counts."""
    distinct, place = np.unique(pairs, return_inverse=True)
    train = np.repeat(~np.array(chunk["held"], bool), chunk["sizes"])
    return distinct, place, np.bincount(place[train], minlength=len(distinct))


def shared_pairs(laid: DataFrame, numbers: DataFrame) -> DataFrame:
    """``part, pair, n, first``: the training count of each pair in each chunk that
    cannot know it; ``first`` is true for one row of each pair."""

    def made(documents: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(known["code"].to_numpy())
        chunk = documents.to_pylist()[0]
        pairs = _pair_codes(chunk, known["number"].to_numpy()[order])[2]
        distinct, _, counts = _pair_counts(chunk, pairs)
        part = np.full(len(distinct), chunk["chunk"], np.int64)
        return pa.table({"pair": distinct, "part": part, "n": counts.astype(np.int64)})

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy(False) for c in b.columns] for b in batches if b.num_rows]
        if not parts:
            return
        pair, part, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(pair)
        pair, part, n = pair[order], part[order], n[order]
        first = np.concatenate([[True], pair[1:] != pair[:-1]])
        start = np.flatnonzero(first)
        total = np.repeat(np.add.reduceat(n, start), np.diff(np.append(start, len(pair))))
        sent = (total > 1) | (total != n)
        table = pa.table({"part": part[sent], "pair": pair[sent], "n": total[sent], "first": first[sent]})
        yield from table.to_batches(max_chunksize=100_000)

    tokens = laid.agg(F.sum(F.length("codes") / 4)).first()[0] or 0
    every = (
        laid.select("chunk", "held", "sizes", "codes")
        .groupBy("chunk")
        .cogroup(numbers.groupBy("part"))
        .applyInArrow(made, "pair long, part long, n long")
    )
    dealt = every.repartition(1 + int(tokens) // PART_PAIRS, "pair")
    return materialize(
        dealt.mapInArrow(grouped, "part long, pair long, n long, first boolean"), "pairs"
    )


def _seated_pairs(pairs: DataFrame, words: DataFrame, number: int, discount: float) -> DataFrame:
    """``pairs`` with their tables in a sweep, given ``words`` of the sweep before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n, kept, p, opened, after, before = (c.to_numpy(False) for c in batch.columns)
            hashes = mixed(after.view(np.uint64) ^ mixed(before.view(np.uint64)))
            new = (PAIR_STRENGTH + discount * opened) * p
            seats = tables(n, new, discount, _uniform(hashes, number)).astype(np.int64)
            kept = kept + seats * (number > BURN_IN)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (pair, n, seats, kept)], ["pair", "n", "seats", "kept"]
            )

    word, previous = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftright("pair", 32)
    one = words.select(F.col("number").alias("w"), "p", F.col("mark").alias("after"))
    two = words.select(F.col("number").alias("u"), "opened", F.col("mark").alias("before"))
    joined = (
        pairs.withColumns({"w": word, "u": previous}).join(one, "w").join(two, "u")
        .select("pair", "n", "kept", "p", "opened", "after", "before")
    )
    return materialize(
        joined.mapInArrow(run, "pair long, n long, seats long, kept long"), f"pair-seats-{number}"
    )


def _customers(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """``words`` with their ``customers`` (tables of the restaurants above) and with
    the tables ``opened`` in the restaurant that has the word as its context.

    Tables and customers differ only for pairs seen more than once.
    """
    fewer = F.sum(F.col("n") - F.col("seats")).alias("fewer")
    sums = [
        pairs.groupBy(place.alias("number")).agg(fewer.alias(name))
        for place, name in (
            (F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)), "fewer_in"),
            (F.shiftright("pair", 32), "fewer_out"),
        )
    ]
    both = words.join(sums[0], "number", "left").join(sums[1], "number", "left")
    zero = F.lit(0).cast("long")
    return both.withColumns({
        "customers": F.col("n") - F.coalesce("fewer_in", zero),
        "opened": F.col("n") - F.coalesce("fewer_out", zero),
    }).drop("fewer_in", "fewer_out")


def _swept(words: DataFrame, number: int, last: Sweep | None, discount: float) -> Sweep:
    """Seat the words' customers and then the spelling restaurants."""
    before = words.sparkSession.sparkContext.broadcast(last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = everyone = 0.0
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for _, spelt, n in _word_batches(batches):
            batch = Words(spelt, n, discount)
            seats = batch.seats(number, before.value)
            total += seats.sum()
            everyone += n.sum()
            both = np.concatenate([keys, batch.keys])
            weight = np.concatenate([counts, seats[batch.owner]])
            keys, place = np.unique(both, return_inverse=True)
            counts = np.bincount(place, weight).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([keys, [-1, -2]])),
                pa.array(np.concatenate([counts, [int(total), int(everyone)]])),
            ],
            ["key", "n"],
        )

    sums = words.select("word", "customers").mapInArrow(run, "key long, n long").groupBy("key").agg(
        F.sum("n").alias("n")
    )
    found = sums.toPandas().sort_values("key")
    keys, counts = found["key"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    total, everyone = (int(counts[keys == k].sum()) for k in (-1, -2))
    some = (keys >= 0) & (counts > 0)
    spelling = fitted(keys[some], counts[some], last.spelling if last else None, number)
    return Sweep(spelling, total, everyone)


def _predicted(words: DataFrame, number: int, chain: list[Sweep], discount: float) -> DataFrame:
    """``words`` with their predictive probability ``p`` without context."""
    sent = words.sparkSession.sparkContext.broadcast(chain[-2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last = sent.value[-1], sent.value[0] if number else None
        for rows, spelt, n in _word_batches(batches):
            batch = Words(spelt, n, discount)
            new = (STRENGTH + discount * now.tables) * batch.spelled(now)
            p = (n - discount * batch.seats(number, last) + new) / (STRENGTH + now.customers)
            yield rows.append_column("p", pa.array(p))

    kept = words.drop("p")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, p double")


def text_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    laid = materialize(chunks(docs), "chunks")
    listed = laid.select(F.col("chunk").alias("part"), F.posexplode(F.arrays_zip("words", "counts")).alias("code", "x"))
    listed = listed.select("part", "code", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    vocabulary = numbered(listed.groupBy("word").agg(F.sum("n").alias("n")))
    codes = listed.drop("n")
    shared = shared_pairs(laid, codes.join(vocabulary, "word").select("part", "code", "number"))
    pairs = shared.filter("first AND n > 1").select(
        "pair", "n", F.lit(1).cast("long").alias("seats"), F.lit(0).cast("long").alias("kept")
    )
    row = vocabulary.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count_if(F.col("n") > 0).alias("distinct"),
    ).first()
    total, distinct = row.total, row.distinct
    row = pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("often"), F.count_if(F.col("n") == 2).alias("twice")
    ).first()
    pair_discount = _discount(total - row.often, row.twice, 0.99)

    words, chain, discount = vocabulary, [], 0.0
    for number in range(SWEEPS + 1):
        if number:
            last = pairs
            pairs = _seated_pairs(last, words, number, pair_discount)
            if number > 1:
                discard(last)
        seated = materialize(_customers(words.drop("customers", "opened"), pairs), f"customers-{number}")
        if not number:
            row = seated.agg(
                F.count_if(F.col("customers") == 1).alias("once"),
                F.count_if(F.col("customers") == 2).alias("twice"),
            ).first()
            discount = _discount(row.once, row.twice, 0.95)
        chain.append(_swept(seated, number, chain[-1] if chain else None, discount))
        older, words = words, _predicted(seated, number, chain, discount)
        if number > BURN_IN:
            words = words.withColumns({f"p{number}": F.col("p"), f"opened{number}": F.col("opened")})
        words = materialize(words, f"words-{number}")
        discard(seated, *[older] * (number > 0))

    kept = range(BURN_IN + 1, SWEEPS + 1)
    values = [f"{name}{k}" for name in ("p", "opened") for k in kept]
    own = F.col("n") - F.col("kept") * pair_discount / len(kept)
    judged = shared.select("part", "pair", "n").join(
        pairs.select("pair", own.alias("own")), "pair", "left"
    )
    nothing = F.lit(None).cast("double")
    known = codes.join(words, "word").select(
        "part", F.col("code").cast("long").alias("code"), "number", "n", nothing.alias("own"),
        *[F.col(c).cast("double").alias(c) for c in values],
    ).unionByName(judged.select(
        "part", F.col("pair").alias("code"), F.lit(-1).cast("long").alias("number"), "n",
        F.coalesce("own", F.col("n") * (1 - pair_discount)).alias("own"),
        *[nothing.alias(c) for c in values],
    ))

    def run(documents: pa.Table, known: pa.Table) -> pa.Table:
        number, code = known["number"].to_numpy(), known["code"].to_numpy()
        word, back = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
        word = word[np.argsort(code[word])]
        n = known["n"].to_numpy()[word]
        base = np.log10((n + 0.1) / (total + 0.1 * (distinct + 1)))
        chunk = documents.to_pylist()[0]
        before, codes, pairs = _pair_codes(chunk, number[word])
        distinct_pairs, place, counts = _pair_counts(chunk, pairs)
        # a pair that is not sent back has its only customer, if any, in this chunk
        add = counts * (1 - pair_discount)
        add[np.searchsorted(distinct_pairs, code[back])] = known["own"].to_numpy()[back]
        p = np.zeros(len(codes))
        for k in kept:
            of_word, opened = (known[f"{c}{k}"].to_numpy()[word] for c in ("p", "opened"))
            p += (PAIR_STRENGTH + pair_discount * opened)[before] * of_word[codes]
        score = np.log10((add[place] + p / len(kept)) / (PAIR_STRENGTH + n[before]))
        sizes = np.array(chunk["sizes"], np.int64)
        starts = np.cumsum(sizes) - sizes
        columns = ((n > 0).astype(np.int64)[codes], base[codes], score)
        sums = [np.add.reduceat(x, starts) for x in columns]
        return pa.table({
            "doc_id": pa.array(chunk["ids"], pa.int64()),
            "held_out": pa.array(chunk["held"], pa.bool_()),
            "n_tokens": sizes,
            "n_known": sums[0],
            "train_tokens": np.full(len(sizes), total, np.int64),
            "base_score": sums[1],
            "score": sums[2],
        })

    return (
        laid.select("chunk", "ids", "held", "sizes", "codes")
        .groupBy("chunk")
        .cogroup(known.groupBy("part"))
        .applyInArrow(
            run,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )


def perplexity(scores: DataFrame) -> DataFrame:
    """Perplexity per token of held-out texts under model and base."""
    rows = scores.filter("held_out")
    return rows.agg(*[
        F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens")).alias(name)
        for c, name in (("score", "model"), ("base_score", "base"))
    ])
