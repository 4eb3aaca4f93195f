"""Near-duplicate documents: a multi-index Hamming join over MinHash signatures.

A document is the set of its distinct ``width``-word shingles. Its signature has
``SYMBOLS`` MinHash values of 16 bits. Signatures are split into chunks of
``CHUNK`` symbols, and each chunk is indexed with every one of its symbols left
out. By the pigeonhole principle two signatures that differ in fewer than twice
as many symbols as there are chunks have a chunk with at most one difference, and
so share a key: every pair under that distance is found. At a similarity of 0.8
a chunk of six is shared with probability 0.655, so a pair misses all fourteen
with probability 3e-7.

Groups stay linear:

1. Documents with equal sets form a class; only its smallest id goes on.
2. Per key the smallest member is the hub, and only (member, hub) pairs are
   checked on full sets. Their links give first components.
3. A key all of whose members are in one component is done. In the others, the
   members outside of the hub's component are compared with those members that
   are in another component, by longer signatures inside the join, and what these
   do not rule out is checked. So each pair of one key ends up in one component
   or is compared, and no link between components is lost.

Keys hash the symbols and the index of the part into 64 bits; a collision costs a
check and changes no result.

Cases: a null text or one without words has an empty set and is linked with
nothing; one with fewer words than ``width`` has its whole word sequence as its
only shingle. Rows that repeat a doc_id are one document. A null doc_id is never
linked; its component is null and it is kept. Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import discard, materialize, spread
from .words import mixed, shingles, slices, word_codes, word_hashes

SYMBOLS = 84
CHUNK = 6
#: Pairs that differ in more symbols are not checked. A pair at similarity 0.8
#: differs in 16.8 on average and in more than 38 with probability 1e-8.
MOST_DIFFERENT = 38
#: The same for the longer signatures of one bit per function, which differ in a
#: tenth of their bits at similarity 0.8 and in more than this with probability 2e-8.
BITS = 2048
MOST_BITS = 280
#: Hashes that are worked on at a time.
BLOCK = 32_768


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one after another, and row offsets."""
    offsets, codes, words = word_codes(texts)
    hashes = word_hashes(words)[codes] if words else np.zeros(0, np.uint64)
    runs = shingles(hashes, width)
    sizes = np.diff(offsets)
    starts, lengths = offsets[:-1], np.maximum(sizes - width + 1, np.minimum(sizes, 1))
    ends = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.empty(ends[-1], np.uint64)
    for row in np.flatnonzero(sizes):
        start, size, own = starts[row], sizes[row], flat[ends[row] : ends[row + 1]]
        if size >= width:
            own[:] = runs[start : start + size - width + 1]
            own.sort()
        else:
            own[0] = xxhash.xxh64_intdigest(hashes[start : start + size].tobytes(), seed=int(size))
    # sorted by row, so that a repeated hash stands beside the first
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[ends[:-1][lengths > 0]] = True
    return flat[new], np.concatenate([[0], np.cumsum(new)])[ends]


def _least(flat: np.ndarray, ends: np.ndarray, full: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The smallest hash of each ``full`` set, a row for each function of ``steps``.

    Sets are taken in blocks that stay in a core's cache over all functions.
    """
    start = flat ^ (flat >> np.uint64(29))
    begins, stops = ends[:-1][full], ends[1:][full]
    found = np.empty((len(steps), len(full)), np.uint64)
    work = np.empty(max(BLOCK, int((stops - begins).max())), np.uint64)
    i = 0
    while i < len(full):
        j = max(i + 1, int(np.searchsorted(stops, begins[i] + BLOCK, "right")))
        part, at = start[begins[i] : stops[j - 1]], begins[i:j] - begins[i]
        values = work[: len(part)]
        for k, step in enumerate(steps):
            np.multiply(part, step, out=values)
            np.minimum.reduceat(values, at, out=found[k, i:j])
        i = j
    return found


def _signatures(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """16-bit MinHash symbols, a row for each set; zeros for empty sets."""
    full = np.flatnonzero(np.diff(ends))
    found = np.zeros((len(ends) - 1, SYMBOLS), np.uint16)
    if len(full):
        steps = mixed(np.arange(1, SYMBOLS + 1, dtype=np.uint64)) | np.uint64(1)
        found[full] = mixed(_least(flat, ends, full, steps)).astype(np.uint16).T
    return found


def _bits(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``BITS`` one-bit MinHash values of each set, packed into 64-bit words."""
    full = np.flatnonzero(np.diff(ends))
    found = np.zeros((len(ends) - 1, BITS), np.uint8)
    if len(full):
        steps = mixed(np.arange(10**6, 10**6 + BITS, dtype=np.uint64)) | np.uint64(1)
        start = flat ^ (flat >> np.uint64(29))
        for k in range(BITS):
            with np.errstate(over="ignore"):
                least = np.minimum.reduceat(start * steps[k], ends[:-1][full])
            found[full, k] = mixed(least) & np.uint64(1)
    return np.packbits(found, axis=1).view(np.int64)


def _keys(signatures: np.ndarray) -> np.ndarray:
    """Each chunk with one symbol left out, hashed with the index of the part."""
    wide = signatures.astype(np.uint64)
    out = np.empty((len(wide), SYMBOLS), np.uint64)
    for slot in range(SYMBOLS):
        chunk, left_out = divmod(slot, CHUNK)
        key = np.full(len(wide), slot, np.uint64)
        for k in range(CHUNK):
            if k != left_out:
                key = mixed((key << np.uint64(16)) ^ wide[:, chunk * CHUNK + k])
        out[:, slot] = key
    return out.view(np.int64)


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, same, signature``; ``same`` is equal for equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, ends = _sets(batch.column("text"), width)
            marks = [
                xxhash.xxh128_digest(flat[a:b].tobytes()) for a, b in zip(ends, ends[1:])
            ]
            symbols = _signatures(flat, ends)
            rows = np.arange(len(ends)) * SYMBOLS
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.array(marks, pa.binary()),
                    _lists(symbols.view(np.int16).ravel(), rows),
                ],
                ["doc_id", "n_shingles", "same", "signature"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, same binary, signature array<smallint>"
    )


def keys_of(sketched: DataFrame) -> DataFrame:
    """``doc_id, key``: the keys of each signature, a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = batch.column("signature").flatten().to_numpy(False)
            keys = _keys(symbols.view(np.uint16).reshape(-1, SYMBOLS))
            ids = batch.column("doc_id").to_numpy(False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, SYMBOLS)), pa.array(keys.ravel())], ["doc_id", "key"]
            )

    return sketched.select("doc_id", "signature").mapInArrow(run, "doc_id long, key long")


def long_signatures(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, bits``: the longer signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            packed = _bits(*_sets(batch.column("text"), width))
            rows = np.arange(len(packed) + 1) * (BITS // 64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _lists(packed.ravel(), rows)], ["doc_id", "bits"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, bits array<long>")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, shingles``: the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, ends = _sets(batch.column("text"), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _lists(flat.view(np.int64), ends)],
                ["doc_id", "shingles"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, shingles array<long>")


def _sizes_allow(percent: int) -> Column:
    small = F.least("n_shingles_a", "n_shingles_b")
    return 100 * small >= percent * F.greatest("n_shingles_a", "n_shingles_b")


def _plausible() -> Column:
    """The signatures of sides a and b do not rule a link out."""
    differing = F.aggregate(
        F.zip_with("signature_a", "signature_b", lambda x, y: (x != y).cast("int")),
        F.lit(0),
        lambda total, x: total + x,
    )
    return differing <= MOST_DIFFERENT


def _bits_allow() -> Column:
    """The longer signatures of sides a and b do not rule a link out."""
    words = range(BITS // 64)
    differing = [F.bit_count(F.col("bits_a")[k].bitwiseXOR(F.col("bits_b")[k])) for k in words]
    return reduce(Column.__add__, differing) <= MOST_BITS


def _whole(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of distinct wanted ``doc_id``s, one row for each."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.join(spread(wanted), "doc_id", "left_semi").dropDuplicates(["doc_id"])


def _side(rows: DataFrame, x: str) -> DataFrame:
    """Columns of one side of a pair: the id is named ``x``, others end in it."""
    return rows.select(
        *[F.col(c).alias(x if c == "doc_id" else f"{c}_{x}") for c in rows.columns]
    )


def confirmed(near: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of distinct (a, b) pairs those with ``100 * intersection >= percent * union``."""
    wanted = near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()
    sets = materialize(shingle_sets(_whole(docs, wanted), width), "sets")
    both = near.join(spread(_side(sets, "a")), "a").join(spread(_side(sets, "b")), "b")
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    either = F.size("shingles_a") + F.size("shingles_b") - shared
    return both.filter(100 * shared >= percent * either).select("a", "b")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    known = materialize(sketches(docs, width), "sketches")
    named = known.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = materialize(named.groupBy("same").agg(F.min("doc_id").alias("doc_id")), "classes")
    reps = materialize(
        known.join(spread(classes), ["same", "doc_id"]).dropDuplicates(["same", "doc_id"]),
        "representatives",
    )
    keys = keys_of(reps)
    hubs = keys.groupBy("key").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n"))
    members = materialize(
        keys.join(spread(hubs.filter("n > 1").drop("n")), "key"), "members"
    )
    stars = members.filter("doc_id != hub").select(
        F.col("hub").alias("a"), F.col("doc_id").alias("b")
    ).distinct()
    # one document under several texts: its classes share a representative id
    again = named.join(spread(classes.withColumnRenamed("doc_id", "rep")), "same").filter(
        "doc_id != rep"
    )
    own = again.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    twice = own.join(spread(reps.select(F.col("doc_id").alias("b")).distinct()), "b", "left_semi")
    slim = reps.select("doc_id", "n_shingles", "signature")
    near = stars.join(spread(_side(slim, "a")), "a").join(spread(_side(slim, "b")), "b").filter(
        _sizes_allow(percent) & _plausible()
    )
    near = materialize(near.select("a", "b"), "near")
    links = materialize(confirmed(near, docs, width, percent), "links")
    first = components(links)
    labelled = materialize(
        members.join(spread(first.withColumnRenamed("node", "doc_id")), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
        .join(
            spread(
                first.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
            ),
            "hub",
            "left",
        )
        .withColumn("hub_component", F.coalesce("hub_component", "hub"))
        .drop("hub"),
        "labelled",
    )
    discard(members)
    mixed_keys = labelled.filter("component != hub_component").select("key").distinct()
    open_rows = materialize(
        labelled.join(spread(mixed_keys), "key", "left_semi")
        .withColumn("stray", F.col("component") != F.col("hub_component"))
        .drop("hub_component"),
        "open",
    )
    discard(labelled)
    bits = materialize(
        long_signatures(_whole(docs, open_rows.select("doc_id").distinct()), width), "bits"
    )
    signed = materialize(bits.join(spread(reps.select("doc_id", "n_shingles")), "doc_id"), "signed")
    discard(bits)
    stored, open_rows = open_rows, open_rows.join(spread(signed), "doc_id")
    rest = _side(open_rows.filter("stray"), "a").join(
        spread(_side(open_rows, "b")),
        (F.col("key_a") == F.col("key_b"))
        & (F.col("component_a") != F.col("component_b"))
        & (~F.col("stray_b") | (F.col("a") < F.col("b")))
        & _sizes_allow(percent)
        & _bits_allow(),
    ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = materialize(rest.distinct().join(spread(near), ["a", "b"], "left_anti"), "rest")
    discard(stored, signed)
    more = confirmed(rest, docs, width, percent)
    known_links = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = components(known_links.unionByName(more).unionByName(twice))
    by_row = (
        known.select("doc_id", "n_shingles", "same")
        .join(spread(classes.withColumnRenamed("doc_id", "rep")), "same", "left")
        .withColumn(
            "rep",
            F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id"))
            .otherwise(F.col("rep")),
        )
        .join(spread(found.withColumnRenamed("node", "rep")), "rep", "left")
    )
    component = F.coalesce("component", "rep")
    return by_row.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def dedup_filter(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, the one with the smallest id, columns as they were."""
    dropped = near_duplicates(docs, width, percent).filter("NOT kept").select(
        F.col("doc_id").alias("__gone")
    )
    return docs.join(spread(dropped.distinct()), F.col("doc_id") == F.col("__gone"), "left_anti")
