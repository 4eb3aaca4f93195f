"""Words of whole texts as arrays, for code that runs inside Python tasks.

A word is a run of characters other than space and the five ASCII control
characters U+0009 to U+000D. Everything here works on one slice of an Arrow
batch, so memory follows the slice and not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_CHARS = 4_000_000
SEED_STEP = np.uint64(0x9E3779B97F4A7C15)


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one holds about ``SLICE_CHARS`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, base + SLICE_CHARS, "right")))
            # copied, as some Arrow kernels misread arrays that begin inside a buffer
            yield batch.take(pa.array(np.arange(start, end)))
            start = end


def word_codes(
    texts: pa.Array, lower: bool = True
) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Row offsets into the codes, the code of every word, and the word of every code."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(False)
    if not real.all():
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        flat = flat.filter(pa.array(real))
    coded = flat.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    return offsets, coded.indices.to_numpy(False), words


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes, the same in every process."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit mix in which every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` words; runs may cross row borders."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    count = len(hashes) - width + 1
    with np.errstate(over="ignore"):
        out = hashes[:count].copy()
        for shift in range(1, width):
            out = mixed(out * SEED_STEP + hashes[shift : shift + count])
    return out
