"""What each filter removes, in every order the filters could run in.

Five filters judge a text: A fewer than 100 words; B fewer than 80 distinct words
in 100; C more than 10 capitals in 100 characters; D a symbol; E the same text as
a document with a smaller id. Every document becomes one mask of the filters it
fails, and all figures are sums over counts of masks: at most 32 for each part
and pair of labels, whatever the number of documents.

Only E looks at other documents. A counting Bloom filter comes first: each text
raises three cells of the bucket its hash names, tasks add up their own cells, the
partial counts are merged, and cells that count one text in all are kept as bitmaps.
A text with such a cell is the only one of its kind; whatever its size, it is never
shuffled. Possible repeats are grouped by their full text for the smallest id, and
only these ids go back: a possible repeat that is no smallest id fails E. Copies
combine before the shuffle, so a large group reaches it as one row per task.

The bitmaps grow with the documents, eight cells for each, up to ``MOST_BUCKETS``
buckets of 4 KB (128 MB), and are broadcast. Beyond 130 million documents cells fill
up: fewer texts are cleared and more are shuffled, with the same result.

Cases: a null text is empty, and empty texts are copies of one another. A null part
is the empty text. A document without id never fails E and makes no other fail it;
rows with one id fail it if a smaller id has their text. Several labels of one id
count as good or toxic if one of them is. Without documents there are no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import discard, materialize, text_of
from .words import slices, word_codes

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MOST_CAPITALS = 100, 80, 10
SYMBOLS = b"#$%&*|"
#: Cells of one bucket, as many as one bitmap of Spark's bitmap functions holds.
BUCKET_CELLS = 32_768
CELLS_PER_TEXT = 8
PROBES = 3
#: Bound of what is broadcast: 4 KB for each.
MOST_BUCKETS = 1 << 15


def _sums(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])[offsets])


def text_masks(texts: pa.Array) -> np.ndarray:
    """Bits 0 to 3 for the filters A to D each text fails."""
    texts = texts.cast(pa.large_string())
    word_ends, codes, vocabulary = word_codes(texts, lower=False)
    n_words = np.diff(word_ends)
    rows = np.repeat(np.arange(len(n_words)), n_words)
    pairs = np.unique(rows * max(1, len(vocabulary)) + codes)
    distinct = np.bincount(pairs // max(1, len(vocabulary)), minlength=len(n_words))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    chars = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    chars, offsets = chars[offsets[0] : offsets[-1]], offsets - offsets[0]
    capitals = _sums((chars >= ord("A")) & (chars <= ord("Z")), offsets)
    points = _sums((chars & 0xC0) != 0x80, offsets)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    fails = [
        n_words < MIN_WORDS,
        100 * distinct < MIN_DISTINCT * n_words,
        100 * capitals > MOST_CAPITALS * points,
        _sums(symbol[chars], offsets) > 0,
    ]
    return sum(failed.astype(np.int32) << bit for bit, failed in enumerate(fails))


def text_flags(docs: DataFrame, part: str = "lang") -> DataFrame:
    """``doc_id, part, mark, mask``: a hash of the text, and the filters A to D it fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            masks = text_masks(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(masks, pa.int32())], ["doc_id", "part", "mark", "mask"]
            )

    text = text_of().alias("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("mark"),
        text,
    ).mapInArrow(run, "doc_id long, part string, mark long, mask int")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("mark", F.lit(0)), F.lit(buckets)).alias("bucket")


def _cells() -> Column:
    cells = [F.pmod(F.xxhash64("mark", F.lit(k)), F.lit(BUCKET_CELLS)) for k in range(1, PROBES + 1)]
    return F.array_distinct(F.array(*cells))


def lone_cells(marks: DataFrame, buckets: int) -> DataFrame:
    """``bucket, lone``: a bitmap of the cells that one single text has raised.

    The counters of all tasks are added up cell by cell, and packed once final.
    """
    raised = marks.select(_bucket(buckets), F.explode(_cells()).alias("cell"))
    counts = raised.groupBy("bucket", "cell").agg(F.count("*").alias("texts"))
    lone = counts.filter("texts = 1").groupBy("bucket")
    return lone.agg(F.expr("bitmap_construct_agg(cell)").alias("lone"))


def with_possible(rows: DataFrame, sketch: DataFrame, buckets: int) -> DataFrame:
    """Adds ``possible``: false for texts that the merged sketch shows to be unique."""
    byte = lambda cell: F.conv(
        F.hex(F.substr(F.col("lone"), F.shiftright(cell, 3).cast("int") + 1, F.lit(1))), 16, 10
    ).cast("int")
    alone = F.exists(_cells(), lambda cell: F.getbit(byte(cell), cell % 8) == 1)
    joined = rows.withColumn("bucket", _bucket(buckets)).join(
        F.broadcast(sketch), "bucket", "left"
    )
    return joined.withColumn(
        "possible", F.col("lone").isNull() | ~F.coalesce(alone, F.lit(False))
    ).drop("bucket", "lone")


def first_ids(docs: DataFrame, sketch: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, mark``: the smallest id of each text that may occur more than once."""
    rows = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    )
    rows = rows.withColumn("mark", F.xxhash64("text"))
    possible = with_possible(rows, sketch, buckets).filter("possible")
    least = possible.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    return least.select("doc_id", F.xxhash64("text").alias("mark"))


def failed_filters(docs: DataFrame, part: str = "lang") -> DataFrame:
    """``doc_id, part, mask`` of every document, bit 4 for a text seen before."""
    flags = materialize(text_flags(docs, part), "flags")
    wanted = -(-flags.count() * CELLS_PER_TEXT // BUCKET_CELLS)
    buckets = min(max(wanted, 1), MOST_BUCKETS)
    sketch = materialize(lone_cells(flags, buckets), "sketch")
    first = materialize(first_ids(docs, sketch, buckets), "first-ids")
    judged = with_possible(flags, sketch, buckets).join(
        first.withColumn("first", F.lit(True)), ["doc_id", "mark"], "left"
    )
    again = F.col("possible") & F.col("first").isNull() & F.col("doc_id").isNotNull()
    masks = judged.select(
        "doc_id", "part", F.col("mask").bitwiseOR(F.when(again, 16).otherwise(0)).alias("mask")
    )
    stored = materialize(masks, "masks")
    discard(flags, sketch, first)
    return stored


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, docs, good, toxic``: how many documents fail exactly these filters."""
    flag = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        flag("quality").alias("is_good"), flag("toxic").alias("is_toxic")
    )
    joined = masks.join(known, "doc_id", "left")
    return joined.groupBy("part", "mask").agg(
        F.count("*").alias("docs"),
        F.count_if(F.coalesce("is_good", F.lit(False))).alias("good"),
        F.count_if(F.coalesce("is_toxic", F.lit(False))).alias("toxic"),
    )


def filter_orders(names: Sequence[str]) -> Column:
    """Every step of every order of the filters, with the bits that ran before it."""
    steps = []
    for order in permutations(range(len(names))):
        before = 0
        for place, bit in enumerate(order):
            text = "".join(names[k] for k in order)
            steps.append({"filter_order": text, "step": place + 1, "bit": 1 << bit, "before": before})
            before |= 1 << bit
    shape = "array<struct<filter_order string, step int, bit int, before int>>"
    return F.from_json(F.lit(json.dumps(steps)), shape)


def interactions(counts: DataFrame, names: Sequence[str] = FILTERS) -> DataFrame:
    """Audit rows of each part, order and step, from ``mask_counts``.

    All figures are sums of mask counts, the Shapley share too: a document that
    fails ``k`` filters is removed by each of them in a ``k``-th of all orders.
    """
    orders = math.factorial(len(names))
    every = counts.select("*", F.inline(filter_orders(names)))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    fresh = F.col("mask").bitwiseAND(F.col("before")) == 0
    lonely = F.col("mask") == F.col("bit")
    share = F.col("docs") * F.expr(f"{orders} div bit_count(mask)")
    total = lambda of, when: F.sum(F.when(when, of).otherwise(0)).cast("long")
    docs = F.col("docs")
    return every.groupBy("part", "filter_order", "step").agg(
        total(docs, fresh & ~fails).alias("kept"),
        total(docs, fresh & fails).alias("removed"),
        total(docs, ~fresh & fails).alias("redundant"),
        total(docs, lonely).alias("unique_fails"),
        total(F.col("good"), fresh & fails).alias("good_lost"),
        total(F.col("toxic"), fresh & fails).alias("toxic_lost"),
        total(share, fails).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The audit of the five filters over all documents, by part."""
    return interactions(mask_counts(failed_filters(docs, part), labels))
