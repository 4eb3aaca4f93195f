"""Mixing sources to target weights along a curriculum.

Every source has a schedule, its weight over training time from 0 to 1 as a broken
line. Its area is the weight of the source in the whole mix. Targets are the shares
of all wanted words by weight, stopped at ``most`` times the source's size; what is
too much goes to the others by weight until none is above.

The documents of a source stand in an order given by a hash of their id, as often
as the target needs: whole rounds first, then a part of one, whose last document is
cut, so that every source gives its target to the word. The running number of words
of a source is set against the words its schedule has asked for so far, and the
inverse of that integral is the time at which a copy of a document is read. Copies
of all sources, range-sorted by time, are the training order.

Running numbers are two-level prefix sums over range slices, so a source of any size
is spread over many tasks; the number of sources is not bounded either. Words are
counted in one scan of the texts, after which only ids, sizes and hashes move.

Cases: a null text has no words. Documents without words are not read: nothing is
taken of them. The null source is one source, the last. A null id is an id like
others. Equal rows (id, source and text) are copies that follow one another, each
with its own place. Without words, targets are 0; without documents there are no
rows. The result depends on the documents alone, not on partitions or row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import running_total
from .tables import materialize, text_of

WORD = r"[^\x20\x09-\x0D]+"
Schedule = Sequence[tuple[float, float]]
#: Sources take these in turn: falling, rising and falling, rising; mean weights 5, 2, 1.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 7.0), (1.0, 3.0)),
    ((0.0, 1.0), (0.5, 3.0), (1.0, 1.0)),
    ((0.0, 0.0), (1.0, 2.0)),
)
SHARE, MOST = 1.5, 2
#: Equal rows numbered by one task at a time.
CHUNK = 10_000


def areas(schedule: Schedule) -> list[float]:
    """The integral of a schedule from its begin to each of its points."""
    out = [0.0]
    for (t, a), (u, b) in zip(schedule, schedule[1:]):
        out.append(out[-1] + (a + b) / 2 * (u - t))
    return out


def time_of(part: Column, schedule: Schedule) -> Column:
    """The time by which a schedule has asked for ``part`` (0 to 1) of all it asks for.

    The inverse of a quadratic in each straight piece, in the form that also holds
    for level pieces and for those that begin at weight 0.
    """
    sums = areas(schedule)
    wanted = part * F.lit(sums[-1])
    found = F.lit(schedule[-1][0])
    for k in reversed(range(len(schedule) - 1)):
        (t, a), (u, b) = schedule[k : k + 2]
        rest = wanted - F.lit(sums[k])
        root = F.sqrt(F.greatest(F.lit(a * a) + rest * F.lit(2 * (b - a) / (u - t)), F.lit(0.0)))
        inside = F.lit(t) + F.when(rest > 0, rest * 2 / (root + a)).otherwise(0.0)
        found = F.when(wanted <= F.lit(sums[k + 1]), inside).otherwise(found)
    return found


def documents_of(docs: DataFrame) -> DataFrame:
    """``source, doc_id, content, size, copies``: distinct documents with their words."""
    text = text_of()
    return (
        docs.select(
            F.col("source").cast("string").alias("source"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(text).alias("content"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        )
        .groupBy("source", "doc_id", "content", "size")
        .agg(F.count("*").alias("copies"))
    )


def source_targets(
    documents: DataFrame, schedules: Sequence[Schedule], share: float, most: int
) -> DataFrame:
    """``source, turn, source_size, target``: the words the mix wants of each source."""
    sizes = documents.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size")
    )
    order = [F.asc_nulls_last("source")]
    ranked = running_total(sizes, order, F.lit(1), name="rank")
    weights = F.array(*[F.lit(areas(s)[-1]) for s in schedules])
    turn = (F.col("rank") % len(schedules)).cast("int")
    known = ranked.withColumn("turn", turn).withColumn("weight", F.get(weights, turn))
    known = materialize(known.withColumn("limit", most * F.col("source_size")), "sources")
    level = _level(known, share)
    target = F.least(F.lit(level) * F.col("weight"), F.col("limit").cast("double"))
    return known.select("source", "turn", "source_size", target.alias("target"))


def _level(sources: DataFrame, share: float) -> float:
    """Words for each unit of weight, once no target is above its limit."""
    words, weight, sources_left = sources.agg(
        F.sum("source_size"), F.sum("weight"), F.count("*")
    ).first()
    if not words or not weight:
        return 0.0
    wanted = share * words
    level = wanted / weight
    while True:
        above = F.lit(level) * F.col("weight") > F.col("limit")
        full, weight, left = sources.agg(
            F.sum(F.when(above, F.col("limit")).otherwise(0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.count_if(~above),
        ).first()
        if left == sources_left or not weight:
            return level
        sources_left, level = left, (wanted - full) / weight


def mixed(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 1,
) -> DataFrame:
    """A row for each document, sorted by the time at which it is first read.

    ``doc_id, source, content, size, source_size, target, taken, reads``: ``reads``
    holds ``position`` and ``words`` of each time the document is read.
    """
    documents = materialize(documents_of(docs), "documents")
    targets = source_targets(documents, schedules, share, most)
    shuffled = documents.withColumn(
        "mark", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    )
    order = [F.asc_nulls_last("source"), "mark", "doc_id", "content"]
    words = F.col("size") * F.col("copies")
    placed = running_total(shuffled, order[1:], words, ["source"])
    wanted = targets.select(
        F.col("source").alias("from_source"), "turn", "source_size", "target",
        F.floor(F.col("target") + 0.5).alias("asked"),
    )
    same = F.col("source").eqNullSafe(F.col("from_source"))
    joined = placed.join(wanted, same)
    whole = F.expr("CASE WHEN source_size > 0 THEN asked DIV source_size ELSE 0 END")
    more = F.col("asked") - F.col("rounds") * F.col("source_size")
    single = (
        joined.withColumn("rounds", whole)
        .withColumn("rest", F.least(F.greatest(more - F.col("before"), F.lit(0)), words))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(CHUNK))).alias("low"))
        .withColumn("high", F.least(F.col("low") + CHUNK, F.col("copies")) - 1)
        .select("*", F.explode(F.sequence("low", "high")).alias("copy"))
        .withColumn("start", F.col("before") + F.col("copy") * F.col("size"))
        .withColumn(
            "cut",
            F.least(F.greatest(F.col("rest") - F.col("copy") * F.col("size"), F.lit(0)), F.col("size")),
        )
    )
    times = F.col("rounds") + F.when(F.col("cut") > 0, 1).otherwise(0)
    read = F.when(
        (F.col("size") > 0) & (times > 0), F.sequence(F.lit(0).cast("long"), times - 1)
    ).otherwise(F.array().cast("array<long>"))
    reads = F.transform(
        read,
        lambda n: F.struct(
            _time(n * F.col("source_size") + F.col("start"), schedules).alias("position"),
            F.when(n < F.col("rounds"), F.col("size")).otherwise(F.col("cut")).alias("words"),
        ),
    )
    taken = F.col("rounds") * F.col("size") + F.col("cut")
    found = single.select(
        "doc_id", "source", "content", "size", "source_size", "target",
        taken.alias("taken"), reads.alias("reads"), "mark", "copy",
    )
    # what is never read stands behind the rest, spread by its hash
    late = 1.0 + F.conv(F.substring("mark", 1, 8), 16, 10).cast("double")
    when = F.coalesce(F.get("reads", F.lit(0))["position"], late)
    return found.orderBy(when, "mark", "doc_id", "content", "copy").drop("mark", "copy")


def _time(words: Column, schedules: Sequence[Schedule]) -> Column:
    """Training time at which a source has been asked for so many words."""
    part = words.cast("double") / F.col("asked").cast("double")
    found = [time_of(part, s) for s in schedules]
    choices = [F.when(F.col("turn") == k, t) for k, t in enumerate(found)]
    return reduce(lambda a, b: F.coalesce(a, b), choices)


def training_order(docs: DataFrame, **how) -> DataFrame:
    """Whole rows of ``docs`` in training order, with ``position`` and ``words`` to read.

    A document read twice is there twice. Rows equal in id, source and text give
    their other columns from any one of them.
    """
    taken = [c for c in ("position", "words") if c in docs.columns]
    if taken:
        raise ValueError(f"columns {taken} are those of the training order")
    keys = {"doc_id": "long", "source": "string"}
    plan = mixed(docs, **how).select(
        *[F.col(c).alias(f"mixed {c}") for c in (*keys, "content")],
        F.explode("reads").alias("read"),
    )
    own = docs.withColumn("mixed key", F.xxhash64(text_of()))
    own = own.dropDuplicates(["doc_id", "source", "mixed key"])
    same = F.col("mixed key") == F.col("mixed content")
    for name, kind in keys.items():
        same = same & F.col(name).cast(kind).eqNullSafe(F.col(f"mixed {name}"))
    joined = own.join(plan, same)
    return joined.select(
        *docs.columns, F.col("read.position").alias("position"), F.col("read.words").alias("words")
    ).orderBy("position", F.md5(F.col("doc_id").cast("string")), "doc_id")
