"""Quality rules as a short-circuit cascade of DataFrame expressions.

Every rule is a boolean column that is true for a text to be rejected. On a
bounded sample each rule's cost (seconds for the sample rows) and selectivity
(share rejected) is measured; the cascade tries rules in falling order of
rejection per cost, and ``CASE WHEN`` stops at the first that rejects. The order
changes the time and never the verdict.

Cases: a null text has no words and is rejected as too short. Other columns are
passed through; a column of the input that has the name of a result is replaced.
Equal rows get equal verdicts. An empty table gives an empty table.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import bind, text_of

BLANKS = " \t\n\x0b\x0c\r"
SPACES = "[\\x20\\x09-\\x0D]+"
#: Rows that rules are timed on, and the longest text among them. They bound the
#: driver's part; the sample decides the order of rules and nothing else.
SAMPLE_ROWS = 256
SAMPLE_CHARS = 65_536
WINDOW = 5


def words(text: Column) -> Column:
    """Words of a text as an array."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def _count(text: Column, unwanted: str) -> Column:
    return F.length(F.regexp_replace(text, unwanted, "")).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(w: Column) -> Column:
    """Words inside ``WINDOW``-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash. Where two hashes are equal, sorting
    (hash, position) brings equal windows together; the positions of those with
    an equal neighbour, sorted again, cover ``min(WINDOW, gap to the next)``
    words each.
    """

    def from_hashes(h: Column) -> Column:
        keyed = F.transform(h, lambda x, i: F.struct(x.alias("hash"), i.alias("at")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            bind(F.sort_array(keyed), from_sorted)
        )

    def from_sorted(s: Column) -> Column:
        twins = F.filter(
            s,
            lambda x, i: ((i > 0) & (F.get(s, i - 1)["hash"] == x["hash"]))
            | F.coalesce(F.get(s, i + 1)["hash"] == x["hash"], F.lit(False)),
        )
        return bind(F.sort_array(F.transform(twins, lambda x: x["at"])), covered)

    def covered(p: Column) -> Column:
        gaps = F.transform(
            p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))
        )
        return F.aggregate(gaps, F.lit(0), lambda total, x: total + x)

    def from_words(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - WINDOW)
        hashes = F.transform(
            starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
        )
        return F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(bind(hashes, from_hashes))

    return bind(w, from_words).cast("long")


#: What rules measure, from the text and its words.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, w: F.size(w).cast("long"),
    "word_chars": lambda text, w: F.length(F.translate(text, BLANKS, "")).cast("long"),
    "n_symbols": lambda text, w: _count(text, "[^#*$%&|<>]+"),
    "n_dup_lines": lambda text, w: duplicate_lines(text),
    "n_repeat_words": lambda text, w: repeated_words(w),
    "n_lines": lambda text, w: F.size(F.split(text, "\n")),
    "n_exclamations": lambda text, w: _count(text, "[^!]+"),
    "n_capitals": lambda text, w: _count(text, "\\P{Lu}+"),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Measures:
    """``measures[name]``: a column of the frame if it has it, or else the expression."""

    def __init__(self, text: Column, w: Column, there: tuple[str, ...] = ()):
        self.text, self.words, self.there = text, w, there

    def __getitem__(self, name: str) -> Column:
        return F.col(name) if name in self.there else MEASURES[name](self.text, self.words)


@dataclass(frozen=True)
class Rule:
    """A name and an expression over the measures that is true to reject a text."""

    name: str
    rejects: Callable[[Measures], Column]


TOO_SHORT = Rule("too_short", lambda m: m["n_words"] < 10)
REPEATS = Rule("repeats", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"])
#: Rules beside the two base ones; thresholds lie far outside of clean prose.
EXTRA = (
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("exclamations", lambda m: 2 * m["n_exclamations"] > m["n_words"]),
    Rule("shouting", lambda m: 10 * m["n_capitals"] > 4 * m["word_chars"]),
    Rule(
        "word_length",
        lambda m: ~m["word_chars"].between(2 * m["n_words"], 12 * m["n_words"]),
    ),
    Rule("same_lines", lambda m: 3 * m["n_dup_lines"] > m["n_lines"]),
)
RULES = (TOO_SHORT, REPEATS, *EXTRA)
WORDS = "__words"


def measured(docs: DataFrame, rules=RULES, column: str = "text") -> list[tuple[Rule, float, float]]:
    """Each rule with its seconds and its share of rejections on a sample."""
    rows = (
        docs.select(text_of(column).alias("text"))
        .filter(F.length("text") <= SAMPLE_CHARS)
        .take(SAMPLE_ROWS)
    )
    sample = docs.sparkSession.createDataFrame(rows, "text string").coalesce(1).cache()
    measures = Measures(F.col("text"), words(F.col("text")))

    def timed(rejects: Column) -> tuple[float, float]:
        share = sample.agg(F.avg(rejects.cast("int")))
        share.collect()  # compile the code first
        began = time.perf_counter()
        value = share.first()[0]
        return time.perf_counter() - began, value or 0.0

    idle, _ = timed(F.col("text").isNull())
    found = [(rule, *timed(rule.rejects(measures))) for rule in rules]
    sample.unpersist()
    return [(rule, max(seconds - idle, 1e-4), share) for rule, seconds, share in found]


def ordered(docs: DataFrame, rules=RULES, column: str = "text") -> list[Rule]:
    """Rules by falling rejection per cost."""
    found = measured(docs, rules, column)
    return [rule for rule, _, _ in sorted(found, key=lambda x: -x[2] / x[1])]


def verdict(measures: Measures, rules: list[Rule]) -> Column:
    """The first rule that rejects, null for a text that all rules keep."""
    out = F.when(F.lit(False), F.lit(""))
    for rule in rules:
        out = out.when(rule.rejects(measures), F.lit(rule.name))
    return out


def quality_filter(docs: DataFrame, rules=RULES, column: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their columns as they were."""
    text = text_of(column)
    order = ordered(docs, rules, column)
    return docs.filter(verdict(Measures(text, words(text)), order).isNull())


def quality_report(docs: DataFrame, extra=EXTRA, column: str = "text") -> DataFrame:
    """Base counts of every document, the base rules, and the cascade's verdict.

    The base rules come first here because their counts are computed for every
    row anyway; the measured order holds among the others.
    """
    text = text_of(column)
    order = ordered(docs, extra, column)
    plain = Measures(text, F.col(WORDS))
    counted = docs.withColumn(WORDS, words(text)).withColumns({k: plain[k] for k in BASE})
    known = Measures(text, F.col(WORDS), BASE)
    failed = TOO_SHORT.rejects(known) | REPEATS.rejects(known)
    kept = F.when(F.col("base_failed"), False).otherwise(verdict(known, order).isNull())
    return counted.withColumn("base_failed", failed).withColumn("kept", kept).drop(WORDS)
