"""Licence texts found by the Dice coefficient over word bigrams.

A text is normalised (lower case; letters, digits and dots inside of words kept,
so comment marks, line breaks and runs of blanks do not matter) and every pair of
neighbouring words is a bigram. A window of a text begins at a bigram of a
template, spans as many bigrams as the template has distinct ones, and ends with
the last bigram of the template in that span. Its Dice coefficient is
2 * shared / (sizes of both sets of bigrams).

Texts without any of a few words, one of which every match must hold, are not split
at all. Size bounds prune twice. Dice reaches ``least`` only if window and template share
``least / (2 - least)`` of the template's bigrams, as neither set is smaller than
what they share. So a template is a candidate for a text only if the whole text
has that many of its bigrams, and a window only if that many places of the
template's bigrams lie in its span. None of this loses a match. Of windows that
overlap the best one stands: the highest coefficient, then the larger template,
then the first in order, then the first place. So a text is named after the
nearest template and not after each that resembles it.

Only DataFrame functions are used; templates are literals, so nothing is joined,
shuffled or broadcast. Bigrams are compared by 64-bit hashes. ``templates`` may be
any list of (name, text), such as whole licence texts read by ``read_templates``.

Cases: a null text is empty and matches nothing, nor does a text of one word. Texts
of any length are scanned whole. Every row gives one row, repeated rows too; extra
columns are passed through, and one named ``licenses`` is replaced. Templates without
two words match nothing. An empty table or list of templates gives no match.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .licence_texts import TEMPLATES
from .tables import bind, text_of

LEAST = 0.7
DOC = "__doc"
_MATCH = "struct<license:string,dice:double,shared:int,start:int,stop:int>"


def normalised(text: Column) -> Column:
    """Lower-case words of letters and digits, one space between them; dots at the ends
    of words go with what separates them."""
    between = "(?:\\.(?<!\\.\\.)\\.*+)?+[^\\p{L}\\p{N}.][^\\p{L}\\p{N}]*+"
    return F.btrim(F.regexp_replace(F.lower(text), between, " "), F.lit(" ."))


def words(text: Column) -> Column:
    """Words of a normalised text."""
    return F.split(normalised(text), " ")


def bigrams(w: Column) -> Column:
    """A hash for each pair of neighbouring words, in order."""
    firsts = F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0)))
    return F.transform(firsts, lambda x, i: F.xxhash64(x, F.get(w, i + 1)))


def read_templates(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(file name, text) of every file of a folder, for ``templates``; a list of licences
    is small by nature."""
    files = spark.read.text(folder, wholetext=True)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return [tuple(r) for r in files.select(name, "value").orderBy(name).collect()]


def _template_words(spark: SparkSession, texts: list[str]) -> list[tuple[list[str], list[int]]]:
    """Words and hashes of bigrams, in order, of each template."""
    if not texts:
        return []
    both = F.transform(
        F.array(*map(F.lit, texts)),
        lambda x: bind(words(x), lambda w: F.struct(w.alias("words"), bigrams(w).alias("grams"))),
    )
    return [(r.words, r.grams) for r in spark.range(1).select(both).first()[0]]


def _need(size: int, least: float) -> int:
    """Bigrams of a template that a match must share; the margin keeps rounding from
    asking for one too many."""
    return max(1, math.ceil(size * least / (2 - least) - 1e-9))


def _anchors(known: list[list[str]], least: float) -> list[str]:
    """Strings of which every text with a match holds one.

    A match shares ``need`` bigrams of its template. Words are taken until fewer
    bigrams than that are without one of them: long ones first, as these are rare in
    other texts, and of these the one in most bigrams.
    """
    chosen: list[str] = []
    for w in known:
        grams = set(zip(w, w[1:]))
        while True:
            bare = [g for g in grams if not any(a in x for a in chosen for x in g)]
            if len(bare) < _need(len(grams), least):
                break
            found = Counter(x for g in bare for x in set(g))
            chosen.append(max(found, key=lambda x: (min(len(x), 7), found[x], x)))
    return sorted(a for a in set(chosen) if not any(b != a and b in a for b in chosen))


def _matches(grams: Column, t: Column, least: float) -> Column:
    """Windows of a text that match template ``t``."""
    size, need = t["size"], t["need"]

    def window(hits: Column, x: Column) -> Column:
        near = F.filter(F.slice(hits, x["nth"] + 1, size), lambda h: h < x["start"] + size)
        return bind(F.array_max(near), lambda last: rated(x["start"], last))

    def rated(start: Column, last: Column) -> Column:
        inside = F.array_distinct(F.slice(grams, start + 1, last - start + 1))
        return bind(
            inside,
            lambda g: bind(
                F.size(F.array_intersect(g, t["grams"])),
                lambda shared: F.struct(
                    (2.0 * shared / (F.size(g) + size)).alias("dice"),
                    size.alias("size"),
                    (-t["nth"]).alias("order"),
                    (-start).alias("begin"),
                    shared.alias("shared"),
                    (last + 2).alias("stop"),
                    t["license"].alias("license"),
                ),
            ),
        )

    def windows(hits: Column) -> Column:
        starts = F.transform(
            hits,
            lambda h, j: F.struct(
                h.alias("start"), j.alias("nth"), F.get(hits, j + need - 1).alias("reach")
            ),
        )
        dense = F.filter(starts, lambda x: x["reach"] < x["start"] + size)
        return F.filter(F.transform(dense, lambda x: window(hits, x)), lambda x: x["dice"] >= least)

    places = F.sequence(F.lit(0), F.size(grams) - 1)
    return bind(
        F.filter(places, lambda i: F.array_contains(t["grams"], F.get(grams, i))), windows
    )


def _standing(found: Column) -> Column:
    """The best of overlapping windows, in the order of the text."""

    def add(out: Column, x: Column) -> Column:
        begin = -x["begin"]
        taken = F.exists(out, lambda o: (o["start"] < x["stop"]) & (begin < o["stop"]))
        one = F.struct(
            x["license"].alias("license"), x["dice"].alias("dice"), x["shared"].alias("shared"),
            begin.alias("start"), x["stop"].alias("stop"),
        )
        return F.when(taken, out).otherwise(F.concat(out, F.array(one)))

    none = F.array().cast(f"array<{_MATCH}>")
    picked = F.aggregate(F.sort_array(found, asc=False), none, add)
    return F.array_sort(picked, lambda a, b: a["start"] - b["start"])


def license_scan(
    docs: DataFrame, least: float = LEAST, column: str = "text", templates=TEMPLATES
) -> DataFrame:
    """``docs`` with ``licenses``, every passage that matches a template.

    A passage is (license, dice, shared, start, stop, passage): positions of words in the
    normalised text, the end exclusive, and these words.
    """
    sets = _template_words(docs.sparkSession, [text for _, text in templates])
    known = [(name, w, sorted(set(g))) for (name, _), (w, g) in zip(templates, sets) if g]
    passage = f"array<{_MATCH[:-1]},passage:string>>"
    if not known:
        return docs.withColumn("licenses", F.array().cast(passage))
    every = sorted({g for _, _, grams in known for g in grams})
    listed = F.array(*[
        F.struct(
            F.lit(name).alias("license"),
            F.lit(nth).alias("nth"),
            F.lit(len(grams)).alias("size"),
            F.lit(_need(len(grams), least)).alias("need"),
            F.lit(grams).cast("array<bigint>").alias("grams"),
        )
        for nth, (name, _, grams) in enumerate(known)
    ])
    anchors = _anchors([w for _, w, _ in known], least)
    likely = reduce(lambda a, b: a | b, [F.col("lower").contains(x) for x in anchors])
    whole = docs.select(
        F.struct(*docs.columns).alias(DOC), F.lower(text_of(column)).alias("lower")
    ).select(
        DOC,
        F.when(likely, words(F.col("lower")))
        .otherwise(F.array().cast("array<string>"))
        .alias("words"),
    )
    paired = whole.select(DOC, "words", bigrams(F.col("words")).alias("grams"))
    shared = paired.select(
        "*", F.array_intersect("grams", F.lit(every).cast("array<bigint>")).alias("shared")
    )
    candidates = F.filter(
        listed, lambda t: F.size(F.array_intersect(F.col("shared"), t["grams"])) >= t["need"]
    )
    found = F.flatten(
        F.transform(candidates, lambda t: _matches(F.col("grams"), t, least))
    )
    smallest = min(_need(len(grams), least) for _, _, grams in known)
    standing = F.when(F.size("shared") >= smallest, _standing(found)).otherwise(
        F.array().cast(f"array<{_MATCH}>")
    )
    licences = F.transform(
        standing,
        lambda x: F.struct(
            *[x[c].alias(c) for c in ("license", "dice", "shared", "start", "stop")],
            F.array_join(
                F.slice(F.col("words"), x["start"] + 1, x["stop"] - x["start"]), " "
            ).alias("passage"),
        ),
    )
    return shared.select(
        *[F.col(DOC)[c].alias(c) for c in docs.columns if c.lower() != "licenses"],
        licences.alias("licenses"),
    )
