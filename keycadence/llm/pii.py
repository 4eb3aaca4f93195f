"""Personal data: base patterns, and contexts bootstrapped from what they find.

Base spans come from four regular expressions with checks. They are the seeds of
a graph between instances (kind and value) and lexical patterns (the two words
before, or the two words behind). Patterns and instances score each other in
turns: a pattern is as good as the mean score of the distinct instances it
extracts, an instance as good as 1 minus the product of what its patterns leave
in doubt. Patterns that reach ``PRECISION`` over at least ``SUPPORT`` distinct
instances extract looser candidates of their kind that no base span covers.

Only DataFrame functions are used. Edges are counted per (pattern, instance)
before they are joined, so a pattern that a third of all rows share is one row
there. Positions are code points, the end exclusive.

Cases: a null text is empty and has no spans. Rows are kept apart by a row id, so
repeated rows and null or repeated ids get a result each. An input without any
seed finds base spans only (none). Extra columns are passed through by
``redacted``; ``found_spans`` keeps those asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import bind, materialize, text_of

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
#: Possessive forms of the base patterns: the same matches, without backtracking
#: into long runs and without a second start inside of one.
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[ -]?[0-9]){12}(?:[ -]?[0-9])*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried at all.
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: Looser shapes that contexts may confirm.
LOOSE = {
    "email": r"(?<!\S)(?:[^\s@]{1,64}+@|[^\s@]{1,64}? ?(?:\(at\)|\[at\]) ?)[^\s@]{1,253}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:[.,][0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ ._/-]?[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9])\(?[0-9]{2,4}\)?(?:[ ./-]{1,2}[0-9]{2,4}){2,4}(?![0-9])",
}
CONTEXT_CHARS = 64
ROUNDS = 3
SUPPORT = 5
PRECISION = 0.8
ROW = "__row"


def matches(text: Column, pattern: str) -> Column:
    """``array<struct<start, value>>`` of all matches, from the gaps between them."""

    def placed(found: Column, gaps: Column) -> Column:
        steps = F.transform(
            found, lambda x, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), x.alias("value"))
        )
        empty = F.struct(
            F.lit(0).alias("at"),
            F.array().cast("array<struct<start:int,value:string>>").alias("out"),
        )

        def step(state: Column, x: Column) -> Column:
            start = state["at"] + x["gap"]
            one = F.array(F.struct(start.alias("start"), x["value"].alias("value")))
            return F.struct(
                (start + F.length(x["value"])).alias("at"), F.concat(state["out"], one).alias("out")
            )

        return F.aggregate(steps, empty, step, lambda state: state["out"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return bind(found, lambda x: bind(F.split(text, pattern), lambda gaps: placed(x, gaps)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """True for digits that pass the Luhn check."""

    def part(i: Column) -> Column:
        digit = F.substring(digits, -1 - i, F.lit(1)).cast("int") * (1 + i % 2)
        return digit - F.when(digit > 9, 9).otherwise(0)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    total = F.aggregate(F.transform(places, part), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3,
        ) & F.forall(
            F.split(value, r"\."),
            lambda p: F.substring(F.concat(F.lit("00"), p), -3, 3).cast("int") <= 255,
        )
    if kind == "card":
        return bind(
            _digits(value),
            lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False),
        )
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _spans(text: Column, kind: str, pattern: str, checked: bool) -> Column:
    rank = KINDS.index(kind)
    found = matches(text, pattern)
    if checked:
        found = F.filter(found, lambda x: _valid(kind, x["value"]))
    out = F.transform(
        found,
        lambda x: F.struct(
            F.lit(rank).alias("kind"),
            x["start"].alias("start"),
            (x["start"] + F.length(x["value"])).alias("end"),
            x["value"].alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")
    there = text.contains(NEEDED[kind]) if checked and NEEDED[kind] else text.rlike(pattern)
    return F.when(there, out).otherwise(none)


def base_spans(text: Column) -> Column:
    """All base spans, by kind and then start."""
    return F.concat(*[_spans(text, kind, BASE[kind], True) for kind in KINDS])


def _words(part: Column) -> Column:
    return F.filter(F.split(F.lower(part), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _with_context(text: Column, spans: Column, seed: bool) -> Column:
    """Spans with the two words before and the two behind; null where there are fewer."""

    def two(words: Column, last: bool) -> Column:
        picked = F.slice(words, -2 if last else 1, 2)
        return F.when(F.size(words) >= 2, F.concat_ws(" ", picked))

    def one(x: Column) -> Column:
        begin = F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0))
        before = F.substring(text, begin + 1, x["start"] - begin)
        behind = F.substring(text, x["end"] + 1, F.lit(CONTEXT_CHARS))
        return F.struct(
            *[x[c].alias(c) for c in ("kind", "start", "end", "value")],
            bind(_words(before), lambda w: two(w, True)).alias("before"),
            bind(_words(behind), lambda w: two(w, False)).alias("behind"),
            F.lit(seed).alias("seed"),
        )

    return F.transform(spans, one)


def _loose_spans(text: Column, base: Column) -> Column:
    """Looser candidates that touch no base span."""
    found = F.concat(*[_spans(text, kind, LOOSE[kind], False) for kind in KINDS])
    return F.filter(
        found,
        lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )


def scored_patterns(candidates: DataFrame) -> DataFrame:
    """``kind, side, words`` of the patterns that may extract.

    ``candidates`` has a row per place: kind, value, before, behind, seed.
    """
    sides = F.array(*[
        F.struct(F.lit(side).alias("side"), F.col(side).alias("words"))
        for side in ("before", "behind")
    ])
    places = candidates.select("kind", "value", "seed", F.explode(sides).alias("s")).select(
        "kind", "value", "seed", "s.*"
    )
    edges = materialize(
        places.filter("words IS NOT NULL")
        .groupBy("kind", "side", "words", "value")
        .agg(F.max("seed").alias("seed")),
        "context-edges",
    )
    pattern, instance = ["kind", "side", "words"], ["kind", "value"]
    scores = edges.groupBy(*instance).agg(F.max("seed").cast("double").alias("score"))
    for turn in range(ROUNDS):
        judged = (
            edges.join(scores, instance)
            .groupBy(*pattern)
            .agg(F.avg("score").alias("precision"), F.sum("score").alias("support"))
        )
        good = materialize(
            judged.filter((F.col("precision") >= PRECISION) & (F.col("support") >= SUPPORT)),
            f"patterns-{turn}",
        )
        doubt = F.sum(F.log(F.greatest(1 - F.coalesce("precision", F.lit(0.0)), F.lit(1e-9))))
        scores = (
            edges.join(good.drop("support"), pattern, "left")
            .groupBy(*instance)
            .agg(F.max("seed").alias("seed"), (1 - F.exp(doubt)).alias("learned"))
            .select(
                *instance,
                F.when(F.col("seed"), 1.0).otherwise(F.col("learned")).alias("score"),
            )
        )
    return good.select(*pattern)


def found_spans(docs: DataFrame, keep: list[str], column: str = "text") -> DataFrame:
    """``keep`` with ``base`` and ``added``, arrays of (kind, start, end, value)."""
    text = text_of(column)
    fields = ["kind", "start", "end", "value"]
    searched = docs.withColumn("__base", base_spans(text)).withColumn(
        "__loose", _loose_spans(text, F.col("__base"))
    )
    rows = materialize(
        searched.select(
            *keep,
            F.monotonically_increasing_id().alias(ROW),
            F.col("__base").alias("base"),
            F.concat(
                _with_context(text, F.col("__base"), True),
                _with_context(text, F.col("__loose"), False),
            ).alias("candidates"),
        ),
        "spans",
    )
    places = rows.select(ROW, F.explode("candidates").alias("x")).select(ROW, "x.*")
    good = scored_patterns(places)
    loose = places.filter("NOT seed")
    hits = [
        loose.join(
            good.filter(F.col("side") == side).select("kind", F.col("words").alias(side)),
            ["kind", side],
        ).select(ROW, *fields)
        for side in ("before", "behind")
    ]
    added = reduce(DataFrame.unionByName, hits).distinct().groupBy(ROW).agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("added")
    )
    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")
    return rows.drop("candidates").join(added, ROW, "left").select(
        *keep, "base", F.coalesce("added", none).alias("added")
    )


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"]),
        ),
    )


def redacted(docs: DataFrame, column: str = "text") -> DataFrame:
    """All documents, every span replaced by its kind in brackets."""
    names = F.array(*map(F.lit, KINDS))
    whole = docs.select(F.struct(*docs.columns).alias("__doc"), F.col(column).alias("text"))
    found = found_spans(whole, ["__doc"])
    text = F.col("__doc")[column]
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, x: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, x["start"] - state["at"])
        label = F.concat(F.lit("["), F.upper(F.get(names, x["kind"])), F.lit("]"))
        # a span that begins inside of the last one only moves its end
        return F.struct(
            F.greatest(state["at"], x["end"]).alias("at"),
            F.when(x["start"] < state["at"], state["out"])
            .otherwise(F.concat(state["out"], gap, label))
            .alias("out"),
        )

    by_start = F.sort_array(
        F.transform(
            F.concat("base", "added"),
            lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")),
        )
    )
    joined = F.aggregate(
        by_start,
        start,
        step,
        lambda state: F.concat(
            state["out"], F.substring(text, state["at"] + 1, F.length(text))
        ),
    )
    changed = F.when(F.size("base") + F.size("added") > 0, joined).otherwise(text)
    return found.select(
        *[changed.alias(c) if c == column else F.col("__doc")[c].alias(c) for c in docs.columns]
    )
