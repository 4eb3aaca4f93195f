"""Filter audit, source mixing and centroid clustering against brute force."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from keycadence.llm import audit, clustering, mixing

from .brute import WORD

# Filter audit


@pytest.fixture(scope="module")
def flagged_docs(spark, texts):
    rng = random.Random(3)
    many = [t for t in texts] + [" ".join(rng.choice("abcdefgh") * 3 for _ in range(150))] * 70
    many += [" ".join(f"w{k}" for k in range(n)) for n in (99, 100, 100, 400)]
    many += ["É" * 200 + " ABC " + " ".join(f"é{k}" for k in range(100)), "a$ " * 120, "AB" * 400]
    rows = [(i, t, rng.choice(["en", "de", None, ""]), 1, True) for i, t in enumerate(many)]
    rows += [(5, many[5], "en", 1, True), (3000, many[7], "en", 1, True), (7, "other", "en", 1, True)]
    rows += [(3000, many[-4], "en", 1, True), (None, many[-4], "de", 1, True), (None, None, None, 1, True)]
    rng.shuffle(rows)
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, mask int, possible boolean"
    ).repartition(5)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0), 1) for i in range(0, 4000, 2) if i % 5]
    rows += [(7, 1, 0, 1), (7, 0, 1, 1), (9, None, None, 1), (None, 1, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, mask int")


def masks_of(rows):
    least = {}
    for r in rows:
        if r.doc_id is not None:
            key = r.text or ""
            least[key] = min(least.get(key, r.doc_id), r.doc_id)
    out = []
    for r in rows:
        text = r.text or ""
        words = WORD.findall(text)
        fails = [
            len(words) < 100,
            100 * len(set(words)) < 80 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            any(c in "#$%&*|" for c in text),
            r.doc_id is not None and r.doc_id > least[text],
        ]
        out.append((r.doc_id, r.lang or "", frozenset(n for n, f in zip("ABCDE", fails) if f)))
    return out


def audited(masks, labels):
    good = {r.doc_id for r in labels if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in labels if r.toxic == 1 and r.doc_id is not None}
    out, share = {}, Counter()
    for part in {p for _, p, _ in masks}:
        own = [(i, m) for i, p, m in masks if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(i, m) for i, m in left if name in m]
                left = [(i, m) for i, m in left if name not in m]
                share[part, name] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(name in m for _, m in own) - len(gone),
                    sum(m == {name} for _, m in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                )
    return {(p, o, s): (*v, share[p, o[s - 1]]) for (p, o, s), v in out.items()}


@pytest.mark.parametrize("cells", [8, 1])
def test_filter_audit(flagged_docs, labels, monkeypatch, cells):
    """Also with a sketch that is far too small, which clears next to nothing."""
    monkeypatch.setattr(audit, "CELLS_PER_TEXT", cells)
    monkeypatch.setattr(audit, "BUCKET_CELLS", 32_768 if cells == 8 else 16)
    found = {
        (r.part, r.filter_order, r.step): (
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in audit.filter_audit(flagged_docs, labels).collect()
    }
    assert found == audited(masks_of(flagged_docs.collect()), labels.collect())
    assert len(found) == 3 * 600 and any(v[2] for v in found.values())


def test_masks_of_documents(flagged_docs):
    bits = lambda m: sum(1 << "ABCDE".index(x) for x in m)
    wanted = Counter((i, p, bits(m)) for i, p, m in masks_of(flagged_docs.collect()))
    assert Counter(tuple(r) for r in audit.failed_filters(flagged_docs).collect()) == wanted


def test_unique_texts_are_cleared(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("").alias("part"),
                                    F.xxhash64("id").alias("mark"), F.lit(0).alias("mask"))
    sketch = audit.lone_cells(docs, 2)
    assert audit.with_possible(docs, sketch, 2).filter("possible").count() < 500
    twice = docs.unionByName(docs)
    assert audit.with_possible(twice, audit.lone_cells(twice, 2), 2).filter("NOT possible").count() == 0


def test_texts_that_are_unique_are_not_shuffled(flagged_docs):
    flags = audit.text_flags(flagged_docs).persist()
    first = audit.first_ids(flagged_docs, audit.lone_cells(flags, 4), 4)
    assert first.count() < 0.6 * flagged_docs.select("text").distinct().count()
    flags.unpersist()


def test_audit_of_nothing(flagged_docs, labels):
    assert audit.filter_audit(flagged_docs.limit(0), labels).count() == 0
    some = audit.filter_audit(flagged_docs, labels.limit(0)).agg(F.max("good_lost"), F.sum("shapley"))
    most, total = some.first()
    assert most == 0 and total > 0


# Mixing


def water_filled(sizes, weights, share=Fraction(3, 2), most=2):
    wanted, full, level = share * sum(sizes.values()), set(), Fraction(0)
    while True:
        weight = sum(weights[s] for s in sizes if s not in full)
        if not weight:
            break
        level = (wanted - sum(most * sizes[s] for s in full)) / weight
        above = {s for s in sizes if s not in full and level * weights[s] > most * sizes[s]}
        if not above:
            break
        full |= above
    return {s: most * sizes[s] if s in full else level * weights[s] for s in sizes}


@pytest.fixture(scope="module")
def sourced(spark, texts):
    rng = random.Random(8)
    names = ["hot"] * 9 + ["b", "a", None, "é", "😀", "", "Z"]
    rows = [(i, t, rng.choice(names), 1.0, 1) for i, t in enumerate(texts)]
    rows += [(5000, "twice the same row here", "a", 1.0, 1)] * 40 + [(5000, "another text", "a", 1.0, 1)]
    rows += [(None, "no id", "b", 1.0, 1), (None, None, None, 1.0, 1)]
    rows += [(6000 + i, "", "empty", 1.0, 1) for i in range(50)]
    rng.shuffle(rows)
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, target double, before int"
    ).repartition(4)


def test_mixed(spark, sourced):
    rows = sourced.collect()
    size = lambda r: len(WORD.findall(r.text or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += size(r)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    targets = water_filled(sizes, weights)
    found = mixing.mixed(sourced).collect()
    key = lambda r: (r.doc_id, r.source, r.size)
    assert Counter(map(key, found)) == Counter((r.doc_id, r.source, size(r)) for r in rows)
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(targets[r.source]), rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(x.words for x in r.reads)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in sizes)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), abs=len(sizes))
    assert any(t == 2 * sizes[s] for s, t in targets.items() if sizes[s])
    # in the order of the first read; unread ones behind
    first = [r.reads[0].position if r.reads else 9 for r in found]
    assert first == sorted(first)
    # the same from other partitions, orders and slices
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    again = mixing.mixed(sourced.repartition(2, "text")).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_positions_follow_the_schedules(sourced):
    """What a source gave up to a time is the area of its schedule up to there."""
    order = ["", "Z", "a", "b", "empty", "hot", "é", "😀", None]
    reads = [(r.source, x.position, x.words) for r in mixing.mixed(sourced).collect() for x in r.reads]
    for source in ("hot", "a"):
        schedule = mixing.SCHEDULES[order.index(source) % 3]
        own = sorted((p, w) for s, p, w in reads if s == source)
        total, far = sum(w for _, w in own), 0
        for position, words in own:
            grid = np.linspace(0, position, 4001)
            knots, weights = zip(*schedule)
            area = np.trapezoid(np.interp(grid, knots, weights), grid)
            assert area / mixing.areas(schedule)[-1] == pytest.approx(far / total, abs=1e-4)
            far += words


def test_training_order(sourced):
    whole = mixing.training_order(sourced).collect()
    assert [r.position for r in whole] == sorted(r.position for r in whole)
    plan = mixing.mixed(sourced).collect()
    assert sum(r.words for r in whole) == sum(r.taken for r in plan)
    by_text = Counter((r.doc_id, r.text) for r in whole)
    assert by_text[5000, "twice the same row here"] >= 40
    assert all(r.words <= len(WORD.findall(r.text)) for r in whole)
    with pytest.raises(ValueError):
        mixing.training_order(sourced.withColumn("position", F.lit(1)))


def test_mix_of_nothing(sourced):
    assert mixing.mixed(sourced.limit(0)).count() == 0
    blank = mixing.mixed(sourced.filter("source = 'empty'")).collect()
    assert len(blank) == 50 and {(r.target, r.taken, len(r.reads)) for r in blank} == {(0.0, 0, 0)}


# Clustering


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(9, 64))
    rows = [(i, (centres[i % 9] + 0.4 * rng.normal(size=64)).tolist(), 1) for i in range(700)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(200)] + [(3, rows[9][1], 1), (3, rows[9][1], 1)]
    rows += [(None, rows[4][1], 1), (4000, [0.0] * 64, 1), (4001, [-0.001] * 64, 1)]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [float("nan")] * 64]
    rows += [(5000 + i, v, 1) for i, v in enumerate(bad)] + [(6000, [float("-inf")] * 64, 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int").repartition(3)


def plain_clusters(rows, k=16, rounds=3):
    kept = []
    for r in rows:
        v = r.embedding
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((r.vec_id, [int(np.floor(64 * float(x))) for x in v]))
    mark = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "~"
    chosen = sorted(kept, key=lambda x: (mark(x[0]), x[1]))[:k]
    x = np.array([v for _, v in kept], object)
    c = [list(v) for _, v in chosen]
    for turn in range(rounds + 1):
        apart = np.array([((x - np.array(m, object)) ** 2).sum(1) for m in c]).T.astype(np.int64)
        own = apart.argmin(1)
        if turn < rounds:
            for j in range(len(c)):
                mine = x[own == j]
                if len(mine):
                    c[j] = [int(s) // len(mine) for s in mine.sum(0)]
    far = apart[np.arange(len(x)), own]
    sums = [int(far[own == j].sum()) for j in range(len(c))]
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return Counter(
        (i, int(j), int(d), sums[j], sum(sums), digest[j]) for (i, _), j, d in zip(kept, own, far)
    )


@pytest.mark.parametrize("rounds", [0, 3, 8])
def test_clusters(points, rounds):
    found = clustering.centroid_clusters(points, rounds=rounds)
    assert Counter(map(tuple, found.collect())) == plain_clusters(points.collect(), rounds=rounds)


def test_bounds_spare_distances():
    """Far apart groups: later rounds compute next to none of the distances."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-900, 900, size=(16, 64))
    rows = np.repeat(centres, 50, axis=0) + rng.integers(-9, 9, size=(800, 64))
    history = np.stack([centres + step for step in (0, 3, -2, 1)])
    apart = np.stack([((rows - c) ** 2).sum(1) for c in history[0]], 1)
    far, seen = np.sqrt(apart).astype(np.float32), np.zeros((800, 16), np.int8)
    own, computed = clustering.nearest(rows, apart.argmin(1), far, seen, history)
    assert computed < 0.02 * 800 * 16
    exact = np.stack([((rows - c) ** 2).sum(1) for c in history[-1]], 1).argmin(1)
    assert (own == exact).all()


def test_clusters_of_few_and_no_vectors(spark, points):
    few = points.filter("vec_id IN (3, 5, 4000)")
    found = clustering.centroid_clusters(few)
    assert Counter(map(tuple, found.collect())) == plain_clusters(few.collect())
    assert clustering.centroid_clusters(points.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [1e30] * 64), (2, [-1e30] * 64)], "vec_id long, embedding array<double>")
    assert {r.distance for r in clustering.centroid_clusters(huge, k=1, rounds=0).collect()} >= {0}
