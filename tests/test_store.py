"""The keyed store, and what is kept up by changes, against plain recounting."""

import json
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from keycadence.operators import board as boards
from keycadence.operators.moments import (
    Population,
    key_moments,
    merged_moments,
    population_after,
    population_of,
    stats_from_moments,
)
from keycadence.operators.ranks import positions, running_total
from keycadence.operators.stats import user_stats
from keycadence.sources.files import Files
from keycadence.sources.keyed_store import FEW_KEYS, KeyedStore, Run, merged_from
from keycadence.sources.storage import newest_version, read_version, write_version

ROW = "userId string, value long, version long"


def _put(store, version, rows):
    frame = store.spark.createDataFrame([(k, v, version) for k, v in rows.items()], ROW)
    before = store.manifest(below=version)
    run = store.write_run(frame, version, len(rows))
    return store.commit(version, before, run, frame.schema, {"rows": len(rows)})


def _all(store, manifest=None):
    return {r.userId: r.value for r in store.rows(manifest).collect()}


def test_changes_are_merged_on_read(spark, tmp_path):
    rng, known = random.Random(1), {}
    store = KeyedStore(spark, f"{tmp_path}/store", keep=3, bucket_rows=20)
    for version in range(14):
        size = 150 if version == 0 else rng.choice([1, 3, 30])
        rows = {rng.choice([f"u{rng.randint(0, 199)}", None]): rng.randint(0, 10**9) for _ in range(size)}
        known |= rows
        manifest = _put(store, version, rows)
        sizes = [run.rows for run in manifest.runs]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:])) and manifest.more == {"rows": len(rows)}
    assert _all(store) == known
    assert max(run.buckets for run in manifest.runs) > 3
    # old versions and the runs only they needed are gone
    assert store.versions() == [11, 12, 13]
    named = {r.path for v in store.versions() for r in store.manifest(below=v + 1).runs}
    assert {f"runs/{n}" for n in store.files.names("runs")} == named
    # an older version is still what it was
    assert len(_all(store, store.manifest(below=12))) <= len(known)


def test_lookup_reads_the_buckets_of_the_requested_keys(spark, tmp_path):
    store = KeyedStore(spark, f"{tmp_path}/store", bucket_rows=50)
    known = {f"u{k}": k for k in range(4000)} | {None: -1}
    _put(store, 0, known)
    _put(store, 1, {"u7": 70, "new": 1})
    known |= {"u7": 70, "new": 1}
    asked = spark.createDataFrame([("u7",), ("u8",), ("u7",), ("none",), (None,)], "userId string")
    found = store.lookup(asked)
    assert {r.userId: r.value for r in found.collect()} == {"u7": 70, "u8": 8, None: -1}
    plan = store.lookup(asked)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    # the only shuffle is of rows that were asked for
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning" not in plan[plan.index("BroadcastHashJoin"):]
    (buckets,) = re.findall(r"PartitionFilters: \[bucket#\d+ IN \(([\d,]+)\)", plan)
    run = store.manifest().runs[0]
    assert len(buckets.split(",")) == 4 and run.buckets == 81
    read = sum(store.files.bytes_below(f"{run.path}/bucket={k}") for k in buckets.split(","))
    assert 0 < read < 0.1 * store.files.bytes_below(run.path)


def test_lookup_of_very_many_keys(spark, tmp_path):
    store = KeyedStore(spark, f"{tmp_path}/store")
    _put(store, 0, {f"u{k}": k for k in range(50)})
    many = spark.range(FEW_KEYS + 40).select(F.concat(F.lit("u"), "id").alias("userId"))
    assert store.lookup(many).count() == 50


def test_bytes_written_follow_the_changed_keys(spark, tmp_path):
    store = KeyedStore(spark, f"{tmp_path}/store")
    rng = random.Random(2)
    first = _put(store, 0, {f"user-{k}": rng.getrandbits(60) for k in range(20_000)})
    base = store.files.bytes_below(first.runs[0].path)
    before = store.files.bytes_below("runs")
    for version in range(1, 9):
        after = _put(store, version, {f"user-{rng.randint(0, 19_999)}": version for _ in range(10)})
    assert after.runs[0] == first.runs[0]
    written = store.files.bytes_below("runs") - before
    assert written < 0.15 * base and sum(r.rows for r in after.runs[1:]) <= 80


def test_killed_between_files_and_manifest(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, f"{tmp_path}/store")
    _put(store, 0, {"a": 1, "b": 2})

    def killed(name, text):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(store.files, "write", killed)
        with pytest.raises(KeyboardInterrupt):
            _put(store, 1, {"a": 5, "c": 3})  # half of the rows, so the runs were merged too
    assert _all(store) == {"a": 1, "b": 2} and len(store.files.names("runs")) == 3
    again = KeyedStore(spark, f"{tmp_path}/store")
    _put(again, 1, {"a": 6, "c": 3})
    assert _all(again) == {"a": 6, "b": 2, "c": 3}
    assert _all(again, again.manifest(below=1)) == {"a": 1, "b": 2}
    needed = {r.path for v in (0, 1) for r in again.manifest(below=v + 1).runs}
    assert {f"runs/{n}" for n in again.files.names("runs")} == needed


def test_a_version_written_again_replaces_itself(spark, tmp_path):
    store = KeyedStore(spark, f"{tmp_path}/store")
    _put(store, 0, {"a": 1, "b": 1})
    for _ in range(2):
        _put(store, 3, {"b": 2})
    assert store.versions() == [0, 3] and _all(store) == {"a": 1, "b": 2}
    with pytest.raises(LookupError):
        KeyedStore(spark, f"{tmp_path}/nothing").rows()


def test_runs_to_merge():
    sizes = lambda *rows: [Run("", r, 1) for r in rows]
    assert merged_from(sizes(100, 10)) == 1
    assert merged_from(sizes(100, 10, 9)) == 1
    assert merged_from(sizes(100, 40, 9, 9)) == 2
    assert merged_from(sizes(100, 30, 9, 9)) == 1
    assert merged_from(sizes(50, 30, 9, 9)) == 0
    assert merged_from(sizes(5)) == 0


def test_versions_of_a_list(spark, tmp_path):
    folder = f"{tmp_path}/list"
    assert newest_version(spark, folder) is None
    for version in range(5):
        write_version(spark.range(version), folder, version)
    assert read_version(spark, folder).count() == 4 and newest_version(spark, folder, below=4) == 3
    assert sorted(Files(spark, folder).names("complete")) == ["2", "3", "4"]


# Moments


def _typed(spark, rng, users, rows):
    data = [
        (rng.choice(users), rng.randint(0, 130), rng.choice([None, rng.randint(60, 100)]))
        for _ in range(rows)
    ]
    return data, spark.createDataFrame(data, "userId string, wpm int, accuracy int")


def test_moments_merge_to_the_statistics_of_all_keystrokes(spark):
    rng, users = random.Random(4), [f"u{k}" for k in range(40)] + [None]
    seen, known, population = [], None, Population()
    for batch in range(8):
        data, typed = _typed(spark, rng, users if batch % 3 else users[:4], 60)
        seen += data
        changed = merged_moments(key_moments(typed), known)
        rows = changed.collect()
        changed = spark.createDataFrame(rows, changed.schema)
        keep = [] if known is None else [r for r in known.collect() if r.userId not in {x.userId for x in rows}]
        plain = [r for r in changed.drop("was").collect()]
        known = spark.createDataFrame(keep + plain, changed.drop("was").schema)
        found = population_after(population, changed)
        population = found or population_of(known)
        whole = population_of(known)
        assert population.users == whole.users
        assert population.mean == pytest.approx(whole.mean, abs=1e-9)
        assert population.spread == pytest.approx(whole.spread, abs=1e-9)
    frame = spark.createDataFrame(seen, "userId string, wpm int, accuracy int")
    wanted = user_stats(frame.select("userId", F.struct("wpm", "accuracy").alias("data")))
    key = lambda r: str(r.userId)
    for a, b in zip(sorted(stats_from_moments(known).collect(), key=key), sorted(wanted.collect(), key=key), strict=True):
        assert (a.userId, a.avg_wpm, a.avg_accuracy, a.keystroke_count) == (
            b.userId, b.avg_wpm, b.avg_accuracy, b.keystroke_count)
        assert a.wpm_variance == pytest.approx(b.wpm_variance, abs=1e-9)


def test_population_arithmetic():
    rng = random.Random(5)
    values = [rng.gauss(50, 15) for _ in range(60)]

    def of(part):
        mean = statistics.fmean(part)
        return Population(len(part), mean, sum((x - mean) ** 2 for x in part))

    found = of(values[:40]).plus(of(values[40:])).minus(of(values[10:30]))
    left = values[:10] + values[30:]
    assert found.users == 40 and found.mean == pytest.approx(statistics.fmean(left))
    assert found.spread == pytest.approx(statistics.stdev(left))
    assert of(values).minus(of(values)) == Population()
    # taking out what made nearly all of the spread is left to a new count
    assert of([1e9, 1.0, 1.0 + 1e-9]).minus(of([1e9])) is None
    # the fixed spread where there is none
    assert Population().spread == Population(1, 5.0, 0.0).spread == of([7.0, 7.0]).spread == 10.0
    assert of([3.0] * 5).minus(of([3.0])) == Population(4, 3.0, 0.0)


# Board


def test_board_under_changes(spark):
    """Leaders fall, others rise; only falls below the floor rank everybody again."""
    rng, users, refills = random.Random(6), {}, []

    def frame(rows):
        return spark.createDataFrame(
            [(k, float(v) if v is not None else None, 1.0) for k, v in rows.items()], boards.SHAPE)

    def everybody():
        refills.append(1)
        return frame(users).filter("avg_wpm > 0")

    kept = {"candidates": [], "floor": None}
    for step in range(25):
        best = sorted((k for k in users if users[k]), key=lambda k: (-users[k], k))[:6]
        changed = {f"u{rng.randint(0, 99):02d}": rng.choice([None, 0, *range(30, 60)]) for _ in range(8)}
        if step % 6 == 5:
            changed |= {k: 1 for k in best}
        if step == 0:
            changed = {f"u{k:02d}": rng.randint(20, 60) for k in range(100)}
        users |= changed
        kept = boards.board_after(kept, frame(changed), everybody, size=16, places=5)
        kept = json.loads(json.dumps(kept))  # as the manifest keeps it
        assert len(kept["candidates"]) <= 16
        wanted = sorted((k for k in users if users[k]), key=lambda k: (-users[k], k))[:5]
        assert [r.username for r in boards.first_places(spark, kept, 5).collect()] == wanted
    assert 1 <= len(refills) <= 8


# Positions


@pytest.mark.parametrize("slice_rows", [1_000_000, 10])
def test_positions(spark, slice_rows):
    rows = [(f"u{k}", (k * 7) % 23) for k in range(300)]
    frame = spark.createDataFrame(rows, "name string, speed int").repartition(3)
    placed = positions(frame, [F.desc("speed"), "name"], slice_rows=slice_rows)
    found = {r.name: r.position for r in placed.collect()}
    wanted = {name: k for k, (name, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)}
    assert found == wanted
    assert "SinglePartition" not in placed._jdf.queryExecution().executedPlan().toString()


def test_running_total_in_groups(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), k, rng.randint(0, 9)) for k in range(400)]
    frame = spark.createDataFrame(rows, "part string, k int, n int")
    found = running_total(frame, ["k"], F.col("n"), ["part"], slice_rows=30).collect()
    sums = {}
    for r in sorted(found, key=lambda r: r.k):
        assert r.before == sums.get(r.part, 0)
        sums[r.part] = sums.get(r.part, 0) + r.n
    assert len(found) == 400
    assert running_total(frame.limit(0), ["k"], F.col("n")).count() == 0
