"""Statistics, population and bands on small frames."""

import statistics

import pytest
from pyspark.sql import functions as F

from keycadence.operators import ranking, serving
from keycadence.operators.stats import user_stats
from keycadence.plans.analytics import results_of
from keycadence.plans.sample import typing_records

from .conftest import SF_DIR

SCHEMA = "userId string, avg_wpm double, avg_accuracy double, keystroke_count bigint, wpm_variance double"


def _stats(spark, averages):
    rows = [(f"u{i}", float(a), 90.0, 5, 1.0) for i, a in enumerate(averages)]
    return spark.createDataFrame(rows, SCHEMA)


def _bands(spark, averages):
    rows = ranking.with_global_rank(_stats(spark, averages)).collect()
    return [r.global_rank for r in sorted(rows, key=lambda r: int(r.userId[1:]))]


def test_user_stats(spark):
    keys = [("a", 10, 90), ("a", 20, None), ("a", 40, 70), ("b", 5, 5), ("b", 6, 6),
            (None, 1, 1), (None, 0, 1), (None, 5, 1)]
    frame = spark.createDataFrame(keys, "userId string, wpm int, accuracy int").select(
        "userId", F.struct("wpm", "accuracy").alias("data"))
    rows = {r.userId: r for r in user_stats(frame).collect()}
    assert set(rows) == {"a", None}
    assert rows["a"].avg_wpm == pytest.approx(70 / 3)
    assert rows["a"].avg_accuracy == 80.0 and rows["a"].keystroke_count == 3
    assert rows["a"].wpm_variance == pytest.approx(statistics.stdev([10, 20, 40]))


def test_bands_are_brute_force(spark):
    averages = [5, 12.5, 30, 31, 44, 58, 90, 91, 140]
    mean, spread = statistics.mean(averages), statistics.stdev(averages)
    wanted = []
    for a in averages:
        if a > mean + spread:
            wanted.append("🏆 TOP 10%")
        elif a > mean:
            wanted.append("📈 ABOVE AVERAGE")
        elif a > mean - spread:
            wanted.append("📊 AVERAGE")
        else:
            wanted.append("🎯 NEEDS PRACTICE")
    assert _bands(spark, averages) == wanted


def test_band_edge_cases(spark):
    assert _bands(spark, [55]) == ["📊 AVERAGE"]
    assert _bands(spark, [40, 40, 40]) == ["📊 AVERAGE"] * 3
    assert _bands(spark, [0, 0]) == ["⭐ FIRST TEST"] * 2
    assert _bands(spark, []) == []


def test_population_defaults(spark):
    def only(averages):
        return tuple(ranking.population_stats(_stats(spark, averages)).first())

    assert only([]) == (0, 0.0, 10.0)
    assert only([30]) == (1, 30.0, 10.0)
    assert only([30, 30]) == (2, 30.0, 10.0)


def test_result_records(spark):
    stats = spark.createDataFrame(
        [("a", 45.25, None, 3, 1.0), ("b", 60.75, 88.35, 4, 1.0)], SCHEMA)
    rows = {r.userId: r for r in ranking.result_records(stats).collect()}
    assert (rows["a"].avg_wpm, rows["a"].avg_accuracy) == (45.2, None)
    assert (rows["b"].avg_wpm, rows["b"].avg_accuracy) == (60.8, round(88.35, 1))
    assert rows["b"].performance_trend == "🚀 FAST TYPIST"


def test_bands_follow_the_average(spark):
    order = ["🎯 NEEDS PRACTICE", "📊 AVERAGE", "📈 ABOVE AVERAGE", "🏆 TOP 10%"]
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    rows = results_of(typing_records(events)).collect()
    ranks = [order.index(r.global_rank) for r in sorted(rows, key=lambda r: r.avg_wpm)]
    assert ranks == sorted(ranks)


def test_events_are_read_once(spark):
    """The population subquery reuses the shuffle of the statistics."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    results = results_of(typing_records(events))
    results.collect()
    plan = results._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_serving(spark):
    log = spark.createDataFrame(
        [("a", 1, 0, 10.0), ("a", 2, 0, 20.0), ("a", 2, 1, 30.0), ("b", 1, 0, None),
         ("", 9, 9, 1.0), (None, 9, 9, 1.0)],
        "userId string, timestamp int, batch_id int, avg_wpm double")
    rows = {r.userId: r.avg_wpm for r in serving.latest_results(log).collect()}
    assert rows == {"a": 30.0, "b": None}


def test_leaderboard_and_lookups(spark):
    schema = ("userId string, avg_wpm double, avg_accuracy double, keystroke_count bigint, "
              "global_rank string, performance_trend string")
    rows = [(f"u{i:02d}", float(50 + i // 2), 90.0, 3, "r", "t") for i in range(30)]
    rows += [("zero", 0.0, 1.0, 3, "r", "t"), ("bare", None, None, None, None, None), ("", 99.0, 1.0, 3, "r", "t")]
    stored = serving.stored_results(spark.createDataFrame(rows, schema))
    board = serving.with_position(serving.leaderboard(stored)).collect()
    names = [r.username for r in sorted(board, key=lambda r: r.position)]
    ranked = sorted((r for r in rows if r[0] and r[1]), key=lambda r: (-r[1], r[0]))
    assert names == [r[0] for r in ranked[:10]]
    assert [r.position for r in board] == list(range(1, 11))

    asked = spark.createDataFrame([("u01",), ("nobody",), ("bare",)], "userId string")
    found = {r.userId: r for r in serving.lookup_with_default(asked, stored).collect()}
    assert tuple(found["nobody"])[1:] == (0.0, 0.0, 0, "N/A", "stable", None)
    assert tuple(found["bare"])[1:-1] == (0.0, 0.0, 0, "N/A", "stable")
    assert found["bare"].last_update
    assert found["u01"].total_keystrokes == 3
    assert {r.userId for r in serving.lookup_present(asked, stored).collect()} == {"u01", "bare"}
    assert {r.userId for r in serving.known_users(asked, stored).collect()} == {"u01", "bare"}


def test_leaderboard_is_a_top_k(spark):
    stored = serving.stored_results(
        results_of(typing_records(spark.read.parquet(f"{SF_DIR}/events.parquet"))))
    plan = serving.leaderboard(stored)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
