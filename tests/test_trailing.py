import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helio.operators import trailing
from helio.operators.trailing import rolling_snapshot, running_snapshot, window_seconds
from tests.samples import records, sample

START = datetime(2026, 1, 1, tzinfo=UTC)


def stamp(micros: int) -> str:
    return (START + timedelta(microseconds=micros)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def brute_force(rows, span):
    out = []
    for t, speed, _, _ in rows:
        seen = [r for r in rows if t - span <= r[0] <= t]
        speeds = [r[1] for r in seen]
        out.append((stamp(t), speed, len(seen), min(speeds), max(speeds), sum(speeds) / len(speeds)))
    return sorted(out)


def run(spark, rows, minutes):
    df = records(spark, *[(stamp(t), s, d, b) for t, s, d, b in rows]).repartition(5)
    return [
        (r["time_tag"], r["current_speed"], r["window_size"], r["rolling_min_speed"],
         r["rolling_max_speed"], r["rolling_avg_speed"])
        for r in rolling_snapshot(df, minutes).collect()
    ]


def assert_matches(found, expected):
    assert len(found) == len(expected)
    for a, b in zip(sorted(found), expected, strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=6e-4)


def random_rows(seed, n, spread):
    rng = random.Random(seed)
    times = [rng.randrange(spread) for _ in range(n)]
    times += rng.choices(times, k=n // 4)
    return [(t, rng.randrange(300, 900), rng.random() * 12, rng.random() * 9) for t in times]


@pytest.mark.parametrize(("minutes", "spread"), [(1, 10**9), (5, 3 * 10**9), (60, 10**11)])
def test_against_brute_force(spark, minutes, spread):
    rows = [(t, float(s), d, b) for t, s, d, b in random_rows(minutes, 300, spread)]
    assert_matches(run(spark, rows, minutes), brute_force(rows, minutes * 60_000_000))


def test_window_ends_are_inclusive(spark):
    span = 300_000_000
    times = [0, 1, span, span + 1, span + 2, 5 * span, 5 * span]
    rows = [(t, 400.0 + i, 5.0, 1.0) for i, t in enumerate(times)]
    found = {(r[0], r[1]): r[2] for r in run(spark, rows, 5)}
    assert [found[stamp(t), 400.0 + i] for i, t in enumerate(times)] == [1, 2, 3, 3, 3, 2, 2]


def test_a_dominant_time_is_split(spark, monkeypatch):
    monkeypatch.setattr(trailing, "HOT_ROWS", 50)
    rows = [(7_000_000, float(400 + i % 9), 5.0, 1.0) for i in range(600)]
    rows += [(t, float(s), d, b) for t, s, d, b in random_rows(3, 200, 10**9)]
    assert_matches(run(spark, rows, 5), brute_force(rows, 300_000_000))


def test_identical_records_are_all_kept(spark, monkeypatch):
    monkeypatch.setattr(trailing, "HOT_ROWS", 10)
    df = records(spark, *[(stamp(0), 500.0)] * 200).repartition(8)
    found = rolling_snapshot(df).collect()
    assert [r["window_size"] for r in found] == [200] * 200


def test_sample(spark):
    found = rolling_snapshot(sample(spark)).orderBy("time_tag").limit(6).collect()
    assert [r["rolling_avg_speed"] for r in found] == [412.0, 513.5, 628.5, 665.0, 696.5, 718.0]
    assert [r["window_avg_density"] for r in found] == [5.8, 7.15, 8.65, 9.1, 9.75, 10.25]
    assert [r["window_avg_bt"] for r in found] == [4.2, 5.5, 6.9, 7.4, 8.15, 8.7]
    assert [r["window_size"] for r in found] == [1, 2, 2, 2, 2, 2]
    last = found[-1]
    assert (last["disturbance_score"], last["risk_band"]) == (15, "extreme")


def test_rows_without_a_window_are_left_out(spark):
    df = records(spark, ("garbage",), (stamp(0), None), (stamp(1), 500.0))
    assert [r["window_size"] for r in rolling_snapshot(df).collect()] == [1]


def test_numeric_times(spark):
    df = records(spark, ("0", 400.0), ("60", 500.0)).withColumn("time_tag", F.col("time_tag").cast("double"))
    assert sorted(r["window_size"] for r in rolling_snapshot(df).collect()) == [1, 2]


def test_window_has_a_minimum():
    assert [window_seconds(m) for m in (-3, 0, 1, 5)] == [60, 60, 60, 300]


def test_running_windows_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(trailing, "BLOCKS_PER_GROUP", 3)
    rows = [(t, float(s), d, b) for t, s, d, b in random_rows(4, 200, 2 * 10**9)]
    df = records(spark, *[(stamp(t), s, d, b) for t, s, d, b in rows]).repartition(5)
    found = [
        (r["time_tag"], r["current_speed"], r["window_size"], r["rolling_min_speed"], r["rolling_max_speed"], r["rolling_avg_speed"])
        for r in running_snapshot(df).collect()
    ]
    assert_matches(found, brute_force(rows, 10**18))


def test_running_windows_of_nothing(spark):
    assert running_snapshot(sample(spark).limit(0)).count() == 0
