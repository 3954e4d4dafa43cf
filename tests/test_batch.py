from contextlib import contextmanager
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from helio.operators import aggregates as agg
from helio.operators.clean import (
    clean_observations,
    prepare_observations,
    rejected_observations,
    with_score,
)
from helio.operators.normalize import normalize_rows
from helio.operators.ordering import globally_sorted
from helio.operators.quantiles import _digit_counts, exact_percentiles, from_image, ordered_image
from helio.plans.batch import write_batch_outputs
from helio.sources import OutputLayout, read_document, read_observations, read_output, write_json_lines
from tests.samples import records, sample

def test_csv_headers_in_two_orders_raise(spark, tmp_path):
    for name, head in (("a", "time_tag,speed,density"), ("b", "time_tag,density,speed")):
        (tmp_path / f"{name}.csv").write_text(f"{head}\n2026-07-25T10:00:00Z,400,5\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_observations(spark, str(tmp_path)).collect()


def test_unreadable_number_is_kept_as_a_corrupt_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("time_tag,speed\nt,4x0\nu,400\n")
    rows = read_observations(spark, str(tmp_path), corrupt="line").collect()
    assert [(r["speed"], r["line"]) for r in rows] == [(None, "t,4x0"), (400.0, None)]


RANKS = {"p25": 470.0, "p50": 556.0, "p75": 642.0, "p90": 690.0, "p95": 705.0, "p99": 731.0}
SUMMARY = {
    "record_count": 20,
    "avg_speed": 567.5,
    "avg_density": 8.2,
    "avg_bt": 6.025,
    "avg_disturbance_score": 7.95,
    "max_speed": 731.0,
    "min_speed": 412.0,
}


def rows(df):
    return [tuple(row) for row in df.collect()]


@pytest.fixture(scope="module")
def prepared(spark):
    return prepare_observations(sample(spark)).cache()


def test_calendar_tables(prepared):
    first, second = (630.0, 8.69, 10.4), (505.0, 7.71, 5.5)
    daily = rows(agg.daily_speed(prepared))
    assert [row[:3] for row in daily] == [(2026, 7, 25), (2026, 7, 26)]
    assert [row[3:] for row in daily] == [pytest.approx(first), pytest.approx(second)]
    hourly = rows(agg.hourly_speed(prepared))
    assert [row[0] for row in hourly] == [9, 10]
    assert [row[1:] for row in hourly] == [pytest.approx(second), pytest.approx(first)]
    assert rows(agg.monthly_speed(prepared)) == [(2026, 7, *(pytest.approx(v) for v in (567.5, 8.2, 7.95)))]


def test_rollup_gives_the_same_tables(prepared):
    hours = agg.rollup(prepared)
    for build in (agg.daily_speed, agg.monthly_speed, agg.hourly_speed, agg.disturbance_breakdown):
        direct, rolled = rows(build(prepared)), rows(build(hours))
        assert len(direct) == len(rolled)
        for a, b in zip(direct, rolled, strict=True):
            assert [v if isinstance(v, str) else pytest.approx(v) for v in a] == list(b)


def test_breakdown(prepared):
    expected = [
        ("baseline", 8, 470.625, 6.8125),
        ("elevated", 2, 529.0, 8.45),
        ("extreme", 2, 718.0, 10.25),
        ("high", 8, 636.375, 9.0125),
    ]
    found = rows(agg.disturbance_breakdown(prepared))
    assert [(b, n, round(s, 6), round(d, 6)) for b, n, s, d in found] == expected


def test_stream_scale_on_the_sample(spark):
    scored = with_score(sample(spark), "stream")
    counts = {r["risk_band"]: r["count"] for r in scored.groupBy("risk_band").count().collect()}
    assert counts == {"baseline": 6, "elevated": 4, "extreme": 2, "high": 8}
    assert scored.agg(F.avg("disturbance_score")).first()[0] == 8.5


def test_storms(prepared):
    found = rows(agg.storm_events(prepared))
    assert [(r[0], r[1], r[4], r[5]) for r in found] == [
        (datetime(2026, 7, 25, 10, 20), 705.0, 15, "extreme"),
        (datetime(2026, 7, 25, 10, 25), 731.0, 15, "extreme"),
    ]


def test_statistics(prepared):
    found = agg.statistics(prepared).first()
    assert found["summary"].asDict() == SUMMARY
    assert found["percentiles"].asDict() == RANKS
    assert found["correlations"].asDict() == pytest.approx(
        {
            "speed_density": 0.929039199985628,
            "speed_bt": 0.988674218081696,
            "density_bt": 0.93513764189541,
        }
    )
    assert agg.summary(prepared).first().asDict() == SUMMARY
    assert agg.percentiles(prepared).first().asDict() == RANKS
    assert exact_percentiles(prepared).first().asDict() == RANKS


def test_empty_and_constant_input(spark):
    empty = prepare_observations(sample(spark).limit(0))
    figures = agg.summary(empty).first().asDict()
    assert figures.pop("record_count") == 0
    assert set(figures.values()) == {None}
    for build in (agg.percentiles, agg.correlations, exact_percentiles):
        assert set(build(empty).first()) == {None}
    same = prepare_observations(records(spark, *[(f"2026-01-01T00:00:0{i}Z",) for i in range(5)]))
    assert set(agg.correlations(same).first()) == {None}


@pytest.mark.parametrize(("digit_bits", "repeats"), [(4, 3000), (8, 30_000), (16, 3000), (16, 30_000)])
def test_exact_percentiles_with_a_dominant_value(spark, digit_bits, repeats):
    speeds = np.concatenate([np.full(repeats, 400.5), np.arange(2000) / 4, 600 + np.arange(900) / 8])
    df = spark.createDataFrame([(float(s),) for s in speeds], "speed double").repartition(4)
    ordered = np.sort(speeds)
    expected = {
        name: ordered[-(-round(p * 100) * len(ordered) // 100) - 1]
        for name, p in agg.PERCENTILES.items()
    }
    assert exact_percentiles(df, digit_bits).first().asDict() == expected


def test_exact_percentiles_of_odd_numbers(spark):
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, np.nextafter(2.0**-1022, 0), 1.0, np.nextafter(1.0, 0), np.nextafter(2.0, 0), 2.0]
    odd += [1.7976931348623157e308, float("inf"), float("-inf"), -3.75, 1e-300, 2.0**52 + 1, -(2.0**1023), 0.1, 3.0, 1e22]
    df = spark.createDataFrame([(float(s),) for s in odd], "speed double")
    images = [r[0] for r in df.select(ordered_image(F.col("speed"))).collect()]
    assert [from_image(i) for i in images] == odd
    assert [odd[i] for i in np.argsort(images, kind="stable")] == sorted(odd)
    packed = np.array(odd).view(np.int64)
    assert images == [int(b) if b >= 0 else -int(b & 0x7FFFFFFFFFFFFFFF) for b in packed.tolist()]


def test_exact_percentiles_need_no_window_and_no_sort(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "speed double")
    plan = _digit_counts(df.select(ordered_image(F.col("speed")).alias("image")), [0], 32, 16)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange SinglePartition" not in plan
    assert exact_percentiles(df).first()["p50"] == 2.0


def test_cleaning(spark):
    kept = clean_observations(
        records(
            spark,
            ("a", 500.0, 5.0, 0.0),
            (None, 500.0, 5.0, 1.0),
            ("b", None, 5.0, 1.0),
            ("c", 500.0, None, 1.0),
            ("d", 500.0, 5.0, None),
            ("e", 0.0, 5.0, 1.0),
            ("f", -1.0, 5.0, 1.0),
            ("g", 500.0, 0.0, 1.0),
            ("h", 500.0, 5.0, -0.1),
            ("i", float("nan"), 5.0, 1.0),
        )
    )
    assert [r["time_tag"] for r in kept.collect()] == ["a"]


def test_rows_with_an_unreadable_time_are_set_aside(spark):
    df = records(spark, ("2026-01-01T00:00:00Z",), ("garbage",))
    assert prepare_observations(df).count() == 1
    assert [r["time_tag"] for r in rejected_observations(df).collect()] == ["garbage"]


def test_zero_filled_rows_are_cleaned_away(spark):
    raw = spark.createDataFrame(
        [("t1", "", "4", "1"), ("t2", "500", "x", "1"), ("t3", "500", "4", "")],
        "time_tag string, speed string, density string, bt string",
    )
    kept = clean_observations(normalize_rows(raw)).collect()
    assert [(r["time_tag"], r["bt"]) for r in kept] == [("t3", 0.0)]


@contextmanager
def setting(spark, name, value):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    yield
    spark.conf.set(name, before)


def test_sort_spreads_rows_of_one_key(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    ordered = globally_sorted(df.repartition(8), "k")
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        placed = ordered.select(F.spark_partition_id().alias("p")).distinct().collect()
    assert len(placed) > 4
    keys = [r["k"] for r in ordered.collect()]
    assert keys == sorted(keys)


def test_filters_reach_the_scan(spark, tmp_path):
    sample(spark).write.parquet(str(tmp_path / "obs"))
    prepared = prepare_observations(spark.read.parquet(str(tmp_path / "obs")))
    with setting(spark, "spark.sql.maxMetadataStringLength", "1000"):
        plan = agg.storm_events(prepared)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(speed,700.0)" in plan
    assert "temperature" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_batch_run(spark, tmp_path, fmt):
    source, base = str(tmp_path / "in"), str(tmp_path / "batch")
    sample(spark).write.format(fmt).option("header", True).save(source)
    write_batch_outputs(read_observations(spark, source, fmt), base, keep_rejects=True)
    layout = OutputLayout(base)
    assert read_document(spark, layout.document("summary")).first().asDict() == SUMMARY
    assert read_document(spark, layout.document("percentiles")).first().asDict() == RANKS
    assert read_output(spark, base, "daily_speed").count() == 2
    assert read_output(spark, base, "storm_events").count() == 2
    assert read_output(spark, base, "disturbance_breakdown").agg(F.sum("event_count")).first()[0] == 20
    assert read_output(spark, str(tmp_path / "nowhere"), "daily_speed") is None
    # a second run replaces the first
    write_batch_outputs(read_observations(spark, source, fmt).limit(0), base)
    assert read_output(spark, base, "daily_speed").count() == 0
    assert '"avg_speed":null' in spark.read.text(layout.document("summary")).first()[0]


def test_json_lines(spark, tmp_path):
    write_json_lines(sample(spark), str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 20


def test_layout():
    assert OutputLayout("s3://bucket/batch/").table("daily_speed") == "s3a://bucket/batch/daily_speed"
    assert OutputLayout("s3://bucket/batch").snapshots == "s3a://bucket/speed/live"
    assert OutputLayout("s3://bucket/other").snapshots == "s3a://bucket/other/speed/live"
    assert OutputLayout("/tmp/out").document("summary") == "/tmp/out/summary.json"
    with pytest.raises(ValueError, match="unknown table"):
        OutputLayout("/tmp").table("weekly")
