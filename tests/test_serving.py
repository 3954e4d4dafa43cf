from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helio.operators import serving
from helio.operators.trailing import rolling_snapshot
from helio.schema import SNAPSHOT
from tests.samples import sample


def snapshot(time_tag, speed=500.0, band="baseline"):
    return (time_tag, speed, speed - 1, 1.0, 2.0, speed - 1, 3.0, 4.0, 5, band, 1)


@pytest.fixture(scope="module")
def log(spark):
    rows = [(0, snapshot(f"2026-01-01T00:{i:02d}:00Z", 400.0 + i)) for i in range(60)]
    rows += [(1, snapshot("2026-01-01T00:59:00Z", 900.0, "extreme"))]
    df = spark.createDataFrame([r for _, r in rows], SNAPSHOT)
    ids = spark.createDataFrame([(b, *r) for b, r in rows], f"batch_id bigint, {df._jdf.schema().toDDL()}")
    return ids.repartition(3)


@pytest.fixture(scope="module")
def documents(spark):
    summary = spark.createDataFrame(
        [(20, 567.5, 731.0, 412.0, 7.95)],
        "record_count bigint, avg_speed double, max_speed double, min_speed double,"
        " avg_disturbance_score double",
    )
    return summary, spark.createDataFrame([(705.0, 731.0)], "p95 double, p99 double")


def test_latest_snapshots(log):
    found = serving.latest_snapshots(log).collect()
    assert len(found) == 50
    assert [r["time_tag"] for r in found] == [f"2026-01-01T00:{i:02d}:00Z" for i in range(10, 60)]
    assert (found[-1]["current_speed"], found[-1]["risk_band"]) == (900.0, "extreme")
    shown = serving.display_rows(serving.latest_snapshots(log))
    assert shown.columns == list(serving.DISPLAY_COLUMNS)
    assert [r["time_tag"][14:16] for r in shown.collect()] == [str(i) for i in range(50, 60)]


def test_newest_per_key_breaks_ties_alike(log):
    both = log.where("batch_id = 0").unionByName(log.where("batch_id = 0").withColumn("risk_band", F.lit("high")))
    for parts in (1, 7):
        found = serving.newest_per_key(both.repartition(parts), ("batch_id",))
        assert {r["risk_band"] for r in found.collect()} == {"high"}


def test_serving_view(log, documents):
    found = serving.serving_view(serving.latest_snapshots(log), *documents).collect()
    assert [r.asDict() for r in found] == [
        {
            "historical_avg_speed": 567.5,
            "historical_p95_speed": 705.0,
            "latest_current_speed": 900.0,
            "latest_rolling_avg_speed": 899.0,
            "latest_disturbance_score": 5,
            "latest_risk_band": "extreme",
            "freshness_gap": 332.5,
        }
    ]


def test_serving_merge(spark, documents):
    merged = serving.serving_merge(rolling_snapshot(sample(spark)), *documents)
    assert merged.count() == 20
    assert {tuple(r)[3:6] for r in merged.collect()} == {(567.5, 705.0, 731.0)}
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_document_has_one_row(log, documents):
    summary, ranks = documents
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        serving.overview(summary, ranks.union(ranks)).collect()


def test_overview_and_series(log, documents, spark):
    assert tuple(serving.overview(*documents).first()) == (20, 567.5, 731.0, 412.0, 7.95, 705.0)
    series = serving.live_series(serving.latest_snapshots(log, 1)).collect()
    assert [tuple(r) for r in series] == [(datetime(2026, 1, 1, 0, 59), 900.0, 899.0)]
    daily = spark.createDataFrame([(2026, 7, 25, 630.0)], "year int, month int, day int, daily_avg_speed double")
    assert str(serving.daily_series(daily).first()["date"]) == "2026-07-25"
