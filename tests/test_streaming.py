import base64
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helio.operators.trailing import rolling_snapshot
from helio.operators.windows import speed_windows
from helio.operators.serving import latest_snapshots
from helio.sources import OutputLayout, read_snapshot_log, read_snapshots, stream_files, stream_observations, write_document
from helio.sources.readers import snapshot_days
from helio.streaming import (
    archive_batch,
    compact_snapshots,
    once_per_batch,
    parse_events,
    rejected_events,
    score_events,
    start_archive,
    start_produce,
    start_rolling_snapshots,
    start_serving_merge,
    start_speed_windows,
    stream_speed_windows,
    upsert_snapshots,
)
from tests.samples import record, records, sample, sample_rows


class Feed:
    """A folder of JSON line files read as a stream of binary records."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        folder.mkdir()

    def add(self, *rows):
        names = ("time_tag", "speed", "density", "temperature", "bx", "by", "bz", "bt")
        lines = [
            row if isinstance(row, str) else json.dumps(dict(zip(names, row, strict=True)))
            for row in rows
        ]
        (self.folder / f"{self.files:03d}.txt").write_text("\n".join(lines))
        self.files += 1

    def stream(self):
        raw = stream_files(self.spark, str(self.folder), "text", "value string")
        return raw.select(F.col("value").cast("binary").alias("data"))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def minute(i: int, **measures):
    return record(f"2026-01-01T{i // 60:02d}:{i % 60:02d}:30Z", **measures)


def run_windows(feed, tmp_path):
    windows = stream_speed_windows(score_events(parse_events(feed.stream())))
    query = start_speed_windows(
        windows, str(tmp_path / "out"), str(tmp_path / "checkpoint"), availableNow=True
    )
    query.awaitTermination()
    return feed.spark.read.parquet(str(tmp_path / "out"))


def as_set(windows):
    return {
        (r["window"]["start"], r["window"]["end"], r["window_label"], r["rolling_avg_speed"],
         r["rolling_min_speed"], r["rolling_max_speed"], r["rolling_avg_density"],
         r["rolling_avg_disturbance"], round(r["speed_volatility"], 9))
        for r in windows.collect()
    }


def test_closed_windows_equal_the_batch_windows(spark, feed, tmp_path):
    rows = [minute(i, speed=400.0 + 7 * (i % 5)) for i in range(60)]
    feed.add(*rows)
    found = run_windows(feed, tmp_path)
    live = score_events(parse_events(spark.createDataFrame(
        [(json.dumps(dict(zip(("time_tag", "speed", "density"), r[:3], strict=True))),) for r in rows],
        "data string")))
    closed = speed_windows(live).where(F.col("window.end") <= F.lit(datetime(2026, 1, 1, 0, 45)))
    assert as_set(found) == as_set(closed)


def test_late_records_and_restart(feed, tmp_path):
    feed.add(*[minute(i, speed=500.0) for i in range(3)])
    assert run_windows(feed, tmp_path).count() == 0
    # the sentinel closes the first windows once the next run starts
    feed.add(minute(600))
    first = run_windows(feed, tmp_path)
    opening = datetime(2026, 1, 1, 0, 0)
    one = (F.col("window_label") == "1 minute") & (F.col("window.start") == opening)
    assert [r["rolling_max_speed"] for r in first.where(one).collect()] == [500.0]
    count = first.count()
    feed.add(minute(0, speed=900.0), minute(599, speed=450.0), minute(700))
    second = run_windows(feed, tmp_path)
    assert [r["rolling_max_speed"] for r in second.where(one).collect()] == [500.0]
    # a late record within the allowed delay still counts
    within = (F.col("window_label") == "1 minute") & (F.col("rolling_max_speed") == 450.0)
    assert second.where(within).count() == 1
    assert second.count() > count


def test_source_is_read_once(feed, tmp_path):
    feed.add(*[minute(i) for i in range(60)])
    windows = stream_speed_windows(score_events(parse_events(feed.stream())))
    query = start_speed_windows(
        windows, str(tmp_path / "out"), str(tmp_path / "checkpoint"), availableNow=True
    )
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 60
    assert {len(p["stateOperators"]) for p in query.recentProgress} == {1}


def test_parse_events(spark):
    texts = [
        '{"time_tag":"2026-01-01T00:00:00Z","speed":500,"density":1.5,"more":1}',
        '{"time_tag":"2026-01-01T00:00:00Z","speed":"412","density":1.5}',
        '{"time_tag":"garbage","speed":500}',
        "not json",
    ]
    raw = spark.createDataFrame([(t.encode(),) for t in texts], "data binary")
    parsed = parse_events(raw).collect()
    assert [r["speed"] for r in parsed] == [500.0, None, 500.0, None]
    assert [r["event_ts"] is None for r in parsed] == [False, False, True, True]
    assert [r["payload"] for r in rejected_events(raw).collect()] == texts[2:]
    scored = score_events(parse_events(raw))
    assert [r["disturbance_score"] for r in scored.collect()] == [5, 3, 5, 3]
    assert score_events(parse_events(raw), clean=True).count() == 0


# --- trailing windows ----------------------------------------------------------------


def run_rolling(feed, tmp_path):
    live = str(tmp_path / "live")
    query = start_rolling_snapshots(
        parse_events(feed.stream()),
        lambda snapshots, batch_id: upsert_snapshots(snapshots, live, batch_id),
        str(tmp_path / "checkpoint"),
        availableNow=True,
    )
    query.awaitTermination()
    return read_snapshots(feed.spark, live)


def plain(snapshots):
    return sorted(tuple(r) for r in snapshots.drop("batch_id").collect())


def test_batches_in_order_equal_the_batch_operator(spark, feed, tmp_path):
    rows = sample_rows()
    for part in (rows[:3], rows[3:4], rows[4:12], rows[12:]):
        feed.add(*part)
        found = run_rolling(feed, tmp_path)
    assert plain(found) == plain(rolling_snapshot(sample(spark)))
    assert [r[0] for r in found.select("batch_id").distinct().orderBy("batch_id").collect()] == [0, 1, 2, 3]


def test_late_rows_see_their_own_window(feed, tmp_path):
    feed.add(minute(0, speed=300.0), minute(4, speed=400.0), minute(20, speed=500.0))
    run_rolling(feed, tmp_path)
    # within the delay of ten minutes, and beyond it
    feed.add(minute(12, speed=600.0), minute(5, speed=900.0))
    run_rolling(feed, tmp_path)
    feed.add(minute(16, speed=700.0))
    found = {r["current_speed"]: r["window_size"] for r in run_rolling(feed, tmp_path).collect()}
    assert found == {300.0: 1, 400.0: 2, 500.0: 1, 600.0: 1, 700.0: 2}


def test_a_batch_without_usable_rows(feed, tmp_path):
    feed.add(record("garbage"))
    assert run_rolling(feed, tmp_path).count() == 0
    feed.add(minute(1), minute(2))
    assert sorted(r["window_size"] for r in run_rolling(feed, tmp_path).collect()) == [1, 2]


def test_repeated_batch_replaces_its_snapshots(spark, tmp_path):
    path = str(tmp_path / "live")
    snapshots = rolling_snapshot(records(spark, ("2026-01-01T00:00:00Z",), ("2026-01-01T00:01:00Z",)))
    upsert_snapshots(snapshots, path, 0)
    upsert_snapshots(snapshots.limit(1), path, 0)
    assert read_snapshots(spark, path).count() == 1


# --- archive and sources -------------------------------------------------------------


def test_archive(spark, tmp_path, feed):
    lines = ['{"a":1}', "zweite Zeile ü"]
    feed.add(*[base64.b64encode(line.encode()).decode() for line in lines], "%%%")
    stream = feed.stream().withColumn("arrival_ts", F.lit("2026-03-04 05:06:07").cast("timestamp"))
    query = start_archive(
        stream.withColumn("data", F.col("data").cast("string")),
        str(tmp_path / "raw"),
        str(tmp_path / "checkpoint"),
        availableNow=True,
    )
    query.awaitTermination()
    folder = tmp_path / "raw" / "year=2026" / "month=03" / "day=04" / "hour=05"
    assert sorted(r[0] for r in spark.read.text(str(folder)).collect()) == sorted([*lines, "%%%"])
    again = spark.createDataFrame([(base64.b64encode(b"x").decode(),)], "d string")
    archive_batch(
        again.withColumn("t", F.lit("2026-03-04 05:59:59").cast("timestamp")),
        str(tmp_path / "raw"),
        data="d",
        arrival="t",
    )
    assert spark.read.text(str(folder)).count() == 4


def test_csv_replay(spark, tmp_path):
    sample(spark).repartition(4).write.option("header", True).csv(str(tmp_path / "csv"))
    stream = stream_files(spark, str(tmp_path / "csv"), max_files_per_trigger=1)
    query = (
        stream.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_stream_source_options(spark):
    rate = stream_observations(spark, "rate", rowsPerSecond="5")
    assert rate.isStreaming
    with pytest.raises(ValueError, match="start position"):
        stream_observations(spark, "rate", start="MIDDLE")
    # the connector is not on the class path here; the request gets as far as looking for it
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        stream_observations(spark, "kinesis", "solar", "TRIM_HORIZON", region="eu-west-1")


def test_stream_state_holds_panes_and_visits_only_those_of_new_records(feed, tmp_path):
    feed.add(*[minute(i) for i in range(0, 600, 2)])
    run_rolling(feed, tmp_path)
    feed.add(minute(601))
    query = start_rolling_snapshots(
        parse_events(feed.stream()), lambda rows, batch_id: rows.count(), str(tmp_path / "checkpoint"), availableNow=True
    )
    query.awaitTermination()
    (state,) = query.recentProgress[-1]["stateOperators"]
    # ten hours are ten panes of an hour; the new record is seen from one, and old ones are dropped by their timers
    assert state["numRowsUpdated"] == 1 and state["numRowsRemoved"] == 9


def test_rejects_are_told_apart(feed, tmp_path):
    feed.add(minute(100), minute(20), record("garbage"), record("2026-01-01T01:00:00Z", bt=None), record("2999-01-01T00:00:00Z"))
    told = []

    def run():
        query = start_rolling_snapshots(
            parse_events(feed.stream()),
            lambda rows, batch_id: told.extend((r["time_tag"], "snapshot", batch_id) for r in rows.collect()),
            str(tmp_path / "checkpoint"),
            rejects=lambda rows, batch_id: told.extend((r["time_tag"], r["reason"], batch_id) for r in rows.collect()),
            availableNow=True,
        )
        query.awaitTermination()

    run()
    feed.add(minute(95), minute(80))
    run()
    assert sorted((t[11:16] if t != "garbage" else t, reason, b) for t, reason, b in told) == sorted([
        ("01:40", "snapshot", 0), ("00:20", "snapshot", 0), ("garbage", "time", 0), ("01:00", "measure", 0),
        ("00:00", "ahead", 0), ("01:35", "snapshot", 1), ("01:20", "late", 1),
    ])


def test_window_totals_equal_a_loop():
    import random

    import numpy as np

    from helio.streaming.trailing import TICK, merged_ticks, window_stats

    pick = random.Random(2)
    rows = [(pick.randrange(200), 1, *(v := [pick.uniform(1, 9) for _ in range(3)]), v[0], v[0]) for _ in range(300)]
    ticks = merged_ticks(np.array(rows, dtype=TICK))
    us = np.array(sorted({r[0] for r in rows}))
    got = window_stats(ticks, us, 17)
    for k, t in enumerate(us.tolist()):
        own = [r for r in rows if t - 17 <= r[0] <= t]
        want = (len(own), *[sum(r[i] for r in own) for i in (2, 3, 4)], min(r[2] for r in own), max(r[2] for r in own))
        assert tuple(got[f"w_{c}"][k] for c in ("n", "speed", "density", "bt", "lo", "hi")) == pytest.approx(want)


def test_archive_files_hold_a_hundred_records_and_empty_batches_write_none(spark, tmp_path, feed):
    def run():
        stream = feed.stream().withColumn("arrival_ts", F.lit("2026-03-04 05:06:07").cast("timestamp"))
        encoded = stream.withColumn("data", F.base64("data"))
        query = start_archive(encoded, str(tmp_path / "raw"), str(tmp_path / "checkpoint"), availableNow=True)
        query.awaitTermination()

    feed.add(*[f"line {i}" for i in range(250)])
    run()
    folder = tmp_path / "raw" / "year=2026" / "month=03" / "day=04" / "hour=05" / "second=050607"
    files = sorted(folder.glob("*.txt"))
    assert sorted(len(f.read_text().splitlines()) for f in files) == [50, 100, 100]
    (feed.folder / "nothing.txt").write_text("")
    run()
    assert sorted(folder.glob("*.txt")) == files


def test_archive_folders_of_one_source_file_are_written_by_several_tasks(spark, tmp_path, feed):
    feed.add(*[f"line {i}" for i in range(400)])
    second = F.element_at(F.split(F.col("data").cast("string"), " "), 2).cast("int") % 20
    stream = feed.stream().withColumn("arrival_ts", F.timestamp_seconds(F.lit(1772600760) + second))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        query = start_archive(stream.withColumn("data", F.base64("data")), str(tmp_path / "raw"), str(tmp_path / "checkpoint"), availableNow=True)
        query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = list((tmp_path / "raw").glob("year=*/month=*/day=*/hour=*/second=*/*.txt"))
    assert sorted(len(f.read_text().splitlines()) for f in files) == [20] * 20
    # part-<task>-...: one source file made one task write every folder
    assert len({f.name.split("-")[1] for f in files}) > 1


# --- snapshot log ----------------------------------------------------------------------


@pytest.fixture
def log(spark, tmp_path):
    path = str(tmp_path / "log")
    days = [records(spark, *[(f"2026-01-{d:02d}T00:00:{i:02d}Z", 400.0 + d) for i in range(4)]) for d in range(1, 10)]
    for batch, day in enumerate(days):
        upsert_snapshots(rolling_snapshot(day), path, batch)
    # the ninth batch revises two old keys and one new one
    late = records(spark, ("2026-01-02T00:00:01Z", 900.0), ("2026-01-03T00:00:00Z", 900.0), ("2026-01-09T00:00:03Z", 900.0))
    upsert_snapshots(rolling_snapshot(late), path, 9)
    return path


def test_only_the_newest_days_are_read(spark, log):
    found = latest_snapshots(read_snapshot_log(spark, log), 6)
    assert [r["time_tag"][8:19] for r in found.collect()] == ["08T00:00:02", "08T00:00:03", *[f"09T00:00:0{i}" for i in range(4)]]
    assert found.collect()[-1]["current_speed"] == 900.0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [day" in plan
    assert "2026-01-08" in plan and "2026-01-07" not in plan
    assert latest_snapshots(read_snapshot_log(spark, log), 1000).count() == 36


def test_compaction_keeps_the_newest_versions(spark, log):
    def newest():
        return sorted(map(tuple, latest_snapshots(read_snapshot_log(spark, log), 1000).collect()))

    before = newest()
    assert compact_snapshots(spark, log, before="2026-01-05") == ["2026-01-02", "2026-01-03"]
    assert newest() == before
    days = snapshot_days(read_snapshot_log(spark, log))
    assert days["2026-01-02"] == {9} and days["2026-01-09"] == {8, 9} and days["2026-01-01"] == {0}
    assert read_snapshots(spark, log).count() == 37
    assert compact_snapshots(spark, log) == ["2026-01-09"]
    assert compact_snapshots(spark, log) == []
    assert newest() == before


# --- serving and producing ---------------------------------------------------------------


def test_replaced_documents_show_in_the_next_batch(spark, tmp_path):
    snapshots = rolling_snapshot(sample(spark))
    layout = OutputLayout(str(tmp_path / "batch"))

    def run(own, averages):
        snapshots.where(own).write.mode("append").parquet(str(tmp_path / "in"))
        if averages:
            write_document(spark.createDataFrame([averages[:1]], "avg_speed double"), layout.document("summary"))
            write_document(spark.createDataFrame([averages[1:]], "p95 double, p99 double"), layout.document("percentiles"))
        live = stream_files(spark, str(tmp_path / "in"), "parquet", snapshots.schema)
        sink = once_per_batch(str(tmp_path / "out"), "parquet")
        start_serving_merge(live, layout.base, sink, str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()

    day = F.substring("time_tag", 1, 10)
    # no document is there yet, then one, then another
    run(F.col("current_speed") < 500, None)
    run((F.col("current_speed") >= 500) & (day == "2026-07-25"), (500.0, 600.0, 700.0))
    run((F.col("current_speed") >= 500) & (day == "2026-07-26"), (550.0, 650.0, 750.0))
    found = spark.read.parquet(str(tmp_path / "out")).groupBy("batch_id").agg(
        F.collect_set(F.struct(*[F.coalesce(c, F.lit(-1.0)) for c in ("historical_avg_speed", "historical_p95_speed", "historical_p99_speed")])).alias("h")
    )
    assert {r["batch_id"]: [tuple(h) for h in r["h"]] for r in found.collect()} == {
        0: [(-1.0, -1.0, -1.0)], 1: [(500.0, 600.0, 700.0)], 2: [(550.0, 650.0, 750.0)],
    }


def test_a_repeated_batch_produces_each_record_once(spark, feed, tmp_path):
    feed.add('{"speed": 1, "time": "t"}', "broken", '[{"speed": 2, "time": "u"}, 5]')
    sink, rejects = once_per_batch(str(tmp_path / "out")), once_per_batch(str(tmp_path / "bad"))
    calls = []

    def send(rows, batch_id):
        sink(rows, batch_id)
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost after writing")

    def run():
        query = start_produce(stream_files(spark, str(feed.folder), "text", "value string"), send, str(tmp_path / "checkpoint"), rejects=rejects, availableNow=True)
        query.awaitTermination()

    with pytest.raises(Exception, match="lost after writing"):
        run()
    run()
    assert calls == [0, 0]
    assert sorted(r["key"] for r in spark.read.json(str(tmp_path / "out")).collect()) == ["t", "u"]
    assert sorted(r["payload"] for r in spark.read.json(str(tmp_path / "bad")).collect()) == ['[{"speed": 2, "time": "u"}, 5]', "broken"]
