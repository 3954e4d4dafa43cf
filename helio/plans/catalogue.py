"""The checked queries: every operator over the whole ``events`` table of a scale factor.

Means are rounded to six digits and times returned without a zone, so that another
engine's answer can be compared value by value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce_float, disturbance_score, parse_event_time
from ..operators import aggregates as agg
from ..operators import normalize as norm
from ..operators import serving
from ..operators.clean import (
    clean_observations,
    prepare_observations,
    rejected_observations,
    with_calendar,
    with_event_time,
    with_score,
)
from ..operators.quantiles import exact_percentiles
from ..operators.trailing import rolling_snapshot, running_snapshot
from ..operators.windows import (
    FIFTEEN_MINUTES,
    FIVE_MINUTES,
    ONE_MINUTE,
    SPECS,
    WindowSpec,
    speed_windows,
)
from ..schema import MEASURES, OBSERVATION, REQUIRED_COLUMNS
from ..session import configure, shared_path
from ..sources import (
    OutputLayout,
    emit_events,
    read_document,
    read_observations,
    read_output,
    read_snapshot_log,
    read_snapshots,
    stream_files,
    write_document,
)
from ..streaming import (
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
from .batch import write_batch_outputs
from .obs import as_observations, events, iso_text, observations

NTZ = "timestamp_ntz"


def six(value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.round(F.round(column, 10), 6)


def _six_all(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: six(name) for name in doubles})


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_observations(observations(configure(spark), sf_dir))


def _obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(configure(spark), sf_dir)


def _plain_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(NTZ) for name in columns})


# --- batch layer ---------------------------------------------------------------------


def clean(spark, sf_dir):
    kept = clean_observations(_obs(spark, sf_dir)).select("event_id", *REQUIRED_COLUMNS)
    return _plain_time(kept, "time_tag")


def calendar(spark, sf_dir):
    dated = with_calendar(with_event_time(_obs(spark, sf_dir)))
    return dated.select("event_id", "year", "month", "day", "hour")


def score(kind: str):
    def query(spark, sf_dir):
        rows = _obs(spark, sf_dir)
        rows = clean_observations(rows) if kind == "batch" else rows
        return with_score(rows, kind).select("event_id", "disturbance_score", "risk_band")

    return query


def table(build):
    return lambda spark, sf_dir: _six_all(build(_prepared(spark, sf_dir)))


def storms(spark, sf_dir):
    return _plain_time(agg.storm_events(_prepared(spark, sf_dir)), "timestamp")


def summary(spark, sf_dir):
    return agg.summary(_prepared(spark, sf_dir))


def correlations(spark, sf_dir):
    return _six_all(agg.correlations(_prepared(spark, sf_dir)))


def _within_bound(rows: DataFrame, found: Column) -> DataFrame:
    """For each percentile in the struct ``found`` whether its true rank lies within the promised error."""
    ranked = rows.select("speed", found.alias("found")).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("speed") < F.col("found")[p]).alias(f"lt_{p}") for p in agg.PERCENTILES],
        *[F.count_if(F.col("speed") <= F.col("found")[p]).alias(f"le_{p}") for p in agg.PERCENTILES],
    )
    slack = agg.RANK_ERROR
    return ranked.select(
        *[
            ((F.col(f"le_{name}") >= (p - slack) * F.col("n")) & (F.col(f"lt_{name}") <= (p + slack) * F.col("n"))).alias(name)
            for name, p in agg.PERCENTILES.items()
        ]
    )


def percentiles_in_bound(spark, sf_dir):
    """Whether each approximate percentile's true rank lies within the promised error."""
    rows = _prepared(spark, sf_dir)
    checked = _within_bound(rows, agg.percentiles(rows).select(F.struct(*agg.PERCENTILES)).scalar())
    return checked.select(
        F.inline(F.array(*[F.struct(F.lit(p).alias("percentile"), F.col(p).alias("within_bound")) for p in agg.PERCENTILES]))
    )


def percentiles_exact(spark, sf_dir):
    return exact_percentiles(_prepared(spark, sf_dir))


def benchmark_stats(spark, sf_dir):
    return agg.benchmark_stats(_obs(spark, sf_dir))


# --- event-time windows --------------------------------------------------------------


def _live(rows: DataFrame) -> DataFrame:
    return score_events(rows.withColumn("event_ts", F.col("time_tag")))


def _flat_windows(windows: DataFrame) -> DataFrame:
    return _six_all(windows).select(
        F.col("window.start").cast(NTZ).alias("window_start"),
        F.col("window.end").cast(NTZ).alias("window_end"),
        *[c for c in windows.columns if c != "window"],
    )


def windows(*specs: WindowSpec):
    def query(spark, sf_dir):
        return _flat_windows(speed_windows(_live(_obs(spark, sf_dir)), specs))

    return query


#: Files are staged part by part, each of some days, with every seventh record a part late.
PARTS, PART_DAYS, LATE_EVERY = 5, 6, 7
#: Seconds that records may be late: part of the late ones are in time, the others are not.
STAGED_DELAY = 6 * 3600


def _staged(rows: DataFrame) -> DataFrame:
    """``rows`` of the events table with the ``part`` that brings them."""
    own = F.least(F.lit(PARTS - 1), F.floor((F.dayofmonth("ts") - 1) / PART_DAYS))
    late = (F.col("event_id") % LATE_EVERY == 0) & (own < PARTS - 1)
    return rows.withColumn("part", own + late.cast("int"))


def _replay(spark: SparkSession, sf_dir: str, base: str, start, **options) -> DataFrame:
    """Stage the events in time order and run ``start`` on the stream of them after each part.

    Each run stops when it has read all files and the next one goes on from its checkpoint.
    """
    staged = _staged(events(configure(spark), sf_dir))
    for part in range(PARTS):
        staged.where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{base}/in")
        stream = stream_files(spark, f"{base}/in", "parquet", staged.drop("part").schema, **options)
        start(as_observations(stream)).awaitTermination()


def windows_stream(spark, sf_dir):
    base = shared_path(spark, "windows")

    def start(rows: DataFrame):
        closed = stream_speed_windows(_live(rows), delay=STAGED_DELAY)
        return start_speed_windows(closed, f"{base}/out", f"{base}/checkpoint", availableNow=True)

    _replay(spark, sf_dir, base, start)
    return _flat_windows(spark.read.parquet(f"{base}/out"))


# --- trailing windows ----------------------------------------------------------------


def _iso_obs(rows: DataFrame) -> DataFrame:
    return rows.withColumn("time_tag", iso_text())


def rolling(spark, sf_dir):
    return rolling_snapshot(_iso_obs(_obs(spark, sf_dir)))


def rolling_wide(spark, sf_dir):
    return rolling_snapshot(_iso_obs(_obs(spark, sf_dir)), minutes=180)


def running(spark, sf_dir):
    return running_snapshot(_iso_obs(_obs(spark, sf_dir)))


def _rolling_stream(spark: SparkSession, sf_dir: str) -> str:
    """Snapshots and refused records of the staged stream, by micro-batch."""
    base = shared_path(spark, "rolling")

    def sink(snapshots: DataFrame, batch_id: int) -> None:
        upsert_snapshots(snapshots, f"{base}/live", batch_id)

    def refuse(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/refused/batch_id={batch_id}")

    def start(rows: DataFrame):
        live = _iso_obs(rows)
        return start_rolling_snapshots(live, sink, f"{base}/checkpoint", delay=STAGED_DELAY, rejects=refuse, availableNow=True)

    _replay(spark, sf_dir, base, start)
    return base


def rolling_stream(spark, sf_dir):
    return read_snapshots(spark, f"{_rolling_stream(spark, sf_dir)}/live")


def rolling_stream_rejects(spark, sf_dir):
    base = _rolling_stream(spark, sf_dir)
    schema = "time_tag string, speed double, density double, bt double, reason string, batch_id long"
    return spark.read.schema(schema).parquet(f"{base}/refused")


# --- record normalisation ------------------------------------------------------------


def _raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as flat text rows with missing, padded and unreadable fields."""
    ident = F.col("event_id")
    iso = iso_text("ts")
    value = F.col("value").cast("string")
    numbers = (
        F.when(ident % 6 == 0, F.lit(None).cast("string"))
        .when(ident % 6 == 1, "")
        .when(ident % 6 == 2, "abc")
        .when(ident % 6 == 3, F.concat(F.lit(" "), value, F.lit(" ")))
        .when(ident % 6 == 4, "1_000")
        .otherwise(value)
    )
    none = F.lit(None).cast("string")
    return events(configure(spark), sf_dir).select(
        "event_id",
        F.when(ident % 5 == 0, "").when(ident % 5 == 1, none).otherwise(iso).alias("time_tag"),
        F.when(ident % 3 == 0, "").otherwise(F.concat(F.lit("ts-"), ident)).alias("timestamp"),
        F.when(ident % 2 == 0, none).otherwise(F.concat(F.lit("t-"), ident)).alias("time"),
        iso.alias("arrival"),
        numbers.alias("speed"),
        F.when(ident % 4 == 0, "1.5d").otherwise(value).alias("density"),
        value.alias("temperature"),
        F.lit("-2.5e1").alias("bx"),
        none.alias("by"),
        F.lit(".5").alias("bz"),
        F.when(ident % 4 == 1, "0x1p3").otherwise("+7.").alias("bt"),
    )


def normalize_rows(spark, sf_dir):
    return norm.normalize_rows(_raw_rows(spark, sf_dir), arrival="arrival")


def coerce(spark, sf_dir):
    rows = _raw_rows(spark, sf_dir)
    return rows.select("event_id", coerce_float(F.col("speed"), -1.0).alias("number"))


def event_time(spark, sf_dir):
    ident, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    text = (
        F.when(ident % 9 == 0, iso_text("ts"))
        .when(ident % 9 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+05:30'"))
        .when(ident % 9 == 2, F.date_format("ts", " yyyy-MM-dd HH:mm:ss "))
        .when(ident % 9 == 3, F.unix_seconds(ts).cast("string"))
        .when(ident % 9 == 4, F.unix_millis(ts).cast("string"))
        .when(ident % 9 == 5, F.concat(F.lit("-"), ident))
        .when(ident % 9 == 6, "")
        .when(ident % 9 == 7, "garbage")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH"))
    )
    rows = events(configure(spark), sf_dir).select("event_id", "ts", "value", text.alias("text"))
    number = F.unix_millis(ts) / 1000.0
    return rows.select(
        "event_id",
        parse_event_time(F.col("text")).cast(NTZ).alias("text_time"),
        parse_event_time(number, T.DoubleType()).cast(NTZ).alias("number_time"),
    )


def _json_number(name: str) -> Column:
    return F.col(name).cast("string")


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON payload per event: grids, envelopes, lists, single objects and scalars."""
    rows = events(configure(spark), sf_dir)
    k = F.get_json_object("props", "$.k")
    value, ident, iso = _json_number("value"), F.col("event_id"), iso_text("ts")

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    cells = F.when(ident % 70 == 0, "").otherwise(
        text("[1,2,", value, "],[", k, '],"x",[4,"b","', k, '",9]')
    )
    grid = text(
        '{"Observation Time":"',
        F.when(ident % 14 == 0, "").otherwise(iso),
        '","Forecast Time":"later","coordinates":[',
        cells,
        "]}",
    )
    feature = text(
        '{"properties":{"time":',
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
        ',"mag":0,"magnitude":',
        value,
        ',"depth":3,"sig":',
        k,
        ',"bt":-4},"geometry":{"coordinates":[1,2',
        F.when(ident % 2 == 0, text(",", k)).otherwise(""),
        "]}}",
    )
    flat = text(
        '{"timestamp":"', iso, '","speed":', value, ',"density":" ', k, ' ","bx":null,"by":true,',
        '"extra":[1]}',
    )
    payload = (
        F.when(ident % 7 == 0, grid)
        .when(ident % 7 == 1, text('{"features":[', feature, ",", flat, "]}"))
        .when(ident % 7 == 2, text('{"features":null,"results":[', flat, "]}"))
        .when(ident % 7 == 3, text("[", feature, "]"))
        .when(ident % 7 == 4, flat)
        .when(ident % 7 == 5, value)
        .otherwise("{broken")
    )
    return rows.select("event_id", payload.alias("payload"), iso.alias("arrival"))


def normalize(build):
    return lambda spark, sf_dir: _six_all(build(_payloads(spark, sf_dir), arrival="arrival"))


def rejected(spark, sf_dir):
    return norm.rejected_payloads(_payloads(spark, sf_dir), keep=("event_id",))


def _produced(spark: SparkSession, sf_dir: str) -> str:
    """Payloads staged in two parts, each read as a stream that goes on from its checkpoint."""
    base = shared_path(spark, "produce")
    staged = _payloads(spark, sf_dir)
    for part in range(2):
        staged.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{base}/in")
        query = start_produce(
            stream_files(spark, f"{base}/in", "parquet", staged.schema),
            once_per_batch(f"{base}/out"),
            f"{base}/checkpoint",
            payload="payload",
            arrival="arrival",
            rejects=once_per_batch(f"{base}/rejects"),
            keep=("event_id",),
            availableNow=True,
        )
        query.awaitTermination()
    return base


def produced(spark, sf_dir):
    sent = spark.read.schema("key string, value string").json(f"{_produced(spark, sf_dir)}/out")
    rows = sent.select("key", F.from_json("value", OBSERVATION).alias("r")).select("key", "r.*")
    return _six_all(rows)


def produce_rejects(spark, sf_dir):
    return spark.read.schema("event_id bigint, payload string, batch_id bigint").json(f"{_produced(spark, sf_dir)}/rejects")


# --- stream records ------------------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as JSON stream records, some of them malformed."""
    rows = _iso_obs(_obs(spark, sf_dir))
    sent = emit_events(rows.select(*REQUIRED_COLUMNS, "event_id"), key="event_id")
    ident = F.col("key").cast("bigint")
    body = F.when(ident % 17 == 0, F.lit("not json")).otherwise(F.col("value"))
    return sent.select(ident.alias("event_id"), body.cast("binary").alias("data"))


def parsed_events(spark, sf_dir):
    parsed = parse_events(_records(spark, sf_dir)).drop("ingested_at")
    return _plain_time(parsed, "event_ts")


def refused_events(spark, sf_dir):
    return rejected_events(_records(spark, sf_dir))


def refused_observations(spark, sf_dir):
    rows = _iso_obs(_obs(spark, sf_dir))
    text = F.when(F.col("event_id") % 19 == 0, "garbage").otherwise(F.col("time_tag"))
    refused = rejected_observations(rows.withColumn("time_tag", text))
    return refused.select("event_id", *REQUIRED_COLUMNS)


def emitted_events(spark, sf_dir):
    rows = _iso_obs(_obs(spark, sf_dir)).select(*REQUIRED_COLUMNS)
    sent = emit_events(rows, key="no_such_field")
    return sent.select("key", F.from_json("value", OBSERVATION).alias("r")).select("key", "r.*")


def archived(spark, sf_dir):
    base = shared_path(configure(spark), "archive")

    def start(rows: DataFrame):
        records = rows.select(
            F.base64(F.to_json(F.struct("event_id", "speed")).cast("binary")).alias("data"),
            # what an hour brings arrives at its end
            F.date_trunc("hour", "time_tag").alias("arrival_ts"),
        )
        return start_archive(records, f"{base}/out", f"{base}/checkpoint", availableNow=True)

    _replay(spark, sf_dir, base, start)
    line = F.from_json("value", "event_id bigint, speed double")
    return spark.read.text(f"{base}/out").select(
        line["event_id"].alias("event_id"),
        line["speed"].alias("speed"),
        *[F.col(c).cast("int").alias(c) for c in ("year", "month", "day", "hour")],
    )


# --- serving -------------------------------------------------------------------------


def write_snapshot_log(spark: SparkSession, sf_dir: str) -> str:
    """A log of two batches; the second replaces the snapshots of low speeds."""
    base = shared_path(configure(spark), "live")
    upsert_snapshots(rolling_snapshot(_iso_obs(_obs(spark, sf_dir))), base, 0)
    first = read_snapshots(spark, base).where(F.col("batch_id") == 0)
    second = first.where(F.col("current_speed") < 350).withColumn("risk_band", F.lit("revised"))
    upsert_snapshots(second, base, 1)
    return base


def _snapshot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_snapshot_log(spark, write_snapshot_log(spark, sf_dir))


def upserted(spark, sf_dir):
    return serving.newest_per_key(_snapshot_log(spark, sf_dir), ("batch_id",))


def compacted(spark, sf_dir):
    """The log itself after compaction of its older days: one version of each of their keys."""
    base = write_snapshot_log(spark, sf_dir)
    compact_snapshots(spark, base, before="2024-01-20")
    log = read_snapshot_log(spark, base)
    return log.groupBy("day").agg(
        F.count("*").alias("versions"),
        F.count_distinct("time_tag").alias("keys"),
        F.count_if(F.col("risk_band") == "revised").alias("revised"),
        F.count_distinct("batch_id").alias("batches"),
    )


def latest(n: int):
    return lambda spark, sf_dir: serving.latest_snapshots(_snapshot_log(spark, sf_dir), n)


def displayed(spark, sf_dir):
    return serving.display_rows(serving.latest_snapshots(_snapshot_log(spark, sf_dir)))


def live_series(spark, sf_dir):
    series = serving.live_series(serving.latest_snapshots(_snapshot_log(spark, sf_dir)))
    return _plain_time(series, "time_tag")


def merged(spark, sf_dir):
    history = _prepared(spark, sf_dir)
    live = rolling(spark, sf_dir)
    return serving.serving_merge(live, agg.summary(history), exact_percentiles(history))


def serving_stream(spark, sf_dir):
    """Snapshots of the month's halves as a stream; between them the documents are replaced."""
    base = shared_path(configure(spark), "serving")
    snapshots = rolling(spark, sf_dir)
    second = F.substring("time_tag", 9, 2) > "15"
    layout = OutputLayout(f"{base}/batch")

    def sink(merged: DataFrame, batch_id: int) -> None:
        merged.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    for own in (~second, second):
        snapshots.where(own).write.mode("append").parquet(f"{base}/in")
        known = _prepared(spark, sf_dir).where(F.lit(True) if own is second else F.dayofmonth("timestamp") <= 15)
        write_document(agg.summary(known), layout.document("summary"))
        write_document(exact_percentiles(known), layout.document("percentiles"))
        live = stream_files(spark, f"{base}/in", "parquet", snapshots.schema)
        start_serving_merge(live, layout.base, sink, f"{base}/checkpoint", availableNow=True).awaitTermination()
    return spark.read.parquet(f"{base}/out").withColumn("batch_id", F.col("batch_id").cast("bigint"))


def serving_view(spark, sf_dir):
    history = _prepared(spark, sf_dir)
    live = serving.latest_snapshots(_snapshot_log(spark, sf_dir))
    return serving.serving_view(live, agg.summary(history), exact_percentiles(history))


def overview(spark, sf_dir):
    history = _prepared(spark, sf_dir)
    return serving.overview(agg.summary(history), exact_percentiles(history))


def daily_series(spark, sf_dir):
    return _six_all(serving.daily_series(agg.daily_speed(_prepared(spark, sf_dir))))


# --- files ---------------------------------------------------------------------------


def csv_roundtrip(spark, sf_dir):
    base = shared_path(configure(spark), "csv")
    rows = _iso_obs(_obs(spark, sf_dir)).select(*reversed(MEASURES), "time_tag", "event_id")
    rows.write.option("header", True).csv(base)
    read = prepare_observations(read_observations(spark, base))
    kept = read.select(F.col("event_id").cast("bigint").alias("event_id"), "timestamp", *MEASURES)
    return _plain_time(kept, "timestamp")


def _written(spark: SparkSession, sf_dir: str) -> str:
    base = f"{shared_path(configure(spark), 'outputs')}/batch"
    write_batch_outputs(_obs(spark, sf_dir), base)
    return base


def outputs_roundtrip(spark, sf_dir):
    """Every column of the five tables as written: numbers as ``figure``, the rest as ``said``."""
    base = _written(spark, sf_dir)
    keys = {
        "daily_speed": F.concat_ws("-", "year", "month", "day"),
        "monthly_speed": F.concat_ws("-", "year", "month"),
        "hourly_speed": F.col("hour").cast("string"),
        "storm_events": iso_text("timestamp"),
        "disturbance_breakdown": F.col("risk_band"),
    }

    def cell(field: T.StructField) -> Column:
        column, none = F.col(field.name), F.lit(None)
        number = six(column.cast("double")) if isinstance(field.dataType, T.NumericType) else none.cast("double")
        text = iso_text(field.name) if isinstance(field.dataType, T.TimestampType) else column.cast("string")
        said = none.cast("string") if isinstance(field.dataType, T.NumericType) else text
        return F.struct(F.lit(field.name).alias("column_name"), number.alias("figure"), said.alias("said"))

    def cells(name: str) -> DataFrame:
        table = read_output(spark, base, name)
        return table.select(F.lit(name).alias("table_name"), keys[name].alias("row_key"), F.inline(F.array(*[cell(f) for f in table.schema])))

    return reduce(DataFrame.unionByName, [cells(name) for name in keys])


def documents_roundtrip(spark, sf_dir):
    """The three documents as written; of the approximate percentiles, whether each is within its bound."""
    layout = OutputLayout(_written(spark, sf_dir))
    summary_row = read_document(spark, layout.document("summary"))
    pairs = read_document(spark, layout.document("correlations")).select(F.struct(*agg.PAIRS)).scalar()
    ranks = read_document(spark, layout.document("percentiles")).select(F.struct(*agg.PERCENTILES)).scalar()
    checked = _within_bound(_prepared(spark, sf_dir), ranks).select(F.struct(*agg.PERCENTILES)).scalar()
    return summary_row.select(
        "*", *[six(pairs[name]).alias(name) for name in agg.PAIRS], *[checked[name].alias(name) for name in agg.PERCENTILES]
    )


def replayed(spark, sf_dir):
    """All events through a stream of one file at a time, marked with whether there were several micro-batches."""
    base = shared_path(spark, "replay")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    def start(rows: DataFrame):
        stream = rows.select("event_id", *REQUIRED_COLUMNS).writeStream.foreachBatch(keep)
        return stream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()

    _replay(spark, sf_dir, base, start, max_files_per_trigger=1)
    found = spark.read.parquet(f"{base}/out")
    batches = found.agg(F.count_distinct("batch_id")).scalar()
    return _plain_time(found.withColumn("in_batches", batches >= PARTS).drop("batch_id"), "time_tag")


QUERIES = {
    "clean_observations": clean,
    "with_calendar": calendar,
    "score_batch": score("batch"),
    "score_stream": score("stream"),
    "daily_speed": table(agg.daily_speed),
    "monthly_speed": table(agg.monthly_speed),
    "hourly_speed": table(agg.hourly_speed),
    "storm_events": storms,
    "disturbance_breakdown": table(agg.disturbance_breakdown),
    "summary": summary,
    "correlations": correlations,
    "percentiles": percentiles_in_bound,
    "percentiles_exact": percentiles_exact,
    "benchmark_stats": benchmark_stats,
    "speed_windows_1m": windows(ONE_MINUTE),
    "speed_windows_5m": windows(FIVE_MINUTES),
    "speed_windows_15m": windows(FIFTEEN_MINUTES),
    "speed_windows": windows(*SPECS),
    "speed_windows_stream": windows_stream,
    "rolling_snapshot": rolling,
    "rolling_snapshot_3h": rolling_wide,
    "running_snapshot": running,
    "rolling_snapshot_stream": rolling_stream,
    "rolling_rejects_stream": rolling_stream_rejects,
    "normalize_rows": normalize_rows,
    "coerce_float": coerce,
    "parse_event_time": event_time,
    "normalize_grid": normalize(norm.normalize_grid),
    "normalize_features": normalize(norm.normalize_events),
    "normalize_payloads": normalize(norm.normalize_payloads),
    "rejected_payloads": rejected,
    "parse_events": parsed_events,
    "rejected_events": refused_events,
    "rejected_observations": refused_observations,
    "emit_events": emitted_events,
    "archive_raw": archived,
    "produce_stream": produced,
    "produce_rejects_stream": produce_rejects,
    "upsert_snapshots": upserted,
    "compact_snapshots": compacted,
    "latest_snapshots": latest(50),
    "display_rows": displayed,
    "live_series": live_series,
    "serving_merge": merged,
    "serving_view_stream": serving_stream,
    "serving_view": serving_view,
    "overview": overview,
    "daily_series": daily_series,
    "roundtrip_csv": csv_roundtrip,
    "roundtrip_outputs": outputs_roundtrip,
    "roundtrip_documents": documents_roundtrip,
    "replay_stream": replayed,
}
