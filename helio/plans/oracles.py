"""The same answers in plain SQL, written independently of the Spark expressions."""

from __future__ import annotations

OBS = """obs AS (
  SELECT event_id, ts, ts AS time_tag,
    CASE WHEN event_id % 53 = 0 THEN -1::DOUBLE
         WHEN event_id % 59 = 0 THEN NULL
         ELSE 300::DOUBLE + 4::DOUBLE * value END AS speed,
    k / 8::DOUBLE AS density,
    100000::DOUBLE + 1000::DOUBLE * k AS temperature,
    -(event_id % 7) / 2::DOUBLE AS bx,
    (event_id % 11) / 2::DOUBLE AS "by",
    (event_id % 13 - 6) / 2::DOUBLE AS bz,
    CASE WHEN event_id % 41 = 0 THEN NULL
         WHEN event_id % 43 = 0 THEN -0.5::DOUBLE
         ELSE (user_id % 100) / 10::DOUBLE END AS bt,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

BATCH_SCORE = """CAST(
    CASE WHEN {speed} >= 700 THEN 5 WHEN {speed} >= 600 THEN 4 WHEN {speed} >= 500 THEN 3 ELSE 1 END
  + CASE WHEN {density} >= 10 THEN 5 WHEN {density} >= 9 THEN 4 WHEN {density} >= 8 THEN 3 ELSE 1 END
  + CASE WHEN {bt} >= 8 THEN 5 WHEN {bt} >= 7 THEN 4 WHEN {bt} >= 6 THEN 3 ELSE 1 END AS INTEGER)"""

STREAM_SCORE = """CAST(
    CASE WHEN speed >= 700 THEN 5 WHEN speed >= 600 THEN 4 WHEN speed >= 500 THEN 3
         WHEN speed >= 450 THEN 2 ELSE 1 END
  + CASE WHEN density >= 10 THEN 5 WHEN density >= 9 THEN 4 WHEN density >= 8 THEN 3
         WHEN density >= 7 THEN 2 ELSE 1 END
  + CASE WHEN bt >= 8 THEN 5 WHEN bt >= 7 THEN 4 WHEN bt >= 6 THEN 3
         WHEN bt >= 5 THEN 2 ELSE 1 END AS INTEGER)"""

BAND = """CASE WHEN disturbance_score >= 13 THEN 'extreme' WHEN disturbance_score >= 10 THEN 'high'
  WHEN disturbance_score >= 7 THEN 'elevated' ELSE 'baseline' END"""

CLEAN = """cleaned AS (
  SELECT * FROM obs
  WHERE time_tag IS NOT NULL AND speed > 0 AND density > 0 AND bt >= 0)"""


def _rounded(value: str, digits: int, guard: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,{guard})), {digits}) AS DOUBLE)"


def six(value: str) -> str:
    return _rounded(value, 6, 10)


def three(value: str) -> str:
    return _rounded(value, 3, 9)


PREPARED = f"""prepared AS (
  SELECT *, {BAND} AS risk_band,
    CAST(year(ts) AS INTEGER) AS "year", CAST(month(ts) AS INTEGER) AS "month",
    CAST(day(ts) AS INTEGER) AS "day", CAST(hour(ts) AS INTEGER) AS "hour"
  FROM (SELECT *, {BATCH_SCORE.format(speed="speed", density="density", bt="bt")}
          AS disturbance_score FROM cleaned))"""

BATCH = f"WITH {OBS}, {CLEAN}, {PREPARED}"


def _calendar_table(keys: str, prefix: str) -> str:
    return f"""{BATCH}
SELECT {keys}, {six("avg(speed)")} AS {prefix}_avg_speed,
  {six("avg(density)")} AS {prefix}_avg_density,
  {six("avg(disturbance_score)")} AS {prefix}_avg_disturbance
FROM prepared GROUP BY {keys}"""


SUMMARY = f"""SELECT count(*) AS record_count, {three("avg(speed)")} AS avg_speed,
  {three("avg(density)")} AS avg_density, {three("avg(bt)")} AS avg_bt,
  {three("avg(disturbance_score)")} AS avg_disturbance_score,
  max(speed) AS max_speed, min(speed) AS min_speed FROM prepared"""

CORRELATIONS = f"""SELECT {six("corr(speed, density)")} AS speed_density,
  {six("corr(speed, bt)")} AS speed_bt, {six("corr(density, bt)")} AS density_bt FROM prepared"""

EXACT = """SELECT quantile_disc(speed, 0.25) AS p25, quantile_disc(speed, 0.5) AS p50,
  quantile_disc(speed, 0.75) AS p75, quantile_disc(speed, 0.9) AS p90,
  quantile_disc(speed, 0.95) AS p95, quantile_disc(speed, 0.99) AS p99 FROM prepared"""

BREAKDOWN = f"""SELECT risk_band, count(*) AS event_count, {six("avg(speed)")} AS avg_speed,
  {six("avg(density)")} AS avg_density FROM prepared GROUP BY risk_band"""

# label, length and slide in minutes, windows per record
SIZES = (("1 minute", 1, 1, 1), ("5 minutes", 5, 1, 5), ("15 minutes", 15, 5, 3))


# parts of six days that are brought one after the other, every seventh record a part late
STAGED = """staged AS (
  SELECT *, own + CAST(event_id % 7 = 0 AND own < 4 AS INTEGER) AS part
  FROM (SELECT *, CAST(least(4, (day(ts) - 1) // 6) AS INTEGER) AS own FROM obs))"""


def _placed(*sizes: tuple, source: str) -> str:
    parts = [
        f"""SELECT '{label}' AS window_label, {source}.*,
  time_bucket(INTERVAL '{slide} minutes', ts) - i * INTERVAL '{slide} minutes' AS window_start,
  time_bucket(INTERVAL '{slide} minutes', ts) - i * INTERVAL '{slide} minutes'
    + INTERVAL '{length} minutes' AS window_end
FROM {source}, range(0, {copies}) AS r(i)"""
        for label, length, slide, copies in sizes
    ]
    return f"placed AS ({' UNION ALL '.join(parts)})"


WINDOW_FIGURES = f"""SELECT window_start, window_end, window_label, {six("avg(speed)")} AS rolling_avg_speed,
  {six("min(speed)")} AS rolling_min_speed, {six("max(speed)")} AS rolling_max_speed,
  {six("avg(density)")} AS rolling_avg_density,
  {six("avg(disturbance_score)")} AS rolling_avg_disturbance,
  {six("stddev_pop(speed)")} AS speed_volatility"""


def _windows(*sizes: tuple) -> str:
    return f"""WITH {OBS}, scored AS (SELECT *, {STREAM_SCORE} AS disturbance_score FROM obs),
{_placed(*sizes, source="scored")}
{WINDOW_FIGURES} FROM placed GROUP BY window_start, window_end, window_label"""


def _closed_windows(*sizes: tuple) -> str:
    """Windows closed by the end; a record is left out of those that were closed before its part came.

    A window closes when the latest end is six hours and the longest window ahead of its own.
    """
    behind = "INTERVAL '6 hours' - INTERVAL '15 minutes'"
    return f"""WITH {OBS}, {STAGED}, scored AS (SELECT *, {STREAM_SCORE} AS disturbance_score FROM staged),
{_placed(*sizes, source="scored")},
closings AS (SELECT p.part, max(window_end) - {behind} AS closed
  FROM range(1, 6) AS p(part) JOIN placed ON placed.part < p.part GROUP BY p.part)
{WINDOW_FIGURES}
FROM placed LEFT JOIN closings USING (part)
WHERE (closed IS NULL OR window_end > closed) AND window_end <= (SELECT closed FROM closings WHERE part = 5)
GROUP BY window_start, window_end, window_label"""


# records that are more than six hours older than the newest of earlier parts are refused
ARRIVED = f"""{STAGED}, measured AS (
  SELECT * FROM staged WHERE speed IS NOT NULL AND density IS NOT NULL AND bt IS NOT NULL),
floors AS (SELECT p.part, date_trunc('millisecond', max(ts)) - INTERVAL '6 hours' AS oldest
  FROM range(1, 5) AS p(part) JOIN measured ON measured.part < p.part GROUP BY p.part),
arrived AS (SELECT measured.*, oldest IS NOT NULL AND ts < oldest AS late
  FROM measured LEFT JOIN floors USING (part))"""


def _snapshots(minutes: int | None = 5) -> str:
    """CTEs down to ``snaps``, one row per record with a full set of measures; over all time without ``minutes``."""
    reach = f"INTERVAL '{minutes} minutes'" if minutes else "UNBOUNDED"
    score = BATCH_SCORE.format(
        speed="window_avg_speed", density="window_avg_density", bt="window_avg_bt"
    )
    return f"""{OBS}, usable AS (
  SELECT * FROM obs WHERE speed IS NOT NULL AND density IS NOT NULL AND bt IS NOT NULL),
framed AS (
  SELECT iso AS time_tag, speed AS current_speed,
    {three("avg(speed) OVER w")} AS rolling_avg_speed,
    min(speed) OVER w AS rolling_min_speed, max(speed) OVER w AS rolling_max_speed,
    {three("avg(speed) OVER w")} AS window_avg_speed,
    {three("avg(density) OVER w")} AS window_avg_density,
    {three("avg(bt) OVER w")} AS window_avg_bt, count(*) OVER w AS window_size
  FROM usable
  WINDOW w AS (ORDER BY ts RANGE BETWEEN {reach} PRECEDING AND CURRENT ROW)),
snaps AS (
  SELECT *, {BAND} AS risk_band FROM (SELECT *, {score} AS disturbance_score FROM framed))"""


def _snapshots_as_they_came() -> str:
    """A record's window holds what its part or an earlier one brought."""
    score = BATCH_SCORE.format(
        speed="window_avg_speed", density="window_avg_density", bt="window_avg_bt"
    )
    return f"""WITH {OBS}, {ARRIVED}, usable AS (SELECT * FROM arrived WHERE NOT late),
framed AS (
  SELECT r.iso AS time_tag, r.speed AS current_speed, CAST(r.part AS BIGINT) AS batch_id,
    {three("avg(w.speed)")} AS rolling_avg_speed, min(w.speed) AS rolling_min_speed,
    max(w.speed) AS rolling_max_speed, {three("avg(w.speed)")} AS window_avg_speed,
    {three("avg(w.density)")} AS window_avg_density, {three("avg(w.bt)")} AS window_avg_bt,
    count(*) AS window_size
  FROM usable r JOIN usable w
    ON w.ts BETWEEN r.ts - INTERVAL '5 minutes' AND r.ts AND w.part <= r.part
  GROUP BY r.event_id, r.iso, r.speed, r.part)
SELECT *, {BAND} AS risk_band FROM (SELECT *, {score} AS disturbance_score FROM framed)"""


REVISED = """revised AS (
  SELECT * REPLACE (CASE WHEN current_speed < 350 THEN 'revised' ELSE risk_band END AS risk_band),
    translate(time_tag, ':/', '--') AS "key" FROM snaps)"""
LATEST = "latest AS (SELECT * FROM revised ORDER BY \"key\" DESC LIMIT 50)"
SERVED = f"WITH {_snapshots()}, {REVISED}, {LATEST}"
HISTORY = f"{CLEAN}, {PREPARED}, summary AS ({SUMMARY}), ranks AS ({EXACT})"

RAW = """raw AS (
  SELECT event_id, value, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM events)"""

RAW_SPEED = """CASE event_id % 6 WHEN 3 THEN value WHEN 5 THEN value WHEN 4 THEN 1000::DOUBLE
  ELSE {default} END"""

PAYLOAD = """src AS (
  SELECT event_id, event_id % 7 AS shape, value,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
    CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ms, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso
  FROM events),
grids AS (
  SELECT CASE WHEN event_id % 14 = 0 THEN 'later' ELSE iso END AS time_tag,
    list_avg(v) AS speed, CAST(len([x FOR x IN v IF x > 0]) AS DOUBLE) AS density,
    list_max(v) AS temperature, list_avg(v) AS bx,
    CASE WHEN event_id % 70 = 0 THEN 0::DOUBLE ELSE 4::DOUBLE END AS "by",
    0::DOUBLE AS bz, list_max(v) AS bt
  FROM (SELECT *, CASE WHEN event_id % 70 = 0 THEN [0::DOUBLE] ELSE [value, k, k] END AS v
        FROM src WHERE shape = 0)),
features AS (
  SELECT ms AS time_tag, value AS speed,
    CASE WHEN event_id % 2 = 0 THEN k ELSE 3::DOUBLE END AS density,
    0::DOUBLE AS temperature, 0::DOUBLE AS bx, 0::DOUBLE AS "by", 0::DOUBLE AS bz,
    CASE WHEN k = 0 THEN -4::DOUBLE ELSE k END AS bt
  FROM src WHERE shape IN (1, 3)),
flats AS (
  SELECT iso AS time_tag, value AS speed, k AS density, 0::DOUBLE AS temperature,
    0::DOUBLE AS bx, 1::DOUBLE AS "by", 0::DOUBLE AS bz, 0::DOUBLE AS bt
  FROM src WHERE shape IN (1, 2, 4))"""


def _payload_rows(*sources: str) -> str:
    union = " UNION ALL ".join(f"SELECT * FROM {s}" for s in sources)
    rounded = ", ".join(
        f'{six(quoted)} AS {quoted}'
        for quoted in ("speed", "density", "temperature", "bx", '"by"', "bz", "bt")
    )
    return f"WITH {PAYLOAD} SELECT time_tag, {rounded} FROM ({union})"


REFUSED_PAYLOAD = "CASE WHEN event_id % 7 = 6 THEN '{broken' ELSE CAST(value AS VARCHAR) END"


def _averages(prefix: str) -> dict[str, str]:
    return {
        f"{prefix}_avg_speed": six("avg(speed)"),
        f"{prefix}_avg_density": six("avg(density)"),
        f"{prefix}_avg_disturbance": six("avg(disturbance_score)"),
    }


def _cells() -> str:
    """Each column of the five output tables as a row: its number, or its text."""
    numbers = lambda *names: {n: f'"{n}"::DOUBLE' for n in names}
    tables = {
        "daily_speed": ("""concat_ws('-', "year", "month", "day")""", '"year", "month", "day"', {**numbers("year", "month", "day"), **_averages("daily")}, {}),
        "monthly_speed": ("""concat_ws('-', "year", "month")""", '"year", "month"', {**numbers("year", "month"), **_averages("monthly")}, {}),
        "hourly_speed": ('CAST("hour" AS VARCHAR)', '"hour"', {**numbers("hour"), **_averages("hourly")}, {}),
        "storm_events": (
            "iso", "", {**{n: six(n) for n in ("speed", "density", "bt")}, **numbers("disturbance_score")}, {"timestamp": "iso", "risk_band": "risk_band"}
        ),
        "disturbance_breakdown": (
            "risk_band",
            "risk_band",
            {"event_count": "count(*)::DOUBLE", "avg_speed": six("avg(speed)"), "avg_density": six("avg(density)")},
            {"risk_band": "risk_band"},
        ),
    }
    parts = []
    for name, (key, group, figures, texts) in tables.items():
        names = ", ".join(f"'{c}'" for c in [*figures, *texts])
        figure = ", ".join([*figures.values(), *["NULL::DOUBLE" for _ in texts]])
        said = ", ".join([*["NULL::VARCHAR" for _ in figures], *texts.values()])
        rest = f"GROUP BY {group}" if group else "WHERE speed >= 700"
        parts.append(
            f"""SELECT '{name}' AS table_name, {key} AS row_key, unnest([{names}]) AS column_name,
  unnest([{figure}]) AS figure, unnest([{said}]) AS said FROM prepared {rest}"""
        )
    return " UNION ALL ".join(parts)


RECORD = 'speed, density, temperature, bx, "by", bz, bt'
STORMS = "SELECT ts AS \"timestamp\", speed, density, bt, disturbance_score, risk_band FROM prepared WHERE speed >= 700"

ORACLES = {
    "clean_observations": f"WITH {OBS}, {CLEAN} SELECT event_id, time_tag, {RECORD} FROM cleaned",
    "with_calendar": f"""WITH {OBS} SELECT event_id, CAST(year(ts) AS INTEGER) AS "year",
  CAST(month(ts) AS INTEGER) AS "month", CAST(day(ts) AS INTEGER) AS "day",
  CAST(hour(ts) AS INTEGER) AS "hour" FROM obs""",
    "score_batch": f"{BATCH} SELECT event_id, disturbance_score, risk_band FROM prepared",
    "score_stream": f"""WITH {OBS}, scored AS (SELECT event_id, {STREAM_SCORE} AS disturbance_score FROM obs)
SELECT event_id, disturbance_score, {BAND} AS risk_band FROM scored""",
    "daily_speed": _calendar_table('"year", "month", "day"', "daily"),
    "monthly_speed": _calendar_table('"year", "month"', "monthly"),
    "hourly_speed": _calendar_table('"hour"', "hourly"),
    "storm_events": f"{BATCH} {STORMS}",
    "disturbance_breakdown": f"{BATCH} {BREAKDOWN}",
    "summary": f"{BATCH} {SUMMARY}",
    "correlations": f"{BATCH} {CORRELATIONS}",
    "percentiles": """SELECT unnest(['p25', 'p50', 'p75', 'p90', 'p95', 'p99']) AS percentile,
  true AS within_bound""",
    "percentiles_exact": f"{BATCH} {EXACT}",
    "benchmark_stats": f"""WITH {OBS} SELECT count(*) AS records, {three("avg(speed)")} AS avg_speed,
  max(speed) AS max_speed FROM obs""",
    "speed_windows_1m": _windows(SIZES[0]),
    "speed_windows_5m": _windows(SIZES[1]),
    "speed_windows_15m": _windows(SIZES[2]),
    "speed_windows": _windows(*SIZES),
    "speed_windows_stream": _closed_windows(*SIZES),
    "rolling_snapshot": f"WITH {_snapshots()} SELECT * FROM snaps",
    "rolling_snapshot_3h": f"WITH {_snapshots(180)} SELECT * FROM snaps",
    "running_snapshot": f"WITH {_snapshots(None)} SELECT * FROM snaps",
    "rolling_snapshot_stream": _snapshots_as_they_came(),
    "rolling_rejects_stream": f"""WITH {OBS}, {ARRIVED}
SELECT iso AS time_tag, speed, density, bt, 'late' AS reason, CAST(part AS BIGINT) AS batch_id FROM arrived WHERE late
UNION ALL SELECT iso, speed, density, bt, 'measure', CAST(part AS BIGINT) FROM staged
  WHERE speed IS NULL OR density IS NULL OR bt IS NULL""",
    "normalize_rows": f"""WITH {RAW} SELECT
  coalesce(CASE WHEN event_id % 5 > 1 THEN iso END,
    CASE WHEN event_id % 3 <> 0 THEN 'ts-' || event_id END,
    CASE WHEN event_id % 2 = 1 THEN 't-' || event_id END, iso) AS time_tag,
  {RAW_SPEED.format(default="0::DOUBLE")} AS speed,
  CASE WHEN event_id % 4 = 0 THEN 0::DOUBLE ELSE value END AS density, value AS temperature,
  -25::DOUBLE AS bx, 0::DOUBLE AS "by", 0.5::DOUBLE AS bz,
  CASE WHEN event_id % 4 = 1 THEN 0::DOUBLE ELSE 7::DOUBLE END AS bt FROM raw""",
    "coerce_float": f"WITH {RAW} SELECT event_id, {RAW_SPEED.format(default='-1::DOUBLE')} AS number FROM raw",
    "parse_event_time": """SELECT event_id,
  CASE event_id % 9 WHEN 0 THEN ts
    WHEN 1 THEN date_trunc('second', ts) - INTERVAL '330 minutes'
    WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('second', ts)
    WHEN 4 THEN date_trunc('millisecond', ts)
    WHEN 5 THEN TIMESTAMP '1970-01-01' - event_id * INTERVAL '1 second'
    WHEN 8 THEN date_trunc('hour', ts) END AS text_time,
  date_trunc('millisecond', ts) AS number_time FROM events""",
    "normalize_grid": _payload_rows("grids"),
    "normalize_features": _payload_rows("features", "flats"),
    "normalize_payloads": _payload_rows("grids", "features", "flats"),
    "rejected_payloads": f"SELECT event_id, {REFUSED_PAYLOAD} AS payload FROM events WHERE event_id % 7 IN (5, 6)",
    "produce_stream": f"""WITH sent AS ({_payload_rows("grids", "features", "flats")})
SELECT time_tag AS "key", sent.* FROM sent""",
    "produce_rejects_stream": f"""SELECT event_id, {REFUSED_PAYLOAD} AS payload, event_id % 2 AS batch_id
FROM events WHERE event_id % 7 IN (5, 6)""",
    "parse_events": f"""WITH {OBS} SELECT
  {", ".join(f'CASE WHEN event_id % 17 <> 0 THEN {src} END AS {name}' for src, name in (
      ("iso", "time_tag"), ("speed", "speed"), ("density", "density"),
      ("temperature", "temperature"), ("bx", "bx"), ('"by"', '"by"'), ("bz", "bz"), ("bt", "bt"),
      ("ts", "event_ts")))} FROM obs""",
    "rejected_events": "SELECT 'not json' AS payload FROM events WHERE event_id % 17 = 0",
    "rejected_observations": f"""WITH {OBS}, {CLEAN} SELECT event_id, 'garbage' AS time_tag, {RECORD}
FROM cleaned WHERE event_id % 19 = 0""",
    "emit_events": f'WITH {OBS} SELECT iso AS "key", iso AS time_tag, {RECORD} FROM obs',
    "archive_raw": f"""WITH {OBS} SELECT event_id, speed, CAST(year(ts) AS INTEGER) AS "year",
  CAST(month(ts) AS INTEGER) AS "month", CAST(day(ts) AS INTEGER) AS "day",
  CAST(hour(ts) AS INTEGER) AS "hour" FROM obs""",
    "upsert_snapshots": f"{SERVED} SELECT * FROM revised",
    "compact_snapshots": f"""{SERVED}, days AS (SELECT substr("key", 1, 10) AS "day", * FROM revised)
SELECT "day", count(*) + CASE WHEN "day" < '2024-01-20' THEN 0 ELSE count(*) FILTER (risk_band = 'revised') END AS versions,
  count(DISTINCT time_tag) AS "keys", count(*) FILTER (risk_band = 'revised') AS revised,
  CASE WHEN "day" < '2024-01-20' OR count(*) FILTER (risk_band = 'revised') = 0 THEN 1::BIGINT ELSE 2::BIGINT END AS batches
FROM days GROUP BY "day" """,
    "latest_snapshots": f'{SERVED} SELECT * EXCLUDE ("key") FROM latest',
    "display_rows": f"""{SERVED} SELECT time_tag, current_speed, rolling_avg_speed, disturbance_score,
  risk_band FROM latest ORDER BY "key" DESC LIMIT 10""",
    "live_series": f"""{SERVED} SELECT strptime(time_tag, '%Y-%m-%dT%H:%M:%S.%fZ') AS time_tag,
  current_speed, rolling_avg_speed FROM latest""",
    "serving_merge": f"""WITH {_snapshots()}, {HISTORY} SELECT time_tag, current_speed, rolling_avg_speed,
  summary.avg_speed AS historical_avg_speed, ranks.p95 AS historical_p95_speed,
  ranks.p99 AS historical_p99_speed, disturbance_score, risk_band FROM snaps, summary, ranks""",
    "serving_view_stream": f"""WITH {_snapshots()}, {CLEAN}, {PREPARED},
known AS (SELECT 0 AS half, * FROM prepared WHERE day(ts) <= 15 UNION ALL SELECT 1, * FROM prepared),
figures AS (SELECT half, {three("avg(speed)")} AS historical_avg_speed,
  quantile_disc(speed, 0.95) AS historical_p95_speed, quantile_disc(speed, 0.99) AS historical_p99_speed
  FROM known GROUP BY half)
SELECT time_tag, current_speed, rolling_avg_speed, historical_avg_speed, historical_p95_speed,
  historical_p99_speed, disturbance_score, risk_band, CAST(half AS BIGINT) AS batch_id
FROM snaps JOIN figures ON half = CAST(substr(time_tag, 9, 2) > '15' AS INTEGER)""",
    "serving_view": f"""{SERVED}, {HISTORY} SELECT summary.avg_speed AS historical_avg_speed,
  ranks.p95 AS historical_p95_speed, current_speed AS latest_current_speed,
  rolling_avg_speed AS latest_rolling_avg_speed, disturbance_score AS latest_disturbance_score,
  risk_band AS latest_risk_band, {three("current_speed - summary.avg_speed")} AS freshness_gap
FROM (SELECT * FROM latest ORDER BY "key" DESC LIMIT 1), summary, ranks""",
    "overview": f"""WITH {OBS}, {HISTORY} SELECT record_count, avg_speed, max_speed, min_speed,
  avg_disturbance_score, p95 AS p95_speed FROM summary, ranks""",
    "daily_series": f"""{BATCH} SELECT make_date("year", "month", "day") AS "date",
  {six("avg(speed)")} AS daily_avg_speed FROM prepared GROUP BY 1""",
    "roundtrip_csv": f'{BATCH} SELECT event_id, ts AS "timestamp", {RECORD} FROM prepared',
    "roundtrip_outputs": f"{BATCH} {_cells()}",
    "roundtrip_documents": f"""{BATCH}, summary AS ({SUMMARY}), pairs AS ({CORRELATIONS})
SELECT summary.*, pairs.*, {", ".join(f"true AS p{p}" for p in (25, 50, 75, 90, 95, 99))} FROM summary, pairs""",
    "replay_stream": f"WITH {OBS} SELECT event_id, time_tag, {RECORD}, true AS in_batches FROM obs",
}
