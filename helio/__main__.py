"""Command line: ``python -m helio <command>``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.aggregates import benchmark_stats
from .operators.normalize import normalize_payloads, normalize_rows, rejected_payloads
from .operators.serving import latest_snapshots, serving_merge, serving_view
from .plans.batch import write_batch_outputs
from .session import build_session
from .sources import (
    OutputLayout,
    publish,
    read_document,
    read_observations,
    read_snapshot_log,
    spark_uri,
    stream_files,
    stream_observations,
    write_json_lines,
)
from .streaming import (
    compact_snapshots,
    once_per_batch,
    parse_events,
    score_events,
    start_archive,
    start_produce,
    start_rolling_snapshots,
    start_speed_windows,
    stream_speed_windows,
    upsert_snapshots,
)
from .streaming.windows import DEFAULT_DELAY


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _trigger(args: argparse.Namespace) -> dict:
    if args.once:
        return {"availableNow": True}
    return {"processingTime": f"{args.trigger_seconds} seconds"} if args.trigger_seconds else {}


def _raw_stream(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    raw = stream_observations(
        spark, args.format, args.stream_name, args.starting_position, **_options(args.option)
    )
    return raw.select(F.col(args.payload_column).alias("data"))


def batch(spark: SparkSession, args: argparse.Namespace) -> None:
    observations = read_observations(spark, args.input, args.format)
    write_batch_outputs(observations, args.output, not args.drop_rejects)


def windows(spark: SparkSession, args: argparse.Namespace) -> None:
    scored = score_events(parse_events(_raw_stream(spark, args)), args.clean)
    closing = stream_speed_windows(scored, delay=args.delay)
    start_speed_windows(closing, args.output, args.checkpoint, **_trigger(args)).awaitTermination()


def snapshots(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.input:
        live = stream_files(spark, args.input, max_files_per_trigger=args.files_per_trigger)
    else:
        live = parse_events(_raw_stream(spark, args))
    start_rolling_snapshots(
        live,
        lambda found, batch_id: upsert_snapshots(found, args.output, batch_id),
        args.checkpoint,
        args.window_minutes,
        args.delay,
        rejects=lambda refused, batch_id: refused.withColumn("batch_id", F.lit(batch_id))
        .write.mode("append")
        .json(spark_uri(f"{args.output.rstrip('/')}-rejects")),
        **_trigger(args),
    ).awaitTermination()


def archive(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = _raw_stream(spark, args).withColumn("arrival_ts", F.current_timestamp())
    encoded = raw.withColumn("data", F.base64("data")) if args.binary else raw
    start_archive(encoded, args.output, args.checkpoint, **_trigger(args)).awaitTermination()


def _produce_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = stream_files(spark, args.input, "text", "value string", wholetext="true")
    keyed = once_per_batch(args.output) if args.output else None

    def send(rows: DataFrame, batch_id: int) -> None:
        if args.format == "text":
            keyed(rows, batch_id)
        else:
            rows.write.format(args.format).options(**_options(args.option)).mode("append").save()

    rejects = once_per_batch(f"{args.output.rstrip('/')}-rejects") if args.output else None
    query = start_produce(raw, send, args.checkpoint, key=args.key, rejects=rejects, **_trigger(args))
    query.awaitTermination()


def produce(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.checkpoint:
        return _produce_stream(spark, args)
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    if args.source == "csv":
        raw = read_observations(spark, args.input, typed=False)
        rows = normalize_rows(raw.withColumn("arrival", now), "arrival")
    else:
        raw = spark.read.text(spark_uri(args.input), wholetext=True).withColumn("arrival", now)
        rows = normalize_payloads(raw, "value", "arrival")
        if args.output:
            refused = rejected_payloads(raw, "value")
            refused.write.mode("append").json(spark_uri(f"{args.output.rstrip('/')}-rejects"))
    if args.format == "text":
        write_json_lines(rows, args.output)
    else:
        publish(rows, args.format, args.key, **_options(args.option))


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    for day in compact_snapshots(spark, args.snapshots, args.before):
        print(day)


def _show(df: DataFrame) -> None:
    for row in df.toJSON().toLocalIterator():
        print(row)


def merge(spark: SparkSession, args: argparse.Namespace) -> None:
    layout = OutputLayout(args.output)
    live = latest_snapshots(read_snapshot_log(spark, args.snapshots or layout.snapshots), 1)
    documents = [read_document(spark, layout.document(d)) for d in ("summary", "percentiles")]
    _show((serving_view if args.view else serving_merge)(live, *documents))


def benchmark(spark: SparkSession, args: argparse.Namespace) -> None:
    _show(benchmark_stats(read_observations(spark, args.input, args.format)))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="helio")
    commands = parser.add_subparsers(required=True)

    def command(run, *required: str, **defaults) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__, help=run.__doc__)
        sub.set_defaults(run=run, **defaults)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        return sub

    def stream(sub: argparse.ArgumentParser) -> argparse.ArgumentParser:
        sub.add_argument("--format", default="kafka", help="name of the stream connector")
        sub.add_argument("--stream-name")
        sub.add_argument("--starting-position", default="LATEST", choices=("LATEST", "TRIM_HORIZON"))
        sub.add_argument("--payload-column", default="value")
        sub.add_argument("--option", action="append", default=[], help="connector option, name=value")
        sub.add_argument("--trigger-seconds", type=int, help="seconds between micro-batches")
        sub.add_argument("--once", action="store_true", help="stop when all present data is done")
        return sub

    sub = command(batch, "input", "output")
    sub.add_argument("--format", default="csv")
    sub.add_argument("--drop-rejects", action="store_true", help="write no table of unusable rows")

    sub = stream(command(windows, "output", "checkpoint"))
    sub.add_argument("--delay", type=int, default=DEFAULT_DELAY, help="seconds a record may be late")
    sub.add_argument("--clean", action="store_true")

    sub = stream(command(snapshots, "output", "checkpoint"))
    sub.add_argument("--input", help="folder of CSV files to replay instead of a stream")
    sub.add_argument("--files-per-trigger", type=int)
    sub.add_argument("--window-minutes", type=int, default=5)
    sub.add_argument("--delay", type=int, default=DEFAULT_DELAY)

    sub = stream(command(archive, "output", "checkpoint"))
    sub.add_argument("--binary", action="store_true", help="payload is not base64 text")

    sub = command(produce, "input")
    sub.add_argument("--source", default="csv", choices=("csv", "payloads"))
    sub.add_argument("--output", help="folder for JSON lines when --format is text")
    sub.add_argument("--format", default="text")
    sub.add_argument("--key", default="time_tag")
    sub.add_argument("--option", action="append", default=[])
    sub.add_argument("--checkpoint", help="go on reading payload files as they come")
    sub.add_argument("--trigger-seconds", type=int, help="seconds between micro-batches")
    sub.add_argument("--once", action="store_true", help="stop when all present files are done")

    sub = command(compact, "snapshots")
    sub.add_argument("--before", help="first day that is left as it is")

    sub = command(merge, "output")
    sub.add_argument("--snapshots", help="snapshot log; found from --output by default")
    sub.add_argument("--view", action="store_true", help="show the dashboard figures")

    sub = command(benchmark, "input")
    sub.add_argument("--format", default="csv")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.run(build_session(f"helio {args.run.__name__}"), args)


if __name__ == "__main__":
    main()
