"""Jobs for spark-submit: ``spark-submit wattloom/plans/jobs.py <job> ...`` or ``python -m wattloom.plans.jobs``.

batch       compact records to the five serving tables
live        a stream of mains records to the live power table
alerts      a stream of compact records to overshoot alerts
clean-days  channel files to clean-day files
replay      channel, clean-day, label and house files to compact records
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from wattloom.functions.days import parse_anchor
from wattloom.operators.quality import MAX_GAP
from wattloom.operators.readings import (
    expand_readings,
    parse_json,
    record_mains_power,
    rejected_input,
    rejected_mains_records,
    to_messages,
)
from wattloom.operators.replicate import CALENDAR_DAYS
from wattloom.plans.batch import ingest, run_batch
from wattloom.plans.prep import clean_days_of, replay_records
from wattloom.session import build_session
from wattloom.sources import files
from wattloom.sources.quarantine import quarantine_files
from wattloom.sources.records import publish, read_records, stream_values
from wattloom.streaming.power import TRIGGER, start_alerts, start_mains_power, start_quarantine, stored_stats


def _options(pairs: Sequence[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _stream(spark: SparkSession, args: argparse.Namespace):
    return parse_json(stream_values(spark, args.format, args.path, **_options(args.option)))


def _trigger(args: argparse.Namespace) -> str | None:
    return None if args.once else args.trigger


def batch(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.part:
        run_batch(read_records(spark, *args.records), args.root, args.part)
    else:
        ingest(spark, args.root, *args.records)


def until_end(*queries: StreamingQuery) -> None:
    """Wait for all streams; one that dies takes the others with it."""
    waiting = list(queries)
    try:
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(1)]
    except Exception:
        for query in waiting:
            query.stop()
        raise


def live(spark: SparkSession, args: argparse.Namespace) -> None:
    records = _stream(spark, args)
    aside = start_quarantine(records, rejected_mains_records, args.root, f"{args.checkpoint}-rejects", _trigger(args))
    power = record_mains_power(records)
    until_end(aside, start_mains_power(power, args.root, args.checkpoint, args.window, _trigger(args), args.merge))


def alerts(spark: SparkSession, args: argparse.Namespace) -> None:
    records = _stream(spark, args)
    aside = start_quarantine(records, rejected_input, args.root, f"{args.checkpoint}-rejects", _trigger(args))
    stats = stored_stats(args.root)
    until_end(aside, start_alerts(expand_readings(records), stats, args.root, args.checkpoint, args.margin, args.salts, _trigger(args)))


def _channels(spark: SparkSession, args: argparse.Namespace, beside: str):
    """The channel readings; bad lines are set aside, by default in a folder beside the clean days."""
    quarantine_files(files.rejected_channels(spark, *args.channels), args.root or f"{beside.rstrip('/')}-rejects")
    return files.read_channels(spark, *args.channels)


def clean_days(spark: SparkSession, args: argparse.Namespace) -> None:
    found = clean_days_of(_channels(spark, args, args.out), parse_anchor(args.anchor), args.max_gap)
    files.write_clean_days(found, args.out)


def replay(spark: SparkSession, args: argparse.Namespace) -> None:
    records = replay_records(
        _channels(spark, args, args.clean_days),
        files.read_clean_days(spark, args.clean_days),
        files.read_labels(spark, args.labels),
        files.read_houses(spark, args.houses),
        args.days,
        args.shift,
        args.scaled,
    )
    messages = to_messages(records, args.mains_topic, args.appliance_topic)
    publish(messages, args.format, args.path, **_options(args.option))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="wattloom", description=__doc__.split("\n")[0])
    parser.add_argument("--time-zone", default="UTC")
    jobs = parser.add_subparsers(required=True)

    def job(name: str, run, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def connector(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--format", default="kafka")
        sub.add_argument("--path")
        sub.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")

    def streaming(sub: argparse.ArgumentParser) -> None:
        connector(sub)
        sub.add_argument("--trigger", default=TRIGGER)
        sub.add_argument("--once", action="store_true", help="take what is there and stop")

    sub = job("batch", batch, "root")
    sub.add_argument("--records", nargs="+", required=True)
    sub.add_argument("--part", help="take all the files as one run, which replaces an earlier one of this name; by default files that no run has consumed")

    sub = job("live", live, "root", "checkpoint")
    streaming(sub)
    sub.add_argument("--window", default="1 minute")
    sub.add_argument("--merge", action="store_true")

    sub = job("alerts", alerts, "root", "checkpoint")
    streaming(sub)
    sub.add_argument("--margin", type=float, default=0.0)
    sub.add_argument("--salts", type=int, default=8)

    sub = job("clean-days", clean_days, "anchor", "out")
    sub.add_argument("--channels", nargs="+", required=True)
    sub.add_argument("--root", help="rejects go below; by default <out>-rejects")
    sub.add_argument("--max-gap", type=int, default=MAX_GAP)

    sub = job("replay", replay, "clean-days", "labels", "houses")
    connector(sub)
    sub.add_argument("--channels", nargs="+", required=True)
    sub.add_argument("--root", help="rejects go below; by default <clean-days>-rejects")
    sub.add_argument("--days", type=int, default=CALENDAR_DAYS)
    sub.add_argument("--shift", type=int, default=0)
    sub.add_argument("--scaled", action="store_true")
    sub.add_argument("--mains-topic", default="meters_hf")
    sub.add_argument("--appliance-topic", default="meters_lf")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.run(build_session(time_zone=args.time_zone), args)


if __name__ == "__main__":
    main()
