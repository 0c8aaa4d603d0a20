"""Command line: `python -m lavra STEP ...`; `python -m lavra STEP --help` lists the options."""

from __future__ import annotations

import argparse
import logging
import sys

from lavra.plans import runs
from lavra.session import build_session
from lavra.sources.tables import LayerStore
from lavra.streaming.ingest import read_stream, run_bounded

# One batch per interval: longer intervals write fewer and larger files.
STREAM_SECONDS = 10


def main(argv: list[str] | None = None) -> int:
    """Run one step; 0 on success, 1 if it failed, for instance on a critical check."""
    parser = argparse.ArgumentParser(prog="lavra")
    steps = parser.add_subparsers(dest="step", required=True)
    for name in (
        "bronze", "silver", "gold", "validate", "stream", "event", "places", "replay", "clean",
        "compact",
    ):
        step = steps.add_parser(name)
        if name not in ("places", "replay"):
            step.add_argument("--root", required=True, help="folder of all layers")
        if name == "bronze":
            step.add_argument("--format", default="table", help="table, parquet, csv, ...")
            step.add_argument("--location", required=True, help="name or path with {name}")
            step.add_argument("--places-csv", required=True, help="place reference file")
        elif name in ("silver", "gold"):
            step.add_argument(
                "--share-years", action="store_true", help="write and check changed years only"
            )
        elif name == "event":
            step.add_argument("--message", required=True, help="one JSON event")
            step.add_argument("--source", required=True, help="what the event came from")
            step.add_argument("--writer", required=True, help="the partition it came from")
            step.add_argument("--offset", type=int, required=True, help="its place there")
            step.add_argument("--base64", action="store_true", help="the message is Base64")
        elif name == "validate":
            step.add_argument("layer", nargs="?", default="silver", choices=("silver", "gold"))
        elif name == "stream":
            step.add_argument("--format", default="kafka")
            step.add_argument("--location", required=True, help="topic or folder")
            step.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
            step.add_argument("--base64", action="store_true", help="messages are Base64")
            step.add_argument("--max-messages", type=int, default=500)
            step.add_argument("--window-seconds", type=float, default=120.0)
        elif name == "places":
            step.add_argument("--json", required=True, help="landed place records")
            step.add_argument("--lines", action="store_true", help="one record per line")
            step.add_argument("--csv", required=True, help="reference file to write")
        elif name == "replay":
            step.add_argument("--table", required=True, help="Parquet folder to sample")
            step.add_argument("--limit", type=int, default=500)
            step.add_argument("--format", default="kafka", help="kafka or text")
            step.add_argument("--location", required=True, help="topic or folder")
        elif name == "clean":
            step.add_argument("layer", choices=("bronze", "silver", "gold"))
            step.add_argument("--keep", type=int, default=1, help="versions that stay")
    args = parser.parse_args(argv)
    spark = build_session()
    config = runs.Config(
        getattr(args, "root", "").rstrip("/"), share_years=getattr(args, "share_years", False)
    )
    try:
        _step(spark, config, args)
    except Exception:
        logging.exception("%s failed", args.step)
        return 1
    return 0


def _step(spark, config: runs.Config, args: argparse.Namespace) -> None:
    if args.step == "bronze":
        sources = runs.published_sources(args.format, args.location)
        sources.append(runs.source("ibge_municipios", "csv", args.places_csv))
        runs.build_bronze(spark, config, sources)
    elif args.step == "silver":
        runs.run_silver(spark, config)
    elif args.step == "gold":
        runs.run_gold(spark, config)
    elif args.step == "validate":
        runs.validate(spark, config, args.layer)
    elif args.step == "places":
        runs.convert_places(
            spark, args.json, args.csv, "places_json_lines" if args.lines else "places_json"
        )
    elif args.step == "replay":
        table = spark.read.parquet(args.table)
        runs.replay_events(spark, table, args.limit, args.format, args.location)
    elif args.step == "compact":
        runs.compact_events(spark, config)
    elif args.step == "event":
        runs.ingest_event(
            spark, config, args.message, args.source, args.writer, args.offset, args.base64
        )
    elif args.step == "clean" and args.layer == "bronze":
        runs.clean_stream(spark, config)
    elif args.step == "clean":
        LayerStore(spark, config.root).remove_unlisted(args.layer, args.keep)
    else:
        options = dict(pair.split("=", 1) for pair in args.option)
        messages = read_stream(spark, args.format, args.location, options)
        trigger = {"processingTime": f"{STREAM_SECONDS} seconds"}
        written: dict[int, int] = {}
        query = runs.stream_bronze(
            spark, config, messages, args.location, trigger, args.base64, written
        )
        run_bounded(query, args.max_messages, args.window_seconds, written=written)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="{levelname:>8} {name}: {message}", style="{")
    sys.exit(main())
