"""Command line: ``python -m roadlens.cli <input path> <output prefix> [options]`` (SRC-2).

Writes ``SpeedRadar.csv``, ``AverageSpeedControl.csv`` and ``AccidentReporter.csv`` (Spark
output folders) under the output prefix. ``--stream`` watches the input folder with
Structured Streaming instead (drains what is there and stops, unless ``--continuous``).
"""

from __future__ import annotations

import argparse

from roadlens.config import Params
from roadlens.plans.jobs import run_all, stream_all
from roadlens.schema import ARRIVAL, ORDER
from roadlens.session import build_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="roadlens")
    ap.add_argument("input", help="CSV report file(s) or folder (or a parquet table with --parser parquet)")
    ap.add_argument("output", help="output prefix (folder)")
    ap.add_argument("--stream", action="store_true", help="Structured Streaming over a folder")
    ap.add_argument("--continuous", action="store_true", help="keep the stream running")
    ap.add_argument("--keep-open", action="store_true", help="drain, but leave open sessions to a later --stream run")
    ap.add_argument("--seconds", action="store_true", help="read `time` as seconds (gap 31 s)")
    ap.add_argument("--arrival-order", action="store_true", help="batch: take a vehicle's reports as they arrived, not by time (radar, accidents)")
    ap.add_argument("--parser", choices=["strict", "csv", "parquet"], default="strict")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    params = Params(time_unit="s" if args.seconds else "ms")
    if args.stream:
        ends = not (args.continuous or args.keep_open)
        queries = stream_all(
            spark, args.input, args.output, params, available_now=not args.continuous, end_of_input=ends
        )
        for q in queries:
            q.awaitTermination()
    else:
        run_all(spark, args.input, args.output, params, parser=args.parser, order=ARRIVAL if args.arrival_order else ORDER)
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
