"""Job entry: `spark-submit ... sift/__main__.py --config_filepath R --processed_date D`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sift import run_folder, run_gate


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sift", description="Run the gate for one table.")
    parser.add_argument("--config_filepath", default="", help="a rule file")
    parser.add_argument("--config_folder", default="", help="a folder of them, one per table")
    parser.add_argument("--processed_date", default="")
    parser.add_argument("--semantics", choices=("legacy", "exact"), default="legacy")
    parser.add_argument("--unknown_keys", choices=("refuse", "pass"), default="refuse")
    parser.add_argument("--faithful_rejects", action="store_true")
    parser.add_argument("--reject_malformed", action="store_true")
    parser.add_argument("--explain", action="store_true")
    parser.add_argument("--latest_by", help="columns, with commas; makes duplicate_check a key")
    parser.add_argument("--source_bytes", type=int)
    args = parser.parse_args(argv)
    if bool(args.config_filepath) == bool(args.config_folder):
        parser.error("give either --config_filepath or --config_folder")
    spark = SparkSession.builder.appName("sift").getOrCreate()
    run = run_gate if args.config_filepath else run_folder
    run(
        spark,
        args.config_filepath or args.config_folder,
        args.processed_date,
        semantics=args.semantics,
        strict=args.unknown_keys == "refuse",
        faithful_rejects=args.faithful_rejects,
        reject_malformed=args.reject_malformed,
        explain=args.explain,
        latest_by=None if args.latest_by is None else [c for c in args.latest_by.split(",") if c],
        source_bytes=args.source_bytes,
    )


if __name__ == "__main__":
    main()
