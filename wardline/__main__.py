"""Command line: sample, validate, and run the stages over a folder of CSV tables."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from wardline.operators.sampling import sample_and_extract
from wardline.operators.validate import validate
from wardline.plans import pipeline
from wardline.registry import MERGE_MINUTES, MIN_FREQUENCY, PERCENTILE, SAMPLE_SIZE, SEED
from wardline.sources import files


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="python -m wardline", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    sample = commands.add_parser("sample", help="an exact stratified sample of persons and all their rows")
    sample.add_argument("--input", required=True)
    sample.add_argument("--output", required=True)
    sample.add_argument("--sample-size", type=int, default=SAMPLE_SIZE)
    sample.add_argument("--prefixes", nargs="*")
    sample.add_argument("--seed", type=int, default=SEED)
    sample.add_argument("--resume", action="store_true", help="leave tables that are complete")
    check = commands.add_parser("validate", help="existence, columns and keys; exit code 1 on errors")
    check.add_argument("--input", required=True)
    report = commands.add_parser("report", help="rows, columns and emptiest columns of each table")
    report.add_argument("--input", required=True)
    run = commands.add_parser("run", help="profile, cleaning, mapping, standardization, extraction")
    run.add_argument("--input", required=True)
    run.add_argument("--output", required=True)
    run.add_argument("--mappings", help="folder of <TABLE>_mapping_reference.csv")
    run.add_argument("--start-from", choices=pipeline.plan())
    run.add_argument("--skip-modules", nargs="*", default=[], choices=pipeline.plan())
    run.add_argument("--dry-run", action="store_true")
    run.add_argument("--min-concept-freq", type=int, default=MIN_FREQUENCY)
    run.add_argument("--no-dedup", action="store_true")
    run.add_argument("--outlier-percentile", type=float, default=PERCENTILE)
    run.add_argument("--approx", action="store_true")
    run.add_argument("--no-merge-visits", action="store_true")
    run.add_argument("--merge-threshold", type=float, default=MERGE_MINUTES / 60, help="hours")
    run.add_argument("--by-person", action="store_true", help="also write one folder per person")
    for command in commands.choices.values():
        command.add_argument("--multiline", action="store_true", help="quoted fields hold line breaks; each file is then read by one task")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("wardline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    tables = files.catalog(spark, args.input, multiline=args.multiline)
    if args.command == "report":
        print(files.text_report(tables))
        return 0
    if args.command == "sample":
        for name, df in sample_and_extract(tables, size=args.sample_size, seed=args.seed, prefixes=args.prefixes).items():
            files.write_csv(df, f"{args.output}/{name}", "resume" if args.resume else "overwrite")
        return 0
    if args.command == "validate":
        verdict = validate(tables, sizes=files.sizes(spark, args.input))
        for kind, lines in (("error", verdict.errors), ("warning", verdict.warnings), ("note", verdict.notes)):
            for line in lines:
                print(f"{kind}: {line}")
        print("passed" if verdict.passed else "failed")
        return int(not verdict.passed)
    mappings = files.catalog(spark, args.mappings, "_mapping_reference") if args.mappings else {}
    config = pipeline.Config(min_concept_freq=args.min_concept_freq, deduplicate=not args.no_dedup, outlier_percentile=args.outlier_percentile, approx=args.approx, merge_visits=not args.no_merge_visits, merge_minutes=60 * args.merge_threshold, mappings=mappings)
    state, outcome = pipeline.run({n: files.with_position(df) for n, df in tables.items()}, config, args.start_from, args.skip_modules, args.dry_run, f"{args.output}/stages")
    for name, what in outcome.items():
        print(f"{name}: {what}")
    if not args.dry_run:
        for name, df in state.tables.items():
            files.write_csv(df, f"{args.output}/tables/{name}")
            if args.by_person and "person_id" in df.columns:
                files.write_by_person(df, f"{args.output}/persons/{name}")
        for side, frames in (("rejected", state.rejected), ("stats", state.stats)):
            for name, df in frames.items():
                files.write_csv(df, f"{args.output}/{side}/{name}", single=side == "stats")
        files.write_csv(pipeline.timings(state, spark), f"{args.output}/timings", single=True)
    failed = [n for n, _, required in pipeline.STAGES if required and outcome[n] == "failed"]
    return int(bool(failed))


if __name__ == "__main__":
    sys.exit(main())
