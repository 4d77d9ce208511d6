"""python -m canopyspark run INPUT OUTPUT [--setting value ...]: runs the pipeline over a folder; exit code 1 if an image failed.
python -m canopyspark clean OUTPUT RUN_ID: deletes a run's intermediate layers. Every setting is an option of its own name."""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from canopyspark.config import PipelineConfig
from canopyspark.operators.manifest import FAILED
from canopyspark.pipeline import run_pipeline
from canopyspark.sources.tables import KEPT, clean_run


def _settings(parser: argparse.ArgumentParser) -> None:
    for f in fields(PipelineConfig):
        kind = type(f.default)
        option = "--" + f.name.lower().replace("_", "-")
        extra = {"action": argparse.BooleanOptionalAction} if kind is bool else {"type": kind}
        parser.add_argument(option, dest=f.name, default=f.default, **extra)


def _run(spark: SparkSession, args: argparse.Namespace) -> int:
    config = PipelineConfig(**{f.name: getattr(args, f.name) for f in fields(PipelineConfig)})
    summary = run_pipeline(spark, args.source, args.target, config)
    counts = summary.groupBy("status").agg(F.count("*").alias("images"), F.round(F.sum("runtime_seconds"), 1).alias("seconds"))
    for row in counts.orderBy("status").collect():
        print(f"{row['status']}: {row['images']} images, {row['seconds']} s")
    failed = summary.where(F.col("status") == FAILED)
    failed.select("image_key", "error").show(50, truncate=100)
    return int(not failed.isEmpty())


def _clean(spark: SparkSession, args: argparse.Namespace) -> int:
    for layer in clean_run(spark, args.target, args.run_id, keep=KEPT):
        print(f"deleted {layer}")
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="canopyspark")
    commands = parser.add_subparsers(required=True)
    run = commands.add_parser("run")
    run.add_argument("source")
    run.add_argument("target")
    _settings(run)
    run.set_defaults(call=_run)
    clean = commands.add_parser("clean")
    clean.add_argument("target")
    clean.add_argument("run_id")
    clean.set_defaults(call=_clean)
    args = parser.parse_args(argv)
    return args.call(SparkSession.builder.appName("canopyspark").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())
