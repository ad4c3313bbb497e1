"""Command line: run stage 1, stage 2, or both (gated) on a cluster.

    spark-submit --py-files orderflow.zip orderflow/__main__.py run \
        --raw s3a://raw --processed s3a://processed --curated s3a://curated
    python -m orderflow run --root /data/run-1 --show

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
resources and ``spark.checkpoint.dir`` are whatever spark-submit (or the
environment's defaults) configured.
"""

from __future__ import annotations

import argparse

from orderflow.plans import stages
from orderflow.sources import io
from orderflow.specs import ENTITIES


def _zones(args: argparse.Namespace) -> io.Zones:
    return io.Zones(args.root or "", args.raw, args.processed, args.curated)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="orderflow")
    parser.add_argument("command", choices=("stage1", "stage2", "run"))
    parser.add_argument("--root", help="folder holding raw/, processed/ and curated/")
    parser.add_argument("--raw", help="raw zone (one CSV folder per entity)")
    parser.add_argument("--processed", help="processed zone")
    parser.add_argument("--curated", help="curated zone")
    parser.add_argument("--show", action="store_true", help="print the summaries")
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"orderflow-{args.command}").getOrCreate()
    zones = _zones(args)
    if args.command == "stage1":
        raw = {name: io.read_csv(spark, zones.raw(name)) for name in ENTITIES}
        result = stages.process_raw(spark, raw, zones)
    elif args.command == "stage2":
        result = stages.curate(spark, zones)
    else:
        result = stages.run(spark, zones, show_summaries=args.show)
    if args.show and args.command != "run":
        for frame in result.frames.values():
            frame.show(truncate=False)
    for name, path in result.outputs.items():
        print(f"{name}\t{path}")
    return 0
