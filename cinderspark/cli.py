"""Command line: ``python -m cinderspark.cli STEP``; paths and sizes come from CINDERSPARK_* variables."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cinderspark.plans import risk
from cinderspark.session import CONF


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="cinderspark", description=__doc__)
    steps = out.add_subparsers(dest="step", required=True)
    process = steps.add_parser("process-regions", help="buildings of each region with their risk")
    process.add_argument("regions", nargs="*")
    process.add_argument("--overwrite", action="store_true", help="also regions that are done")
    for name, text in (("partition-buildings", "by state and county"), ("aggregate", "statistics by geography"), ("tiles-input", "newline-delimited features"), ("pyramid", "averaged levels of the surfaces")):
        steps.add_parser(name, help=text)
    for name, text in (("write-analysis", "CSV and GeoJSON of the statistics"), ("run", "all steps")):
        step = steps.add_parser(name, help=text)
        step.add_argument("folder")
    return out


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    builder = SparkSession.builder.appName(f"cinderspark {args.step}")
    for key, value in CONF.items():
        builder = builder.config(key, value)
    spark, settings = builder.getOrCreate(), risk.Settings.from_environment()
    if args.step == "process-regions":
        print("\n".join(risk.process_regions(spark, settings, args.regions or None, args.overwrite)))
    elif args.step == "write-analysis":
        risk.write_analysis(spark, settings, args.folder)
    elif args.step == "run":
        print("\n".join(risk.run_all(spark, settings, args.folder)))
    else:
        {"partition-buildings": risk.partition_buildings, "aggregate": risk.aggregate, "tiles-input": risk.write_tiles_input, "pyramid": risk.write_pyramid}[args.step](spark, settings)


if __name__ == "__main__":
    main()
