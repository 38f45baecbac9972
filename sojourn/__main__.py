"""Run the jobs from the command line, for instance with ``spark-submit``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .params import Params
from .plans import jobs
from .session import configure, shared_dir
from .sources.tables import Warehouse

REPORTS = ("row_counts", "rebooking", "reliability", "reliability_total", "intent")


def main(argv: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="sojourn", description=__doc__)
    parser.add_argument("--mode", choices=jobs.MODES, default="full")
    for source in ("users", "mentors", "events"):
        parser.add_argument(f"--{source}", help=f"path of the {source} file")
    parser.add_argument("--settings", help="YAML file with parameters")
    parser.add_argument("--database", default="lifecycle")
    parser.add_argument("--location", help="where a new database keeps its tables")
    parser.add_argument("--log", help="folder of the run log")
    args = parser.parse_args(argv)
    sources = {name: getattr(args, name) for name in ("users", "mentors", "events")}
    if args.mode in ("full", "ingest-only") and not all(sources.values()):
        parser.error("--users, --mentors and --events are needed to ingest")

    spark = configure(SparkSession.builder.appName("sojourn").getOrCreate())
    params = Params.from_yaml(args.settings) if args.settings else Params()
    # Each environment has a root of its own, in the folder all executors share if there is one.
    root = "/".join(x for x in (shared_dir(spark), params.warehouse_path) if x)
    location = args.location or params.warehouse or root
    wh = Warehouse(spark, args.database, location)
    out = jobs.run(wh, params, sources, args.mode, args.log)
    for warning in out["warnings"]:
        print("warning:", warning)
    for name in REPORTS:
        if name in out:
            print(name)
            out[name].show(truncate=False)
    return out


if __name__ == "__main__":
    main()
