"""Command line: run every configured collection once (C4).

    python -m ingot --config collections.json --base-dir /shared/ingest \\
        --source users=/data/users --source movies=/data/movies [--parallelism 4]

Sources are Parquet folders (or any format given as ``name=format:path``).
Prints this run's control rows as JSON lines; exits non-zero when any
collection FAILED.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from ingot.config import FAILED, load_config
from ingot.plans.bronze import run_all
from ingot.session import apply_defaults


FORMATS = ("parquet", "json", "csv", "orc", "text", "delta")


def _source_reader(spark: SparkSession, spec: str):
    """``path`` (Parquet) or ``format:path`` for one of ``FORMATS``."""
    fmt, path = "parquet", spec
    head, _, rest = spec.partition(":")
    if head in FORMATS and rest:
        fmt, path = head, rest
    return lambda: spark.read.format(fmt).load(path)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m ingot")
    ap.add_argument("--config", required=True, help="JSON file with global settings and collections")
    ap.add_argument("--base-dir", required=True, help="shared folder for landing, bronze and control tables")
    ap.add_argument("--source", action="append", default=[], help="name=path or name=format:path")
    ap.add_argument("--parallelism", type=int, default=1)
    args = ap.parse_args(argv)
    spark = spark or SparkSession.builder.appName("ingot").getOrCreate()
    apply_defaults(spark)
    cfg = load_config(args.config, base_dir=args.base_dir)
    sources = {}
    for item in args.source:
        name, spec = item.split("=", 1)
        sources[name] = _source_reader(spark, spec)
    rows = run_all(spark, cfg, sources, parallelism=args.parallelism).collect()
    for r in rows:
        print(json.dumps(r.asDict(), default=str))
    return 1 if any(r.status == FAILED for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())
