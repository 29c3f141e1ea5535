"""Shared pieces of the registered queries: table access, fixed clocks,
run configs in fresh workspaces, and the SQL spelling of ISO text."""

from __future__ import annotations

import datetime as _dt
import itertools
import uuid

from pyspark.sql import DataFrame, SparkSession

from ingot.config import CollectionConfig, RunConfig
from ingot.session import apply_defaults, new_workspace
from ingot.sources.tables import read_table

# Fixed clock of the registered queries: runs are one minute apart so
# "newest run" is well defined; no wall-clock value reaches a result.
CLOCK_START = _dt.datetime(2024, 2, 1, 0, 0, 0)


def ticking_clock(start: _dt.datetime = CLOCK_START, step_seconds: int = 60):
    counter = itertools.count()
    return lambda: start + _dt.timedelta(seconds=step_seconds * next(counter))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_defaults(spark)
    return read_table(spark, sf_dir, name)


def run_config(spark: SparkSession, label: str, collections: list[CollectionConfig], **kw) -> RunConfig:
    return RunConfig(base_dir=new_workspace(spark, label), collections=tuple(collections), **kw).validate()


def catalogue_schema() -> str:
    """A schema name of its own for one query: its tables are fresh."""
    return f"ingot_{uuid.uuid4().hex[:12]}"


def iso_sql(col: str) -> str:
    """DuckDB spelling of the ISO text Spark lands for a timestamp."""
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%S.%f')"
