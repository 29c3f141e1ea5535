"""ingot — config-driven ingestion and bronze-layer operators on Spark.

Sub-packages: ``sources`` (scans), ``functions`` (column expressions),
``operators`` (DataFrame → DataFrame / table operators), ``plans``
(composite runs), ``streaming`` (file-arrival ingestion), ``queries``
(the registered query catalogue with DuckDB oracles).

The main entry points are re-exported here::

    from ingot import RunConfig, CollectionConfig, run_all
    control_rows = run_all(spark, RunConfig(base_dir=..., collections=(...)), {"movies": df})
"""

from ingot.config import CollectionConfig, RunConfig, load_config
from ingot.operators.control import ControlLog
from ingot.operators.merge import (compact_partitions, delete_keys, insert_only_merge, latest_per_key,
                                   read_table)
from ingot.plans.bronze import landing_to_bronze, process_collection, replay_from_watermark, run_all
from ingot.plans.relational import consolidate, land_tables
from ingot.session import build_session, shared_dir
from ingot.sources.landing import read_landing
from ingot.streaming.file_ingest import ingest_available

__version__ = "0.1.0"

__all__ = [
    "CollectionConfig", "RunConfig", "load_config", "ControlLog", "compact_partitions", "delete_keys",
    "insert_only_merge", "latest_per_key", "read_table", "landing_to_bronze", "process_collection",
    "replay_from_watermark", "run_all", "consolidate", "land_tables", "build_session", "shared_dir",
    "read_landing", "ingest_available",
]
