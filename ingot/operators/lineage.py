"""Lineage and audit columns.

The load time is taken once per run and embedded as a literal, so every
row of a run carries the same value and re-execution of a task (after a
lost executor) produces identical rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.config import SOURCE_PATH_LABEL

LINEAGE_COLUMNS = ("_source_id", "_ingestion_id", "_ingestion_timestamp", "_source_path",
                   "_load_type", "_ingestion_date")
AUDIT_COLUMNS = ("_run_id", "_source_table", "_ingested_at")


def utc_now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def add_lineage(df: DataFrame, id_field: str, run_id: str, load_type: str,
                now: _dt.datetime, source_path: str = SOURCE_PATH_LABEL) -> DataFrame:
    """Document path lineage: key as string, run id, load time, source
    label, load type and the load date used as the table partition."""
    iso = now.isoformat()
    id_col = F.col(f"`{id_field}`") if id_field in df.columns else F.lit(None)
    return df.withColumns({
        "_source_id": id_col.cast("string"),
        "_ingestion_id": F.lit(run_id),
        "_ingestion_timestamp": F.lit(iso).cast("timestamp"),
        "_source_path": F.lit(source_path),
        "_load_type": F.lit(load_type),
        "_ingestion_date": F.to_date(F.lit(iso)),
    })


def add_audit(df: DataFrame, run_id: str, source_table: str, ingested_at: _dt.datetime,
              enabled: bool = True) -> DataFrame:
    """Relational path audit columns; ``_ingested_at`` is ISO text with the
    UTC offset of the given (aware) time."""
    if not enabled:
        return df
    return df.withColumns({
        "_run_id": F.lit(run_id),
        "_source_table": F.lit(source_table),
        "_ingested_at": F.lit(ingested_at.isoformat()),
    })
