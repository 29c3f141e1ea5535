"""Semi-structured exploration (C8): infer → expand → nested select →
profile → cast → quarantine tags → overwrite."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from ingot.operators.filters import cast_columns, select_nested
from ingot.operators.merge import overwrite_snapshot
from ingot.operators.quality import column_profile, tag_quarantine
from ingot.sources.documents import expand_documents


@dataclass
class Exploration:
    expanded: DataFrame
    selected: DataFrame
    profile: DataFrame
    tagged: DataFrame


def explore(raw_docs: DataFrame, mapping: dict[str, str], casts: dict[str, str],
            quarantine_if: Column, reason: str, origin: str, at: Column,
            sample_size: int | None = None, target: str | None = None) -> Exploration:
    """Raw ``(_id, body)`` documents through the exploration steps. The schema
    comes from all bodies unless ``sample_size`` bounds the rows looked at. The
    profile is one aggregate pass; the tagged frame keeps every row."""
    expanded = expand_documents(raw_docs, sample_size)
    selected = select_nested(expanded, mapping)
    profile = column_profile(selected)
    typed = cast_columns(selected, casts)
    tagged = tag_quarantine(typed, quarantine_if, reason, origin, at)
    if target:
        overwrite_snapshot(tagged, target)
    return Exploration(expanded, selected, profile, tagged)
