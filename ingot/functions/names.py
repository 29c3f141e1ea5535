"""Column-name operators (P10 sanitise, P11 audit/business split).

Names are computed once on the driver from the schema (metadata only)
and applied positionally with ``toDF``, so two source columns can never
collapse onto one name.
"""

from __future__ import annotations

import re
from itertools import chain, count

from pyspark.sql import DataFrame

# Characters a table column name may not contain.
INVALID_NAME_CHARS = r"[ ,;{}()\n\t=]+"
EMPTY_NAME = "col"
AUDIT_PREFIX = "_"

_INVALID = re.compile(INVALID_NAME_CHARS)


def clean_name(name: str, keep_leading_underscore: bool = True) -> str:
    """Replace runs of invalid characters by one underscore and trim the
    outer underscores the replacement created. A genuine leading
    underscore (audit columns) is kept unless asked otherwise."""
    lead = ""
    if keep_leading_underscore:
        m = re.match(r"_+", name)
        if m:
            lead, name = m.group(0), name[m.end():]
    out = _INVALID.sub("_", name).strip("_")
    if not out:
        return lead + EMPTY_NAME if lead else EMPTY_NAME
    return lead + out


def sanitized_names(names: list[str], keep_leading_underscore: bool = True) -> list[str]:
    """Clean every name, then make them unique case-insensitively by
    suffixing ``_2``, ``_3`` ... in column order."""
    taken: dict[str, str] = {}
    for name in names:
        base = clean_name(name, keep_leading_underscore)
        free = next(c for c in chain([base], (f"{base}_{i}" for i in count(2))) if c.lower() not in taken)
        taken[free.lower()] = free
    return list(taken.values())


def sanitize_columns(df: DataFrame, keep_leading_underscore: bool = True) -> DataFrame:
    return df.toDF(*sanitized_names(df.columns, keep_leading_underscore))


def split_columns(df: DataFrame, prefix: str = AUDIT_PREFIX) -> tuple[list[str], list[str]]:
    """(audit columns, business columns) by name prefix."""
    audit = [c for c in df.columns if c.startswith(prefix)]
    business = [c for c in df.columns if not c.startswith(prefix)]
    return audit, business
