"""Print the physical plan facts of the stateless registered queries.

    python tools_plans.py /root/testdata/sf0.1 > PLANS.md

For each query: pushed filters and read schema of every scan, the
exchanges (shuffles) and their partitioning, join strategies, aggregate
kinds, and whether a Python evaluation appears (it should not). Stateful
queries (which write and read back) are left out: their plans are reads
of freshly written tables.
"""

from __future__ import annotations

import re
import sys

from ingot.queries import all_queries  # noqa: E402
from ingot.session import build_session

STATEFUL_MODULES = {f"ingot.queries.{m}" for m in ("state_queries", "bronze_queries", "run_queries", "kept_queries")}

KEEP = re.compile(r"^\(\d+\) (Scan|Exchange|BroadcastExchange|SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
                  r"HashAggregate|SortAggregate|ObjectHashAggregate|Window|Generate|TakeOrderedAndProject|"
                  r"BatchEvalPython|ArrowEvalPython|Sort|Expand)")
DETAIL = re.compile(r"^(PushedFilters|ReadSchema|Arguments|Join type|Keys|PartitionFilters): (.*)$")


def facts(plan: str) -> list[str]:
    out, current = [], None
    for line in plan.splitlines():
        m = KEEP.match(line)
        if m:
            current = line.strip()
            out.append(f"- `{current}`")
            continue
        if current:
            d = DETAIL.match(line.strip())
            if d and d.group(2) not in ("[]", "") and "isFinalPlan" not in d.group(2):
                val = d.group(2)
                if len(val) > 160:
                    val = val[:157] + "..."
                out.append(f"  - {d.group(1)}: `{val}`")
    return out


def merge_plan(spark, sf: str) -> str:
    """Plan of the insert-only merge (J1) for a second delivery of events
    into a bronze table holding the first, with the batch's key range."""
    import datetime as dt
    from pyspark.sql import functions as F
    from ingot.operators.lineage import add_lineage
    from ingot.operators.merge import insert_only_merge, insert_only_rows, read_table
    from ingot.session import new_workspace
    ws = new_workspace(spark, "plan-merge")
    ev = spark.read.parquet(f"{sf}/events.parquet")
    now = dt.datetime(2024, 2, 1)
    insert_only_merge(spark, add_lineage(ev.where("ts < '2024-01-20'"), "event_id", "r1", "full", now), f"{ws}/t")
    second = add_lineage(ev.where("ts >= '2024-01-10'"), "event_id", "r2", "full", now)
    rows = insert_only_rows(second, read_table(spark, f"{ws}/t"), key_range=("1000", "9999"))
    return df_facts(rows)


def bucketed_plan(spark, sf: str) -> str:
    """The same on a bucketed catalogue table: the join that finds the new
    keys, without broadcasts, as for a target of any size."""
    import datetime as dt
    import uuid
    from ingot.operators import bucketed
    from ingot.operators.lineage import add_lineage
    from ingot.session import new_workspace
    t = bucketed.BucketedTable(f"plans_{uuid.uuid4().hex[:8]}", "events", f"{new_workspace(spark, 'plan-bucketed')}/t", buckets=8)
    ev = spark.read.parquet(f"{sf}/events.parquet")
    now = dt.datetime(2024, 2, 1)
    bucketed.insert_new(spark, add_lineage(ev.where("ts < '2024-01-20'"), "event_id", "r1", "full", now), t)
    second = add_lineage(ev.where("ts >= '2024-01-10'"), "event_id", "r2", "full", now)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return df_facts(bucketed.new_keys(spark, bucketed.batch_keys(second, t), t, ("1000", "9999")))


def df_facts(df) -> str:
    formatted = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree = formatted.split("\n\n")[0]
    return "```\n" + tree.strip() + "\n```\n\n" + ("\n".join(facts(formatted)) or "- (local relation)")


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Physical plans of the stateless queries\n")
    print(f"Generated by `tools_plans.py` on `{sf}` (local[8], AQE on; plans shown before AQE re-planning).\n")
    for name, fn in sorted(all_queries().items()):
        if fn.__module__ in STATEFUL_MODULES:
            continue
        df = fn(spark, sf)
        formatted = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        print(f"## {name}\n")
        print("\n".join(facts(formatted)) or "- (local relation)")
        print()
    print("## insert_only_merge (J1): second delivery, key-range pruning on\n")
    print(merge_plan(spark, sf))
    print()
    print("## bucketed insert-only merge (J1): second delivery, no exchange on the target\n")
    print(bucketed_plan(spark, sf))
    print()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
