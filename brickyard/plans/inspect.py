"""Plan inspection: the physical plan as text, and counts of the nodes in it.

Used by tests to assert plan shape (join node, exchanges, pushed filters,
partition filters) and by the bench to record it next to each timing.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def physical_plan(df: DataFrame) -> str:
    """The physical plan (AQE's initial plan before execution, the final plan
    after), as ``explain()`` would print it."""
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(plan: str, node: str) -> int:
    """Occurrences of a physical node name (e.g. ``Exchange hashpartitioning``)."""
    return len(re.findall(re.escape(node), plan))


def shape(df: DataFrame) -> dict[str, int]:
    """Counts of the nodes that decide cost at scale."""
    p = physical_plan(df)
    return {
        "scans": count_nodes(p, "FileScan"),
        "exchanges": count_nodes(p, "Exchange"),
        "broadcast_joins": count_nodes(p, "BroadcastHashJoin"),
        "sort_merge_joins": count_nodes(p, "SortMergeJoin"),
        "windows": len(re.findall(r"(?m)^\s*[:+\- ]*Window \[", p)),
        "sorts": len(re.findall(r"(?m)^\s*[:+\- ]*Sort \[", p)),
    }


def isolated(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of its own on the same context, with the time zone of ``spark`` and ``settings``; nothing set in it
    reaches ``spark``."""
    own = spark.newSession()
    for key, value in {"spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"), **settings}.items():
        own.conf.set(key, value)
    return own
