"""Plan facts of a query (E1/E2): what reached the scan, and the wall time against an SLA."""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame

LOOKUP_SLA_SECONDS = 2.0


def plan_facts(df: DataFrame) -> dict:
    """Pushed filters, partition filters, read schema and node names of the executed plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {
        "pushed_filters": re.findall(r"PushedFilters: \[([^\]]*)\]", plan),
        "partition_filters": re.findall(r"PartitionFilters: \[([^\]]*)\]", plan),
        "read_schema": re.findall(r"ReadSchema: (struct<[^>]*>)", plan),
        "has_exchange": "Exchange" in plan,
        "codegen_stages": len(re.findall(r"\*\(\d+\)", plan)),
    }


def timed_report(df: DataFrame, sla_seconds: float = LOOKUP_SLA_SECONDS) -> dict:
    """Run the query (collect — meant for lookups with tiny results), time it, add plan facts."""
    t = time.perf_counter()
    rows = df.collect()
    elapsed = time.perf_counter() - t
    return {"rows": len(rows), "seconds": round(elapsed, 4), "within_sla": elapsed < sla_seconds, **plan_facts(df)}


def _scans(node) -> list:
    """The file scans of an executed plan."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _scans(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return _scans(node.plan())
    if name == "FileSourceScanExec":
        return [node]
    children = node.children()
    return [s for i in range(children.size()) for s in _scans(children.apply(i))]


def scan_facts(df: DataFrame, under: str) -> dict:
    """Run the query; files that its scans under a folder opened, and rows that came out of them.

    The reference reads rows and buffers from the database's own plan report; these are the scan's own counters."""
    run = df._jdf.queryExecution()
    rows = run.toRdd().count()
    files = out = 0
    for scan in _scans(run.executedPlan()):
        roots = scan.relation().location().rootPaths()
        if any(under in roots.apply(i).toString() for i in range(min(roots.size(), 1))):
            files += scan.metrics().apply("numFiles").value()
            out += scan.metrics().apply("numOutputRows").value()
    return {"rows": rows, "files_opened": files, "rows_scanned": out}
