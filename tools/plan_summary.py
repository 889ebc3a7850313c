"""Summarise the physical plans of the registered queries into PLANS.md.

usage: python tools/plan_summary.py [sf_dir] [out.md]

Plans are taken with broadcast joins disabled and adaptive execution off, i.e. the static
plan a cluster would start from when every dimension is too big to broadcast. For each
query it lists the shuffles (with their keys), joins (strategy and type), Parquet scans
(read columns and pushed filters), window limits and subqueries.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spendlens.catalog.queries import QUERIES  # noqa: E402
from spendlens.session import BUCKETED_FACTS, local_session  # noqa: E402

SETTINGS = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "false"}


def plan_text(df) -> str:
    """The physical plan as ``df.explain()`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _strip_ids(text: str) -> str:
    return re.sub(r"#\d+L?", "", text)


def summarise(plan: str) -> dict:
    shuffles = [_strip_ids(m.group(1)) for m in re.finditer(
        r"Exchange (hashpartitioning\(.*?, \d+\)|SinglePartition|RoundRobinPartitioning\(\d+\))",
        plan)]
    joins = [_strip_ids(m.group(0)) for m in re.finditer(
        r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
        r"CartesianProduct)[^\n]*?(Inner|LeftOuter|LeftSemi|LeftAnti|FullOuter|Cross|RightOuter)",
        plan)]
    scans = []
    for m in re.finditer(r"FileScan parquet [\w.`]*\[([^\]]*)\][^\n]*?PushedFilters: (\[[^\]]*\])",
                         plan):
        cols = _strip_ids(m.group(1))
        scans.append((cols, _strip_ids(m.group(2))))
    return {"shuffles": shuffles, "joins": joins, "scans": scans,
            "window_limits": plan.count("WindowGroupLimit"),
            # distinct subqueries that run; a ReusedSubquery points at one of them
            "subqueries": len(set(re.findall(r"Subquery (?:scalar-)?subquery#(\d+)", plan))),
            "reused_subqueries": len(re.findall(r"ReusedSubquery", plan))}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    spark = local_session(8, extra=SETTINGS)
    lines = ["# Physical plans of the registered queries", "",
             "Generated by `tools/plan_summary.py` (broadcast joins off, adaptive execution off: "
             "the static plan for dimensions too big to broadcast). With the defaults, small "
             "dimensions become broadcast joins and AQE coalesces and splits partitions at run "
             "time.", ""]
    for name, fn in QUERIES.items():
        if name == "publish_round_trip":
            continue  # its result is a table scan of what it wrote
        own = BUCKETED_FACTS if name.endswith("_bucketed") else {}
        for k, v in own.items():
            spark.conf.set(k, v)
        df = fn(spark, sf_dir)
        s = summarise(plan_text(df))
        for k in own:
            spark.conf.unset(k)
        lines += [f"## {name}", "",
                  f"shuffles: {len(s['shuffles'])}, joins: {len(s['joins'])}, scans: "
                  f"{len(s['scans'])}, window limits: {s['window_limits']}, scalar subqueries: "
                  f"{s['subqueries']} executed, {s['reused_subqueries']} reused", ""]
        if s["shuffles"]:
            lines += ["| shuffle |", "| --- |"] + [f"| `{x}` |" for x in s["shuffles"]] + [""]
        if s["joins"]:
            lines += ["| join |", "| --- |"] + [f"| `{x[:150]}` |" for x in s["joins"]] + [""]
        if s["scans"]:
            lines += ["| scan columns | pushed filters |", "| --- | --- |"]
            lines += [f"| `{c[:110]}` | `{p[:150]}` |" for c, p in s["scans"]] + [""]
    spark.stop()
    with open(out, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
