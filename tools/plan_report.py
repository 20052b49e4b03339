"""Summarise the physical plan of every batch catalog query.

    python tools/plan_report.py [--sf-dir DIR] > PLANS.md

For each query: shuffles (Exchange), broadcasts, partial aggregates,
top-k, generators, and each scan's pushed filters and read schema.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

STREAMING = {"daily_first_seen_stream", "flatten_append_stream", "flatten_upsert_stream",
             "ledger_stream"}


def summarize(plan: str) -> dict:
    scans = []
    for m in re.finditer(r"Scan parquet[^\n]*\n(?:.*\n)*?\n", plan):
        block = m.group(0)
        loc = re.search(r"Location: \w+ \[([^\]]+)\]", block)
        pushed = re.search(r"PushedFilters: (\[[^\n]*\])", block)
        schema = re.search(r"ReadSchema: ([^\n]+)", block)
        if not loc:
            continue
        scans.append({"table": os.path.basename(loc.group(1)),
                      "pushed": pushed.group(1) if pushed else "[]",
                      "schema": schema.group(1) if schema else "?"})
    exchanges = re.findall(r"^\(\d+\) Exchange\n(?:.*\n)*?Arguments: ([^\n]*)", plan, re.M)
    spread = sum(1 for a in exchanges if a.startswith("RoundRobinPartitioning"))
    return {
        "exchanges": len(exchanges) - spread,
        "spread": spread,
        "broadcasts": len(re.findall(r"^\(\d+\) BroadcastExchange", plan, re.M)),
        "partial_aggs": len(re.findall(r"partial_", plan)) > 0,
        "topk": "TakeOrderedAndProject" in plan,
        "generate": "Generate" in plan,
        "scans": scans,
    }


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    a = ap.parse_args()
    from driftlog.plans.catalog import QUERIES
    from driftlog.session import build_session

    spark = build_session("plan-report", master=f"local[{os.environ.get('BENCH_CPUS', '8')}]")
    print("# Physical plans of the batch catalog queries\n")
    print(f"Generated by `tools/plan_report.py` on `{a.sf_dir}` (AQE on; initial plans).\n")
    print("`spread` = round-robin exchanges added only because a test table is one row group")
    print("(fewer partitions than cores); none on an input with at least one partition per core.\n")
    print("| query | key shuffles | spread | broadcasts | map-side partial agg | top-k | generate |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    details = []
    for name, q in QUERIES.items():
        if name in STREAMING:
            continue
        df = q(spark, a.sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plan = buf.getvalue()
        s = summarize(plan)
        print(f"| {name} | {s['exchanges']} | {s['spread']} | {s['broadcasts']} | {'yes' if s['partial_aggs'] else '-'}"
              f" | {'yes' if s['topk'] else '-'} | {'yes' if s['generate'] else '-'} |")
        details.append((name, s))
    print("\n## Scans (pushed filters, read schema)\n")
    for name, s in details:
        for sc in s["scans"]:
            print(f"* `{name}` / {sc['table']}: pushed `{sc['pushed']}`, reads `{sc['schema']}`")
    return 0


if __name__ == "__main__":
    sys.exit(main())
