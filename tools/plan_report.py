"""Summarise the final (adaptive) physical plan of each headline query into PLANS.md.

    python tools/plan_report.py [sf_dir] [out.md]

For every query of ``bench.HEADLINE``: runs it, then lists its shuffles
(with keys), joins (strategy and type), aggregations and windows, and every
parquet scan with its pushed filters and read schema.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import bench  # noqa: E402
from ledgerlint.plans import mf_queries  # noqa: E402
from ledgerlint.session import local_session  # noqa: E402

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin", "ShuffledHashJoin", "CartesianProduct")


def _top_level_fields(schema: str) -> int:
    depth, n = 0, 1 if schema else 0
    for ch in schema:
        if ch in "<(":
            depth += 1
        elif ch in ">)":
            depth -= 1
        elif ch == "," and depth == 0:
            n += 1
    return n


def _final_section(plan: str) -> str:
    """Drop every '== Initial Plan ==' block (adaptive plans print both), keeping nested final plans."""
    kept, skip_indent = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if skip_indent is not None:
            if indent > skip_indent:
                continue
            skip_indent = None
        if "== Initial Plan ==" in line:
            skip_indent = indent
            continue
        kept.append(line)
    return "\n".join(kept)


def summarise(plan: str) -> list[str]:
    plan = _final_section(plan)
    out = []
    shuffles = re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|RoundRobinPartitioning\(\d+\)|"
                          r"rangepartitioning\([^)]*\))(?:, (\w+))?", plan)
    distinct_shuffles = Counter((re.sub(r"#\d+L?", "", part), origin or "ENSURE_REQUIREMENTS")
                                for part, origin in shuffles)
    out.append(f"- distinct shuffles: {len(distinct_shuffles)}")
    for (keys, origin), _ in sorted(distinct_shuffles.items()):
        out.append(f"  - `{keys[:170]}` ({origin})")
    joins = re.findall(r"(" + "|".join(JOINS) + r")[^\n]*?(Inner|LeftOuter|LeftSemi|LeftAnti|FullOuter|RightOuter|Cross)",
                       plan)
    jc = sorted({f"{j} {t}" for j, t in joins})
    out.append("- join strategies used: " + (", ".join(jc) or "none"))
    windows = len(re.findall(r"\bWindow \[", plan))
    cached = "yes" if re.search(r"\bInMemoryTableScan\b", plan) else "no"
    out.append(f"- window operators: {'yes' if windows else 'no'}; reads cached steps: {cached}")
    scans = []
    for m in re.finditer(r"FileScan parquet[^\n]*", plan):
        line = m.group(0)
        loc = re.search(r"Location: [^\[]*\[([^\]]*)\]", line)
        path = loc.group(1).split(",")[0].rstrip("/") if loc else "?"
        table = os.path.basename(path)
        if table.startswith("missing-files-"):
            table = "staged " + table.split("-")[2]
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        schema = re.search(r"ReadSchema: struct<(.*)>\s*$", line)
        cols = _top_level_fields(schema.group(1)) if schema else 0
        scans.append(f"  - scan `{table}`: {cols} columns read; pushed filters: "
                     f"{(pushed.group(1) if pushed and pushed.group(1) else 'none')[:200]}")
    out.append("- parquet scans (distinct):")
    out += sorted(set(scans))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out_path = sys.argv[2] if len(sys.argv) > 2 else os.path.join(ROOT, "PLANS.md")
    spark = local_session(app="ledgerlint-plans")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # print scan paths and schemas in full
    lines = ["# PLANS", "",
             f"Final adaptive plans of the headline queries at `{os.path.basename(sf_dir)}` on `local[8]` "
             "(generated by `tools/plan_report.py`). Cached steps print their plan at every use, so shuffles "
             "and scans are listed once each; staged steps appear as scans of the staged table.", ""]
    for name, q in bench.HEADLINE.items():
        mf_queries.reset()
        spark.catalog.clearCache()
        df = q(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines.append(f"## {name}")
        lines.append("")
        lines += summarise(plan)
        lines.append("")
    with open(out_path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(out_path)
    spark.stop()


if __name__ == "__main__":
    main()
