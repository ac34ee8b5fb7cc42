"""Summarise the executed physical plan of every query of the reference's operators.

Runs each query once (noop sink) at the given scale, then counts the
operators that matter for scale in its final adaptive plan and records the
Parquet scans' pruned schema and pushed filters.  Writes PLANS.md.
Usage: ``python tools/explain_all.py [sf_dir] [out.md]``.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quizlog.plans import registry  # noqa: E402
from quizlog.session import get_session  # noqa: E402

COUNTS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin",
    "single-partition exch.": r"Exchange SinglePartition",
    "broadcast joins": r"BroadcastHashJoin",
    "sort-merge joins": r"SortMergeJoin",
    "windows": r"\bWindow\b",
    "group limits": r"WindowGroupLimit",
    "python": r"MapInPandas|ArrowEvalPython|BatchEvalPython",
}


def summarise(plan: str) -> dict[str, int]:
    final = plan.split("== Initial Plan ==")[0]
    return {k: len(re.findall(p, final)) for k, p in COUNTS.items()}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(__file__)), "PLANS.md")
    spark = get_session()
    rows = []
    scans = set()
    for name, fn in registry.QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        c = summarise(plan)
        rows.append((name, c))
        for m in re.finditer(r"ReadSchema: (struct<[^>]*>)", plan):
            scans.add(m.group(1))
    with open(out, "w") as fh:
        fh.write(f"# Physical plans of the registered queries ({os.path.basename(sf_dir)}, final adaptive plans)\n\n")
        fh.write("Generated by `tools/explain_all.py`. Counts are operators in the final plan of the query itself;\n")
        fh.write("tables materialised earlier (checked statistics, vocabularies) appear as scans of their checkpoint.\n")
        fh.write("The single-partition exchanges carry one row per range partition (global-rank offsets) or one\n")
        fh.write("aggregated row, never log rows.\n\n")
        fh.write("| query | " + " | ".join(COUNTS) + " |\n|---|" + "---|" * len(COUNTS) + "\n")
        for name, c in rows:
            fh.write(f"| {name} | " + " | ".join(str(c[k]) for k in COUNTS) + " |\n")
        fh.write("\n## Parquet read schemas seen (column pruning)\n\n")
        for s in sorted(scans):
            fh.write(f"* `{s}`\n")
    print("wrote", out)


if __name__ == "__main__":
    main()
