"""Summarise the physical plans of registered queries (for plan review).

    python tools/plan_summary.py [sf_dir] [name ...] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans.catalog import QUERIES  # noqa: E402
from ledgerline.session import local_session  # noqa: E402

PATTERNS = {
    "hash/range shuffles": r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition)",
    "round-robin spreads": r"Exchange RoundRobinPartitioning",
    "broadcasts": r"BroadcastExchange ",
    "broadcast hash joins": r"BroadcastHashJoin ",
    "sort-merge joins": r"SortMergeJoin ",
    "nested-loop joins": r"BroadcastNestedLoopJoin ",
    "windows": r"\bWindow \[",
    "aggregates": r"\b(?:Hash|Sort|ObjectHash)Aggregate\(",
    "python evals": r"ArrowEvalPython ",
    "generators": r"\bGenerate ",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    print("| query | " + " | ".join(PATTERNS) + " | scans with pushed filters |")
    print("| --- " * (len(PATTERNS) + 2) + "|")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(p, plan)) for p in PATTERNS.values()]
        scans = plan.count("FileScan")
        pushed = len(re.findall(r"PushedFilters: \[[^\]]", plan))
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + f" | {pushed}/{scans} |")


if __name__ == "__main__":
    main()
